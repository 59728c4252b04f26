"""Keyed state of revised messages: the latest revision by id, cancelled ones withdrawn, old ones forgotten.

State is one row an id. It leaves when the watermark passes `keep` after the message's latest event time: a timer set on
each change clears it. A cancelled message leaves a tombstone until then, so that an older revision that arrives late
doesn't bring it back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "id long, revision long, event_ms long, value double, withdrawn boolean"


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB; the given one isn't changed."""
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


class LatestRevision(StatefulProcessor):
    """Emits a row whenever an id's latest revision changes; withdrawn says that it is cancelled."""

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "revision long, until long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        known = self.newest.get() if self.newest.exists() else None
        best = None
        for pdf in rows:
            row = pdf.loc[pdf["revision"].idxmax()]
            if best is None or row["revision"] > best["revision"]:
                best = row
        if best is None or (known is not None and best["revision"] <= known[0]):
            return
        until = int(best["event_ms"]) + self.keep_ms
        if known is not None and known[1] != until:
            self.handle.deleteTimer(int(known[1]))
        self.newest.update((int(best["revision"]), until))
        self.handle.registerTimer(until)
        yield pd.DataFrame({"id": [None if key[0] is None else int(key[0])], "revision": [int(best["revision"])], "event_ms": [int(best["event_ms"])], "value": [float(best["value"])], "withdrawn": [bool(best["cancelled"])]})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        self.newest.clear()
        yield pd.DataFrame({"id": [], "revision": [], "event_ms": [], "value": [], "withdrawn": []}).astype({"id": "int64", "revision": "int64", "event_ms": "int64", "value": "float64", "withdrawn": "bool"})

    def close(self) -> None:
        pass


def latest_revisions(stream: DataFrame, delay: str = "1 hour", keep_ms: int = 30 * 86_400_000) -> DataFrame:
    """Changes (CHANGES) of a stream of messages (id, revision, ts, value, cancelled). The stream has to come from a
    stateful_session."""
    rows = stream.withWatermark("ts", delay).withColumn("event_ms", F.unix_millis("ts"))
    rows = rows.select("id", "revision", "ts", "event_ms", "value", "cancelled").groupBy("id")
    return rows.transformWithStateInPandas(LatestRevision(keep_ms), CHANGES, "Update", "EventTime")
