"""Structured Streaming jobs over ticks (series, ts, value) and keyed updates.

Event time is a TIMESTAMP (watermarks don't take TIMESTAMP_NTZ); the session's zone is UTC. Each job runs with
trigger(availableNow=True) over what is there, or continuously without it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import keep_last


def ticks(spark: SparkSession, path: str, schema: str, files_per_batch: int = 4) -> DataFrame:
    """Stream of the Parquet files of a folder, with series and an event time."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def bars(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """15-minute means per series; a window is emitted once its end is `delay` behind the newest tick."""
    windows = stream.withWatermark("ts", delay).groupBy(F.window("ts", "15 minutes"), "series")
    return windows.agg(F.avg("value").alias("price"), F.count(F.lit(1)).alias("n")).select("series", F.col("window.start").alias("ts"), "price", "n")


def sliding_mean(stream: DataFrame, size: str = "7 days", step: str = "1 day", delay: str = "1 hour") -> DataFrame:
    windows = stream.withWatermark("ts", delay).groupBy(F.window("ts", size, step), "series")
    return windows.agg(F.avg("value").alias("mean")).select("series", F.col("window.start").alias("start"), "mean")


def distinct_ticks(stream: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Exact repeats within the delay are dropped."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, path: str | None = None) -> None:
    """Drain the stream into a table at path (append), or through `each` for every micro-batch."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").outputMode("append").start(path)
    query.awaitTermination()


#: Batches after which the state of keep_last_into is written anew.
COMPACT = 20


def keep_last_into(path: str, keys: list[str], newest: list[str], compact: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: the latest row per key of the batch is written as a partition of its batch number, so that
    a batch that is run again overwrites itself; latest() reads the state.

    Every `compact` batches the latest rows of all partitions so far become the batch's own one, under a new base
    folder, so the state has a row per key and at most `compact` partitions beside. Older bases are never read
    again and may be deleted."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark, order = batch.sparkSession, [F.desc(c) for c in newest]
        base = batch_id // compact
        last = keep_last(batch, keys, order)
        if batch_id and batch_id % compact == 0:
            before = _state(spark, path, base - 1)
            if before is not None:
                last = keep_last(last.unionByName(before.drop("batch")), keys, order)
        last.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/base={base}")

    return merge


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in path; none if it isn't there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []


def _state(spark: SparkSession, path: str, base: int) -> DataFrame | None:
    return spark.read.parquet(f"{path}/base={base}") if f"base={base}" in _folders(spark, path) else None


def latest(spark: SparkSession, path: str, keys: list[str], newest: list[str]) -> DataFrame:
    """The latest row per key: the newest base begins with the whole state before it."""
    base = max(int(f.removeprefix("base=")) for f in _folders(spark, path) if f.startswith("base="))
    return keep_last(spark.read.parquet(f"{path}/base={base}"), keys, [F.desc(c) for c in newest]).drop("batch")


def gate_into(path: str, least: int = 1, stale_after: str = "INTERVAL 6 HOURS") -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: one row of checks per series and batch; stale alerts that a series' newest tick is more than
    `stale_after` behind the newest of the batch."""

    def check(batch: DataFrame, batch_id: int) -> None:
        rows = batch.groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("newest"), F.count_if(F.col("value").isNull()).alias("nulls"))
        now = batch.agg(F.max("ts").alias("now"))
        rows = rows.crossJoin(F.broadcast(now)).withColumn("stale", F.col("newest") < F.col("now") - F.expr(stale_after)).drop("now")
        rows = rows.withColumn("ok", (F.col("n") >= least) & (F.col("nulls") == 0) & ~F.col("stale")).withColumn("batch", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return check


def curve_error(stream: DataFrame, curve: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Daily mean absolute error of a static curve (series, hour, level) against arriving ticks."""
    rows = stream.withWatermark("ts", delay).withColumn("hour", F.hour("ts")).join(curve, ["series", "hour"])
    windows = rows.groupBy(F.window("ts", "1 day"), "series").agg(F.avg(F.abs(F.col("value") - F.col("level"))).alias("mae"))
    return windows.select("series", F.col("window.start").alias("d"), "mae")
