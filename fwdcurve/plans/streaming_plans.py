"""Queries STR1-STR6: streams over the events, drained and read back. Their SQL leaves out what is still open."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.writers import shared_folder
from ..streaming import jobs, state
from .registry import query
from .table_plans import HOURLY, hourly
from .time_plans import R

SCHEMA = "event_id long, ts timestamp_ntz, event_type string, value double, user_id long"
NEWEST = "(SELECT max(ts) FROM events)"


def landed(t) -> str:
    """The events as a folder of files, as a feed would land them."""
    path = shared_folder(t.spark, "feed")
    t.events.select("event_id", "ts", "event_type", "value", "user_id").repartitionByRange(4, "ts").write.parquet(path)
    return path


def stream(t):
    return jobs.ticks(t.spark, landed(t), SCHEMA, 1000).withColumnRenamed("event_type", "series")


def drained(t, df, name: str):
    path = shared_folder(t.spark, name)
    jobs.run(df, f"{path}-checkpoint", path=path)
    return t.spark.read.schema(df.schema).parquet(path)


@query("str1_bars", f"SELECT event_type AS series, CAST(time_bucket(INTERVAL 15 minute, ts) AS VARCHAR) AS ts, round(avg(value), 6) AS price, count(*) AS n FROM events GROUP BY ALL HAVING time_bucket(INTERVAL 15 minute, any_value(ts)) + INTERVAL 15 minute <= {NEWEST} - INTERVAL 1 hour")
def str1(t):
    return drained(t, jobs.bars(stream(t)), "bars").select("series", F.col("ts").cast("timestamp_ntz").cast("string").alias("ts"), R("price", "price"), "n")


@query("str2_keep_last", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def str2(t):
    path = shared_folder(t.spark, "last")
    jobs.run(stream(t), f"{path}-checkpoint", each=jobs.keep_last_into(path, ["user_id"], ["event_id"]))
    return jobs.latest(t.spark, path, ["user_id"], ["event_id"]).select("user_id", "event_id")


@query("str3_latest_revision", "SELECT user_id, event_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> (SELECT min(event_type) FROM events)")
def str3(t):
    """Latest event of each user from keyed state; users whose latest event is of the first type are withdrawn."""
    spark = state.stateful_session(t.spark)
    first = t.events.agg(F.min("event_type")).first()[0]
    feed = jobs.ticks(spark, landed(t), SCHEMA, 1000)
    messages = feed.select(F.col("user_id").alias("id"), F.col("event_id").alias("revision"), "ts", F.coalesce("value", F.lit(0.0)).alias("value"), (F.col("event_type") == first).alias("cancelled"))
    path = shared_folder(t.spark, "revisions")
    jobs.run(state.latest_revisions(messages), f"{path}-checkpoint", each=jobs.keep_last_into(path, ["id"], ["revision"]))
    rows = jobs.latest(t.spark, path, ["id"], ["revision"])
    return rows.where("NOT withdrawn").select(F.col("id").alias("user_id"), F.col("revision").alias("event_id"), R("value", "value"))


@query("str4_sliding", f"SELECT event_type AS series, CAST(CAST(s AS DATE) AS VARCHAR) AS start, round(avg(value), 6) AS mean FROM (SELECT event_type, value, date_trunc('day', ts) - to_days(CAST(k AS INT)) AS s FROM events, range(7) r(k)) WHERE s + INTERVAL 7 day <= {NEWEST} - INTERVAL 1 hour GROUP BY ALL")
def str4(t):
    return drained(t, jobs.sliding_mean(stream(t)), "sliding").select("series", F.to_date("start").cast("string").alias("start"), R("mean", "mean"))


@query("str5_gate", f"SELECT event_type AS series, count(*) AS n, max(ts) < {NEWEST} - INTERVAL 6 hour AS stale, count(*) FILTER (value IS NULL) = 0 AND max(ts) >= {NEWEST} - INTERVAL 6 hour AS ok FROM events GROUP BY event_type")
def str5(t):
    path = shared_folder(t.spark, "gate")
    jobs.run(stream(t), f"{path}-checkpoint", each=jobs.gate_into(path))
    return t.spark.read.parquet(path).groupBy("series").agg(F.sum("n").alias("n"), F.bool_or("stale").alias("stale"), F.bool_and("ok").alias("ok"))


@query("str6_curve_error", f"SELECT e.event_type AS series, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS d, round(avg(abs(e.value - c.level)), 6) AS mae FROM events e JOIN (SELECT series, hour, avg(price) AS level FROM hourly GROUP BY ALL) c ON c.series = e.event_type AND c.hour = hour(e.ts) WHERE date_trunc('day', e.ts) + INTERVAL 1 day <= {NEWEST} - INTERVAL 1 hour GROUP BY ALL", HOURLY)
def str6(t):
    curve = hourly(t).groupBy("series", "hour").agg(F.avg("price").alias("level"))
    return drained(t, jobs.curve_error(stream(t), curve), "error").select("series", F.to_date("d").cast("string").alias("d"), R("mae", "mae"))
