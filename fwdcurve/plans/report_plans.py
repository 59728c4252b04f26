"""Queries RPT1-RPT12: the tables behind the report pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import windows as win
from ..sources import writers
from .curve_plans import LOADS, load_hours
from .forecast_plans import EXOGENOUS_SQL as DRIVERS
from .forecast_plans import exogenous_hours as driver_hours
from .registry import query
from .table_plans import HOUR_WAYS, HOURLY, LATEST, NAIVE, PAIR, YEARLY, latest_outages, market_hours, naive, pair
from .time_plans import R, S


@query("rpt1_overview", "SELECT market, round(arg_max(price, d), 6) AS last, round(avg(price) FILTER (d > m - INTERVAL 30 day), 6) AS mean30, round(stddev_samp(price) FILTER (d > m - INTERVAL 30 day), 6) AS sd30 FROM daily JOIN (SELECT market, max(d) AS m FROM daily GROUP BY market) USING (market) GROUP BY market")
def rpt1(t):
    last = t.daily.groupBy("market").agg(F.max("d").alias("m"))
    recent = F.when(F.col("d") > F.date_sub("m", 30), F.col("price"))
    return t.daily.join(last, "market").groupBy("market").agg(R(F.max_by("price", "d"), "last"), R(F.avg(recent), "mean30"), R(F.stddev_samp(recent), "sd30"))


@query("rpt2_resolutions", "SELECT market, resolution, CAST(CAST(date_trunc(resolution, d) AS DATE) AS VARCHAR) AS start, round(avg(price), 6) AS base, round(avg(price) FILTER (peak), 6) AS peak, round(avg(price) FILTER (NOT peak), 6) AS offpeak FROM phours, (VALUES ('day'), ('week'), ('month'), ('year')) r(resolution) GROUP BY ALL", LOADS)
def rpt2(t):
    """Base, peak and off-peak means by day, week, month and year."""
    levels = F.array(*(F.struct(F.lit(k).alias("resolution"), F.to_date(F.date_trunc(k, "d")).cast("string").alias("start")) for k in ("day", "week", "month", "year")))
    rows = load_hours(t).select("market", "price", "is_peak", F.inline(levels)).groupBy("market", "resolution", "start")
    return rows.agg(R(F.avg("price"), "base"), R(F.avg(F.when(F.col("is_peak"), F.col("price"))), "peak"), R(F.avg(F.when(~F.col("is_peak"), F.col("price"))), "offpeak"))


@query("rpt3_mix_shares", "SELECT CAST(d AS VARCHAR) AS d, event_type AS kind, round(s / sum(s) OVER (PARTITION BY d), 6) AS share FROM (SELECT CAST(ts AS DATE) AS d, event_type, sum(value) AS s FROM events GROUP BY ALL)")
def rpt3(t):
    sums = t.events.groupBy(F.to_date("ts").alias("d"), F.col("event_type").alias("kind")).agg(F.sum("value").alias("s"))
    return sums.select(S("d"), "kind", R(F.col("s") / F.sum("s").over(Window.partitionBy("d")), "share"))


LOAD = "hload AS (SELECT CAST(ts AS DATE) AS d, CAST(hour(ts) AS INT) AS hour, count(*) AS load FROM events GROUP BY ALL), usual_load AS (SELECT hour, avg(load) AS usual FROM hload GROUP BY hour)"


def hour_load(t):
    """(d, hour, load): the number of events of each hour stands for load."""
    return t.events.groupBy(F.to_date("ts").alias("d"), F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("load"))


@query("rpt4_load_heatmap", "SELECT CAST(d AS VARCHAR) AS d, hour, round(load - usual, 6) + 0.0 AS deviation FROM hload JOIN usual_load USING (hour)", LOAD)
def rpt4(t):
    """Load of each hour of each day less the hour's mean."""
    rows = hour_load(t)
    usual = rows.groupBy("hour").agg(F.avg("load").alias("usual"))
    return rows.join(usual, "hour").select(S("d"), "hour", (R(F.col("load") - F.col("usual"), "x") + 0.0).alias("deviation"))


@query("rpt4b_load_days", "SELECT CAST(d AS VARCHAR) AS d, round(avg(load), 6) AS mean, min(load) AS low, max(load) AS high FROM hload GROUP BY d", LOAD)
def rpt4b(t):
    return hour_load(t).groupBy(S("d")).agg(R(F.avg("load"), "mean"), F.min("load").alias("low"), F.max("load").alias("high"))


@query("rpt5_regional_split", "SELECT CAST(week AS VARCHAR) AS week, region, round(CASE region WHEN 'wallis' THEN fill_pct * 0.45 WHEN 'graubuenden' THEN fill_pct * 0.25 ELSE fill_pct - fill_pct * 0.45 - fill_pct * 0.25 END, 6) AS part FROM hydro, (VALUES ('wallis'), ('graubuenden'), ('rest')) r(region)")
def rpt5(t):
    w, g = F.col("fill_pct") * 0.45, F.col("fill_pct") * 0.25
    parts = F.array(*(F.struct(F.lit(n).alias("region"), v.alias("part")) for n, v in (("wallis", w), ("graubuenden", g), ("rest", F.col("fill_pct") - w - g))))
    return t.hydro.select("week", F.inline(parts)).select(S("week"), "region", R("part", "part"))


@query("rpt6_price_drivers", f"SELECT market, hour, count(*) AS n, round(corr(price, neighbour), 6) AS neighbour, round(corr(price, load), 6) AS load, round(corr(price, gas), 6) AS gas, round(corr(price, fill), 6) AS fill FROM ({DRIVERS}) GROUP BY market, hour", f"{HOURLY}, {HOUR_WAYS}")
def rpt6(t):
    """Correlation of each delivery hour's price with what drives it."""
    return driver_hours(t).groupBy("market", "hour").agg(F.count(F.lit(1)).alias("n"), *(R(F.corr("price", c), c) for c in ("neighbour", "load", "gas", "fill")))


FLOW = f"{HOURLY}, {HOUR_WAYS}, flow AS (SELECT a.d, a.hour, a.price - b.price AS flow FROM mhours a JOIN mhours b ON b.d = a.d AND b.hour = a.hour WHERE a.market = 'CH' AND b.market = 'DE')"


def flows(t):
    """(d, hour, flow): the gap between both markets' prices stands for the flow."""
    side = lambda m, c: market_hours(t).where(F.col("market") == m).select("d", "hour", F.col("price").alias(c))
    return side("CH", "a").join(side("DE", "b"), ["d", "hour"]).select("d", "hour", (F.col("a") - F.col("b")).alias("flow"))


@query("rpt7_flows", "SELECT dimension, bucket, count(*) AS n, round(avg(flow), 6) AS mean, round(stddev_samp(flow), 6) AS sd, round(avg(CASE WHEN flow > 0 THEN 1.0 ELSE 0.0 END), 6) AS import_share, round(min(flow), 6) AS low, round(max(flow), 6) AS high FROM (SELECT flow, unnest(['hour', 'weekday', 'all']) AS dimension, unnest([hour, CAST(isodow(d) - 1 AS INT), 0]) AS bucket FROM flow) GROUP BY ALL", FLOW)
def rpt7(t):
    """Flow by hour, by weekday and over all: mean, deviation, extremes and the part of hours that import."""
    buckets = F.inline(F.array(*(F.struct(F.lit(n).alias("dimension"), c.alias("bucket")) for n, c in (("hour", F.col("hour")), ("weekday", F.weekday("d")), ("all", F.lit(0))))))
    rows = flows(t).select("flow", buckets).groupBy("dimension", "bucket")
    return rows.agg(F.count(F.lit(1)).alias("n"), R(F.avg("flow"), "mean"), R(F.stddev_samp("flow"), "sd"), R(F.avg((F.col("flow") > 0).cast("double")), "import_share"), R(F.min("flow"), "low"), R(F.max("flow"), "high"))


@query("rpt7b_flow_days", "SELECT CAST(d AS VARCHAR) AS d, round(flow, 6) AS flow, round(avg(flow) OVER (ORDER BY d ROWS 6 PRECEDING), 6) AS mean7 FROM (SELECT d, avg(flow) AS flow FROM flow GROUP BY d)", FLOW)
def rpt7b(t):
    """Daily flow and its mean over seven days."""
    days = flows(t).groupBy("d").agg(F.avg("flow").alias("flow")).withColumn("border", F.lit("CH-DE"))
    return days.select(S("d"), R("flow", "flow"), R(F.avg("flow").over(win.by(["border"], "d", -6, 0)), "mean7"))


@query("rpt8_outages", "SELECT CAST(year(start_ts) AS INT) AS year, count(*) AS n, round(avg(mw), 6) AS mean_mw, round(max(mw), 6) AS most_mw, round(avg(date_diff('hour', start_ts, end_ts)), 6) AS mean_hours, " + ", ".join(f"round(avg(mw) FILTER (month(start_ts) = {m}), 6) AS m{m}" for m in range(1, 13)) + " FROM latest GROUP BY year(start_ts)", LATEST)
def rpt8(t):
    """Outages by year: number, size, duration, and the mean of each month."""
    mean = lambda m: R(F.avg(F.when(F.month("start_ts") == m, F.col("mw"))), f"m{m}")
    hours = F.timestamp_diff("HOUR", F.col("start_ts"), F.col("end_ts"))
    return latest_outages(t).groupBy(F.year("start_ts").alias("year")).agg(F.count(F.lit(1)).alias("n"), R(F.avg("mw"), "mean_mw"), R(F.max("mw"), "most_mw"), R(F.avg(hours), "mean_hours"), *map(mean, range(1, 13)))


@query("rpt8b_outage_price", "SELECT market, count(*) AS n, round(corr(mw, price), 6) AS corr, round(regr_slope(price, mw), 8) AS slope, round(regr_intercept(price, mw), 6) AS intercept FROM (SELECT CAST(start_ts AS DATE) AS d, sum(mw) AS mw FROM latest GROUP BY ALL) JOIN daily USING (d) GROUP BY market", LATEST)
def rpt8b(t):
    per = latest_outages(t).groupBy(F.to_date("start_ts").alias("d")).agg(F.sum("mw").alias("mw"))
    rows = per.join(t.daily, "d").groupBy("market")
    return rows.agg(F.count(F.lit(1)).alias("n"), R(F.corr("mw", "price"), "corr"), R(F.regr_slope("price", "mw"), "slope", 8), R(F.regr_intercept("price", "mw"), "intercept"))


@query("rpt9_commodities", "SELECT name, round(min(close), 6) AS low, round(max(close), 6) AS high, round(arg_max(close, d) / arg_min(close, d) - 1, 6) AS total_return, round(stddev_samp(change), 6) AS volatility FROM (SELECT *, close / lag(close) OVER (PARTITION BY name ORDER BY d) - 1 AS change FROM commodities) GROUP BY name")
def rpt9(t):
    rows = t.commodities.withColumn("change", F.col("close") / F.lag("close").over(win.by(["name"], "d")) - 1)
    return rows.groupBy("name").agg(R(F.min("close"), "low"), R(F.max("close"), "high"), R(F.max_by("close", "d") / F.min_by("close", "d") - 1, "total_return"), R(F.stddev_samp("change"), "volatility"))


@query("rpt10_forecast_summary", """SELECT series, dimension, bucket, count(*) AS n, round(avg(naive), 6) AS mean, round(min(naive), 6) AS low, round(max(naive), 6) AS high, round(avg(abs(price - naive)), 6) AS mae FROM (
  SELECT series, naive, price, unnest(['hour', 'day', 'days ahead', 'hour x day']) AS dimension, unnest([CAST(hour(ts) AS VARCHAR), CAST(CAST(ts AS DATE) AS VARCHAR), CAST(date_diff('day', CAST(start AS DATE), CAST(ts AS DATE)) + 1 AS VARCHAR), hour(ts) || ' ' || CAST(ts AS DATE)]) AS bucket FROM naive, since) GROUP BY ALL""", NAIVE)
def rpt10(t):
    """The naive forecast by hour, day, days ahead and hour of a day: level, range and error."""
    rows = naive(t)
    first = rows.agg(F.to_date(F.min("ts")).alias("first"))
    text = lambda c: c.cast("string")
    day = F.to_date("ts")
    buckets = {"hour": text(F.hour("ts")), "day": text(day), "days ahead": text(F.datediff(day, "first") + 1), "hour x day": F.concat_ws(" ", F.hour("ts"), day)}
    long = rows.crossJoin(F.broadcast(first)).select("series", "naive", "price", F.inline(F.array(*(F.struct(F.lit(n).alias("dimension"), c.alias("bucket")) for n, c in buckets.items()))))
    return long.groupBy("series", "dimension", "bucket").agg(F.count(F.lit(1)).alias("n"), R(F.avg("naive"), "mean"), R(F.min("naive"), "low"), R(F.max("naive"), "high"), R(F.avg(F.abs(F.col("price") - F.col("naive"))), "mae"))


@query("rpt11_run_history", "SELECT run_id, market, n, round(mean, 6) AS mean, round(mean - lag(mean) OVER (PARTITION BY market ORDER BY run_id), 6) + 0.0 AS change, run_id = max(run_id) OVER () AS latest FROM (SELECT CAST(year AS VARCHAR) AS run_id, market, n, mean FROM yearly)", YEARLY)
def rpt11(t):
    """History of stored runs, one a year: rows, mean level, change since the run before, and which is the latest."""
    rows = t.spark.read.schema("market string, d date, price double, run_id string").parquet(stored_runs(t))
    runs = rows.groupBy("run_id", "market").agg(F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean"))
    last = runs.agg(F.max("run_id").alias("last"))
    change = F.col("mean") - F.lag("mean").over(win.by(["market"], "run_id"))
    return runs.crossJoin(F.broadcast(last)).select("run_id", "market", "n", R("mean", "mean"), (R(change, "x") + 0.0).alias("change"), (F.col("run_id") == F.col("last")).alias("latest"))


def stored_runs(t) -> str:
    path = writers.shared_folder(t.spark, "run-history")
    writers.replace_runs(t.daily.withColumn("run_id", F.year("d").cast("string")), path)
    return path


@query("rpt11b_run_snapshot", "SELECT market, CAST(d AS VARCHAR) AS d, round(price, 6) AS price FROM daily WHERE year(d) = (SELECT max(year(d)) FROM daily)")
def rpt11b(t):
    """The rows of the latest run; other runs' files aren't opened."""
    rows = t.spark.read.schema("market string, d date, price double, run_id string").parquet(stored_runs(t))
    last = rows.agg(F.max("run_id")).first()[0]
    return rows.where(F.col("run_id") == last).select("market", S("d"), R("price", "price"))


@query("rpt12_kpi_flags", "SELECT CAST(year(d) AS INT) AS year, round(sqrt(avg((ch - de) * (ch - de))), 6) AS rmse, sqrt(avg((ch - de) * (ch - de))) <= 26 AS rmse_ok, abs(avg(ch - de)) <= 5 AS bias_ok FROM pair GROUP BY year(d)", PAIR)
def rpt12(t):
    e = F.col("ch") - F.col("de")
    rmse = F.sqrt(F.avg(e * e))
    # Limits of the gates.
    return pair(t).groupBy(F.year("d").alias("year")).agg(R(rmse, "rmse"), (rmse <= 26).alias("rmse_ok"), (F.abs(F.avg(e)) <= 5).alias("bias_ok"))
