"""Queries TIM1-TIM21: grids, calendar, local time, peak flags, resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import timegrid as tg
from ..operators import windows as win
from .registry import query

S = lambda c, a=None: F.col(c).cast("string").alias(a or c)


def R(c, a: str, n: int = 6):
    """c as a, rounded to n digits on the scaled binary value, as the SQL twins do; Spark's own rounding of a double
    starts from its shortest decimal form and so differs on ties."""
    scaled = (F.col(c) if isinstance(c, str) else c).cast("double") * F.lit(float(10**n))
    return (F.round(scaled, 0) / F.lit(float(10**n))).alias(a)


LOCAL = "((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Zurich')"


def bounds(t):
    """(series, start, end) of each series, in whole days."""
    return t.spot.groupBy("series").agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz").alias("start"), (F.date_trunc("day", F.max("ts")) + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz").alias("end"))


GRID = """bounds AS (SELECT series, date_trunc('day', min(ts)) AS a, date_trunc('day', max(ts)) + INTERVAL 1 day AS b FROM spot GROUP BY series),
grid AS (SELECT series, CAST(unnest(generate_series(a, b - INTERVAL 15 minute, INTERVAL 15 minute)) AS TIMESTAMP) AS ts FROM bounds)"""
CAL = f"cal AS ({cal.sql('daily')})"


@query("tim1_grid", "SELECT series, CAST(ts AS VARCHAR) AS ts FROM grid", GRID)
def tim1(t):
    return tg.grid(bounds(t), "15 MINUTES", ("series",)).select("series", S("ts"))


@query("tim2_local", f"SELECT series, CAST(ts AS VARCHAR) AS ts, CAST({LOCAL} AS VARCHAR) AS local_ts FROM spot")
def tim2(t):
    return t.spot.select("series", S("ts"), tg.local_time(F.col("ts")).cast("string").alias("local_ts"))


@query("tim3_period_bounds", "SELECT DISTINCT y AS year, m AS month, CAST((make_timestamp(y, m, 1, 0, 0, 0.0) AT TIME ZONE 'Europe/Zurich') AT TIME ZONE 'UTC' AS VARCHAR) AS start_utc FROM (SELECT CAST(year(d) AS INT) AS y, CAST(month(d) AS INT) AS m FROM daily)")
def tim3(t):
    months = t.daily.select(F.year("d").alias("year"), F.month("d").alias("month")).distinct()
    start = F.make_date("year", "month", F.lit(1)).cast("timestamp_ntz")
    return months.select("year", "month", tg.to_utc(start).cast("string").alias("start_utc"))


@query("tim4_calendar", "SELECT CAST(d AS VARCHAR) AS d, season, day_type_ch, day_type_de, holiday_ch, holiday_de FROM cal", CAL)
def tim4(t):
    return t.calendar.select(S("d"), "season", "day_type_ch", "day_type_de", "holiday_ch", "holiday_de")


def enriched(t):
    """spot with local date, hour, quarter of the hour, and the calendar of its day."""
    rows = t.spot.withColumn("local_ts", tg.local_time(F.col("ts")))
    rows = rows.withColumns({"d": F.to_date("local_ts"), "hour": F.hour("local_ts"), "quarter": F.floor(F.minute("local_ts") / 15).cast("int") + 1})
    days = cal.day_calendar(rows.select("d").distinct())
    return rows.join(days, "d")


ENRICHED = f"""loc AS (SELECT *, {LOCAL} AS local_ts FROM spot), loc2 AS (SELECT *, CAST(local_ts AS DATE) AS d, CAST(hour(local_ts) AS INT) AS hour, CAST(minute(local_ts) // 15 + 1 AS INT) AS quarter FROM loc),
ecal AS ({cal.sql('loc2')}), enriched AS (SELECT * FROM loc2 JOIN ecal USING (d))"""


@query("tim5_enrich", "SELECT series, CAST(ts AS VARCHAR) AS ts, hour, quarter, season, day_type_ch FROM enriched", ENRICHED)
def tim5(t):
    return enriched(t).select("series", S("ts"), "hour", "quarter", "season", "day_type_ch")


@query("tim6_peak_exchange", "SELECT series, CAST(ts AS VARCHAR) AS ts, isodow(local_ts) <= 5 AND hour BETWEEN 8 AND 19 AND NOT holiday_ch AS peak FROM enriched", ENRICHED)
def tim6(t):
    return enriched(t).select("series", S("ts"), tg.peak_exchange(F.col("local_ts"), F.col("holiday_ch")).alias("peak"))


@query("tim7_peak_weekday", f"SELECT series, CAST(ts AS VARCHAR) AS ts, isodow({LOCAL}) <= 5 AND hour({LOCAL}) BETWEEN 8 AND 19 AS peak FROM spot")
def tim7(t):
    return t.spot.select("series", S("ts"), tg.peak_weekday(tg.local_time(F.col("ts"))).alias("peak"))


@query("tim8_peak_daily", "SELECT series, CAST(ts AS VARCHAR) AS ts, hour(ts) BETWEEN 7 AND 19 AS peak FROM spot")
def tim8(t):
    return t.spot.select("series", S("ts"), tg.peak_daily(F.hour("ts")).alias("peak"))


def month_hours(t):
    """(year, month, quarter, hours, peak_hours, offpeak_hours) of each local month of the daily prices."""
    years = t.daily.agg(F.min(F.year("d")).alias("a"), F.max(F.year("d")).alias("b"))
    span = years.select(tg.to_utc(F.make_date("a", F.lit(1), F.lit(1)).cast("timestamp_ntz")).alias("start"), tg.to_utc(F.make_date(F.col("b") + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz")).alias("end"))
    hours = tg.grid(span, "1 HOUR").withColumn("local_ts", tg.local_time(F.col("ts"))).withColumn("d", F.to_date("local_ts"))
    peak = tg.peak_exchange(F.col("local_ts"), cal.is_holiday(F.col("d"), "CH", True))
    counted = hours.groupBy(F.year("d").alias("year"), F.month("d").alias("month")).agg(F.count(F.lit(1)).alias("hours"), F.count_if(peak).alias("peak_hours"))
    return counted.select("year", "month", F.ceil(F.col("month") / 3).cast("int").alias("quarter"), "hours", "peak_hours", (F.col("hours") - F.col("peak_hours")).alias("offpeak_hours"))


HOURS = f"""hgrid AS (SELECT CAST(unnest(generate_series((make_timestamp(a, 1, 1, 0, 0, 0.0) AT TIME ZONE 'Europe/Zurich') AT TIME ZONE 'UTC', ((make_timestamp(b + 1, 1, 1, 0, 0, 0.0) AT TIME ZONE 'Europe/Zurich') AT TIME ZONE 'UTC') - INTERVAL 1 hour, INTERVAL 1 hour)) AS TIMESTAMP) AS ts
  FROM (SELECT CAST(min(year(d)) AS INT) AS a, CAST(max(year(d)) AS INT) AS b FROM daily)),
hloc AS (SELECT ts, {LOCAL} AS local_ts, CAST({LOCAL} AS DATE) AS d FROM hgrid), hcal AS ({cal.sql('hloc')}),
mh AS (SELECT CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(quarter(any_value(d)) AS INT) AS quarter, count(*) AS hours, count(*) FILTER (isodow(local_ts) <= 5 AND hour(local_ts) BETWEEN 8 AND 19 AND NOT holiday_ch) AS peak_hours FROM hloc JOIN hcal USING (d) GROUP BY year(d), month(d))"""


@query("tim9_delivery_hours", "SELECT year, month, quarter, hours, peak_hours, hours - peak_hours AS offpeak_hours FROM mh", HOURS)
def tim9(t):
    return month_hours(t)


@query("tim10_period_keys", "SELECT market, CASE WHEN month IS NOT NULL THEN printf('%d-%02d', year, month) WHEN quarter IS NOT NULL THEN printf('%d-Q%d', year, quarter) ELSE CAST(year AS VARCHAR) END AS key, CAST(year AS INT) AS year, CAST(quarter AS INT) AS quarter, CAST(month AS INT) AS month, 'Peak' AS load FROM quotes")
def tim10(t):
    key = tg.key_of(F.col("year"), F.col("quarter"), F.col("month"))
    rows = t.quotes.select("market", key.alias("key"), tg.parse_key(F.concat(key, F.lit("-Peak"))).alias("p"))
    return rows.select("market", "key", "p.*")


@query("tim11_delivery_order", "SELECT market, key, row_number() OVER (PARTITION BY market ORDER BY year, rank, coalesce(quarter, month, 0)) AS position FROM (SELECT *, CASE WHEN month IS NOT NULL THEN 2 WHEN quarter IS NOT NULL THEN 1 ELSE 0 END AS rank, CASE WHEN month IS NOT NULL THEN printf('%d-%02d', year, month) WHEN quarter IS NOT NULL THEN printf('%d-Q%d', year, quarter) ELSE CAST(year AS VARCHAR) END AS key FROM quotes)")
def tim11(t):
    rank = F.when(F.col("month").isNotNull(), 2).when(F.col("quarter").isNotNull(), 1).otherwise(0)
    rows = t.quotes.select("market", tg.key_of(F.col("year"), F.col("quarter"), F.col("month")).alias("key"), "year", rank.alias("rank"), F.coalesce("quarter", "month", F.lit(0)).alias("sub"))
    return rows.select("market", "key", F.row_number().over(win.by(["market"], ["year", "rank", "sub"])).alias("position"))


@query("tim12_upsample_ffill", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(last_value(price IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS UNBOUNDED PRECEDING), 6) AS price FROM grid LEFT JOIN spot USING (series, ts)", GRID)
def tim12(t):
    rows = tg.grid(bounds(t), "15 MINUTES", ("series",)).join(t.spot, ["series", "ts"], "left")
    return rows.select("series", S("ts"), R(win.ffill("price", ["series"], "ts"), "price"))


@query("tim13_native_step", "SELECT series, median(step) AS step_minutes FROM (SELECT series, date_diff('minute', lag(ts) OVER (PARTITION BY series ORDER BY ts), ts) AS step FROM spot) GROUP BY series")
def tim13(t):
    step = (F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(win.by(["series"], "ts")))) / 60
    return t.spot.select("series", step.alias("step")).groupBy("series").agg(F.percentile("step", F.lit(0.5)).alias("step_minutes"))


@query("tim14_downsample", "SELECT series, CAST(date_trunc('hour', ts) AS VARCHAR) AS hour_ts, round(avg(price), 6) AS mean, round(min(price), 6) AS low, round(max(price), 6) AS high, round(arg_min(price, ts), 6) AS first FROM spot GROUP BY series, date_trunc('hour', ts)")
def tim14(t):
    rows = t.spot.groupBy("series", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"))
    return rows.agg(R(F.avg("price"), "mean"), R(F.min("price"), "low"), R(F.max("price"), "high"), R(F.min_by("price", "ts"), "first")).select("series", S("h", "hour_ts"), "mean", "low", "high", "first")


@query("tim15_gaps", "SELECT series, count(*) AS missing, CAST(min(ts) AS VARCHAR) AS first_gap FROM grid ANTI JOIN spot USING (series, ts) GROUP BY series", GRID)
def tim15(t):
    gaps = tg.grid(bounds(t), "15 MINUTES", ("series",)).join(t.spot, ["series", "ts"], "left_anti")
    return gaps.groupBy("series").agg(F.count(F.lit(1)).alias("missing"), F.min("ts").cast("string").alias("first_gap"))


@query("tim16_trailing", "SELECT market, count(*) AS n, round(avg(price), 6) AS mean FROM daily JOIN (SELECT market, max(d) AS last FROM daily GROUP BY market) USING (market) WHERE d > last - INTERVAL 365 day GROUP BY market")
def tim16(t):
    last = t.daily.groupBy("market").agg(F.max("d").alias("last"))
    rows = t.daily.join(last, "market").where(F.col("d") > F.date_sub("last", 365))
    return rows.groupBy("market").agg(F.count(F.lit(1)).alias("n"), R(F.avg("price"), "mean"))


AS_OF = "1999-01-01"


@query("tim17_horizon", f"SELECT market, CAST(d AS VARCHAR) AS d, CAST(greatest((year(d) - 1999) * 12 + month(d) - 1, 0) AS INT) AS months, CAST(greatest(round_even(date_diff('day', DATE '{AS_OF}', d) / 30.0, 0), 0) AS INT) AS months_rounded FROM daily")
def tim17(t):
    start = F.lit(AS_OF).cast("date")
    return t.daily.select("market", S("d"), tg.months_between(start, F.col("d")).alias("months"), tg.months_rounded(F.datediff("d", start)).alias("months_rounded"))


MONTHS = "greatest((year(d) - 1999) * 12 + month(d) - 1, 0)"


@query("tim18_step_lookup", f"SELECT market, CAST(d AS VARCHAR) AS d, CASE WHEN {MONTHS} <= 6 THEN 2.5 WHEN {MONTHS} <= 12 THEN 2.8 WHEN {MONTHS} <= 24 THEN 3.5 ELSE 4.2 END::DOUBLE AS widening FROM daily")
def tim18(t):
    months = tg.months_between(F.lit(AS_OF).cast("date"), F.col("d"))
    return t.daily.select("market", S("d"), tg.step_lookup(months, tg.WIDENING, 4.2).alias("widening"))


@query("tim19_confidence", f"SELECT market, CAST(d AS VARCHAR) AS d, CASE WHEN {MONTHS} <= 6 THEN 'M+6' WHEN {MONTHS} <= 12 THEN 'M+12' WHEN {MONTHS} <= 24 THEN 'M+24' ELSE 'far' END AS bucket, CASE WHEN {MONTHS} <= 6 THEN 1.0 WHEN {MONTHS} <= 12 THEN 0.85 WHEN {MONTHS} <= 24 THEN 0.65 ELSE 0.45 END::DOUBLE AS confidence FROM daily")
def tim19(t):
    months = tg.months_between(F.lit(AS_OF).cast("date"), F.col("d"))
    bucket = tg.step_lookup(months, [(6, "M+6"), (12, "M+12"), (24, "M+24")], "far")
    return t.daily.select("market", S("d"), bucket.alias("bucket"), tg.step_lookup(months, tg.CONFIDENCE, 0.45).alias("confidence"))


@query("tim20_encodings", "SELECT market, CAST(d AS VARCHAR) AS d, CAST(weekofyear(d) AS INT) AS iso_week, CAST(isodow(d) - 1 AS INT) AS weekday, round(sin(month(d) * (2 * pi() / 12)), 6) + 0.0 AS month_sin, round(cos(month(d) * (2 * pi() / 12)), 6) + 0.0 AS month_cos FROM daily")
def tim20(t):
    s, c = tg.cyclic(F.month("d"), 12)
    return t.daily.select("market", S("d"), tg.iso_week(F.col("d")).alias("iso_week"), F.weekday("d").alias("weekday"), (F.round(s, 6) + 0.0).alias("month_sin"), (F.round(c, 6) + 0.0).alias("month_cos"))


@query("tim21_complete_days", "SELECT series, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, count(DISTINCT hour(ts)) AS hours FROM spot GROUP BY series, CAST(ts AS DATE) HAVING count(DISTINCT hour(ts)) >= 23")
def tim21(t):
    days = t.spot.groupBy("series", F.to_date("ts").alias("d")).agg(F.count_distinct(F.hour("ts")).alias("hours"))
    return days.where("hours >= 23").select("series", S("d"), "hours")
