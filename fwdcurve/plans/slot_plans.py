"""Queries CRV7 and CRV12: the 15-minute curve with all factors, calibration and bands."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import timegrid as tg
from ..operators import curve, forwards, joins, shapes
from ..operators import windows as win
from .curve_plans import contracts, cubic_sql
from .registry import query
from .shape_plans import DAYS, FH, FH_ALL, FH_SMOOTH, FQ, FW, FWS, RATIOS, bands, profile, quarter_table, seasonal_factor
from .time_plans import R, S, month_hours

ZONE = "Europe/Zurich"
#: The series whose shape stands for a market's.
SHAPE_OF = {"CH": F.min, "DE": F.max}


def shape_series(t):
    return t.spot.agg(F.inline(F.array(*(F.struct(F.lit(m).alias("market"), pick("series").alias("series")) for m, pick in SHAPE_OF.items()))))


def slot_grid(t):
    """Every quarter of an hour of each market's quoted years, a curve for each market and delivery year, with its local
    calendar; peak by the exchange's hours without the market's national holidays."""
    years = t.quotes.select("market", "year").distinct()
    first = lambda y: tg.to_utc(F.make_date(y, F.lit(1), F.lit(1)).cast("timestamp_ntz"), ZONE)
    spans = years.select("market", "year", first(F.col("year")).alias("start"), first(F.col("year") + 1).alias("end"))
    rows = tg.grid(spans, "15 MINUTES", ("market", "year")).withColumn("local_ts", tg.local_time(F.col("ts"), ZONE))
    rows = rows.withColumns({"d": F.to_date("local_ts"), "hour": F.hour("local_ts"), "quarter": F.floor(F.minute("local_ts") / 15).cast("int") + 1, "curve_id": F.concat_ws("-", "market", F.col("year").cast("string"))})
    days = spans.select(F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31)))).alias("d")).distinct()
    rows = rows.join(cal.day_calendar(days), "d")
    of = lambda ch, de: F.when(F.col("market") == "CH", F.col(ch)).otherwise(F.col(de))
    rows = rows.withColumns({"day_type": of("day_type_ch", "day_type_de"), "is_peak": tg.peak_exchange(F.col("local_ts"), of("holiday_ch", "holiday_de"))})
    return rows.drop("day_type_ch", "day_type_de", "holiday_ch", "holiday_de")


def month_levels(t):
    """(key, month_start, base): the base level of each month of the quoted years, by the prioritised lookup."""
    years = t.quotes.select("market", "year").distinct()
    months = years.select("market", F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(1)), F.expr("INTERVAL 1 MONTH"))).alias("d"))
    return joins.base_lookup(months, t.quotes).where("base IS NOT NULL").select(F.col("market").alias("key"), F.col("d").alias("month_start"), "base")


def water_factor(rows, t):
    """rows with f_wv: the reservoir's deviation from its week's usual level, of the latest week, by season."""
    usual = t.hydro.groupBy(F.weekofyear("week").alias("w")).agg(F.avg("fill_pct").alias("typical"))
    deviations = t.hydro.withColumn("w", F.weekofyear("week")).join(usual, "w").select("week", (F.col("fill_pct") - F.col("typical")).alias("dev"))
    days = joins.asof_weekly(rows.select("d").distinct(), deviations, "d", "week", "dev")
    return rows.join(days, "d", "left").withColumn("f_wv", shapes.water_value(F.col("dev") / 5, F.col("season"), Window.partitionBy("curve_id"))).drop("dev")


def factor_curve(t):
    """(curve_id, market, ts, local calendar, base, f_s, f_w, f_h, f_q, f_wv, raw) of every slot.

    base is the monotone cubic through the months' levels at the slot's own time, 1 at least; f_w has mean 1 over the slots
    of a local month, f_h over those of a local day, f_q over those of a local hour; each is found by an equi-join on its cell."""
    rows = curve.smooth_slots(slot_grid(t), month_levels(t), "market", "local_ts")
    rows = rows.join(seasonal_factor(t).withColumnRenamed("f", "f_w0"), ["market", "season", "day_type"], "left")
    cell, series = ["series", "season", "day_type"], shape_series(t)
    of_hour = shapes.with_fallback(shapes.smoothed(profile(t))).join(series, "series").select("market", *cell[1:], "hour", F.col("f").alias("f_h0"))
    of_quarter = quarter_table(t).join(series, "series").select("market", *cell[1:], "hour", "quarter", F.col("f").alias("f_q0"))
    rows = rows.join(of_hour, ["market", "season", "day_type", "hour"], "left").join(of_quarter, ["market", "season", "day_type", "hour", "quarter"], "left")
    rows = rows.withColumns({"base": F.greatest("smooth", F.lit(1.0)), "month": F.month("local_ts"), "f_w0": F.coalesce("f_w0", F.lit(1.0)), "f_h0": F.greatest(F.lit(0.4), F.least(F.lit(2.0), F.coalesce("f_h0", F.lit(1.0)))), "f_q0": F.coalesce("f_q0", F.lit(1.0)), "at_hour": F.date_trunc("hour", "ts")})
    rows = rows.withColumns({"f_s": F.lit(1.0), "f_w": win.normalised("f_w0", ["curve_id", "month"]), "f_h": win.normalised("f_h0", ["curve_id", "d"]), "f_q": win.normalised("f_q0", ["curve_id", "at_hour"])})
    rows = water_factor(rows.drop("f_w0", "f_h0", "f_q0", "smooth", "at_hour"), t)
    return rows.withColumn("raw", F.col("base") * F.col("f_s") * F.col("f_w") * F.col("f_h") * F.col("f_q") * F.col("f_wv"))


#: RATIOS has the rows that FH starts from.
_FH = FH[FH.index("fh_raw AS") :]
_YEARS = "(SELECT DISTINCT market, CAST(year AS INT) AS year FROM quotes)"
_AT = lambda y: f"((make_timestamp({y}, 1, 1, 0, 0, 0.0) AT TIME ZONE '{ZONE}') AT TIME ZONE 'UTC')"
SLOTS = f"""{RATIOS}, {FQ}, {_FH}, {FH_SMOOTH}, {FH_ALL}, {DAYS}, {FW}, {FWS}, fwall AS (SELECT market, season, day_type, coalesce(fws.f, fw.f) AS f FROM fws JOIN fw USING (market, day_type)),
slot0 AS (SELECT market, year, CAST(unnest(generate_series({_AT("year")}, {_AT("year + 1")} - INTERVAL 15 minute, INTERVAL 15 minute)) AS TIMESTAMP) AS ts FROM {_YEARS}),
slot1 AS (SELECT *, market || '-' || year AS curve_id, CAST(lt AS DATE) AS d, CAST(hour(lt) AS INT) AS hour, CAST(minute(lt) // 15 + 1 AS INT) AS quarter FROM (SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}' AS lt FROM slot0)),
scal AS ({cal.sql("slot1")}), slot2 AS (SELECT s.*, season, CASE market WHEN 'CH' THEN day_type_ch ELSE day_type_de END AS day_type FROM slot1 s JOIN scal USING (d)),
mlev AS (SELECT * FROM (SELECT g.market, g.m AS month_start, coalesce(m.price, q.price, y.price, y1.price, y2.price) AS base FROM (SELECT market, CAST(unnest(generate_series(make_date(year, 1, 1), make_date(year, 12, 1), INTERVAL 1 month)) AS DATE) AS m FROM {_YEARS}) g
  LEFT JOIN quotes m ON m.market = g.market AND m.year = year(g.m) AND m.month = month(g.m) LEFT JOIN quotes q ON q.market = g.market AND q.year = year(g.m) AND q.quarter = quarter(g.m)
  LEFT JOIN quotes y ON y.market = g.market AND y.year = year(g.m) AND y.quarter IS NULL AND y.month IS NULL LEFT JOIN quotes y1 ON y1.market = g.market AND y1.year = year(g.m) - 1 AND y1.quarter IS NULL AND y1.month IS NULL
  LEFT JOIN quotes y2 ON y2.market = g.market AND y2.year = year(g.m) - 2 AND y2.quarter IS NULL AND y2.month IS NULL) WHERE base IS NOT NULL),
{cubic_sql("mlev", "month_start", "base")},
ends2 AS (SELECT market, min(x) AS lo, max(x1) AS hi FROM pieces WHERE x1 IS NOT NULL GROUP BY market),
smooth AS (SELECT curve_id, s.ts, (2 * t * t * t - 3 * t * t + 1) * y + (t * t * t - 2 * t * t + t) * h * m + (3 * t * t - 2 * t * t * t) * y1 + (t * t * t - t * t) * h * m1 AS smooth FROM (
  SELECT s.curve_id, s.ts, (s.n - p.x) / (p.x1 - p.x) AS t, p.x1 - p.x AS h, y, y1, m, m1 FROM (SELECT *, date_diff('day', DATE '1970-01-01', d) + (hour(lt) * 60 + minute(lt)) / 1440.0 AS n FROM slot2) s JOIN ends2 e USING (market)
  JOIN (SELECT * FROM pieces WHERE x1 IS NOT NULL) p ON p.market = s.market AND (s.n >= p.x OR p.x = e.lo) AND (s.n < p.x1 OR p.x1 = e.hi)) s),
usual AS (SELECT weekofyear(week) AS w, avg(fill_pct) AS typical FROM hydro GROUP BY ALL),
wdev AS (SELECT x.d, h.fill_pct - u.typical AS dev FROM (SELECT DISTINCT d FROM slot2) x ASOF LEFT JOIN hydro h ON x.d >= h.week LEFT JOIN usual u ON u.w = weekofyear(h.week)),
swv AS (SELECT curve_id, ts, greatest(0.8, least(1.2, raw / avg(raw) OVER (PARTITION BY curve_id))) AS f_wv FROM (SELECT curve_id, ts, greatest(0.8, least(1.2, 1.0 + 0.03 * coalesce(dev / 5, 0) * CASE season WHEN 'Hiver' THEN -0.8 WHEN 'Printemps' THEN -0.3 WHEN 'Ete' THEN -0.1 ELSE -0.5 END)) AS raw FROM slot2 JOIN wdev USING (d))),
sseries AS (SELECT 'CH' AS market, min(series) AS series FROM spot UNION ALL SELECT 'DE', max(series) FROM spot),
slot3 AS (SELECT s.*, greatest(m.smooth, 1.0) AS base, coalesce(w.f, 1.0) AS w0, greatest(0.4, least(2.0, coalesce(h.f, 1.0))) AS h0, coalesce(q.f, 1.0) AS q0, v.f_wv FROM slot2 s JOIN sseries USING (market) LEFT JOIN smooth m USING (curve_id, ts) JOIN swv v USING (curve_id, ts)
  LEFT JOIN fwall w ON w.market = s.market AND w.season = s.season AND w.day_type = s.day_type LEFT JOIN fh_all h ON h.series = sseries.series AND h.season = s.season AND h.day_type = s.day_type AND h.hour = s.hour
  LEFT JOIN fq q ON q.series = sseries.series AND q.season = s.season AND q.day_type = s.day_type AND q.hour = s.hour AND q.quarter = s.quarter),
slots AS (SELECT *, base * f_w * f_h * f_q * f_wv AS raw FROM (SELECT *, w0 / avg(w0) OVER (PARTITION BY curve_id, month(lt)) AS f_w, h0 / avg(h0) OVER (PARTITION BY curve_id, d) AS f_h, q0 / avg(q0) OVER (PARTITION BY curve_id, date_trunc('hour', ts)) AS f_q FROM slot3))"""


@query("crv7_product", "SELECT curve_id, CAST(ts AS VARCHAR) AS ts, round(base, 5) AS base, round(f_w, 6) AS f_w, round(f_h, 6) AS f_h, round(f_q, 6) AS f_q, round(f_wv, 6) AS f_wv, round(raw, 4) AS price FROM slots", SLOTS)
def crv7(t):
    """Base level and factors of every quarter of an hour, and their product (f_s is 1)."""
    return factor_curve(t).select("curve_id", S("ts"), R("base", "base", 5), *(R(c, c) for c in ("f_w", "f_h", "f_q", "f_wv")), R("raw", "price", 4))


def slot_contracts(t, slots):
    """Contracts of each curve (curve_id, contract_id, start, end, load, price): all base quotes of its year, and the peak and
    off-peak pairs of its months, whose off-peak price follows from the curve's own slots, in place of those months' base."""
    keys = ["market", "year", "month"]
    counts = slots.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_peak").alias("n_peak"))
    base = forwards.level_of(t.quotes.select("market", "year").distinct().join(month_hours(t).select("year", "quarter", "month"), "year"), t.quotes, "base").select(*keys, "base")
    peaks = contracts(t).where("load = 'Peak'").select(*keys, F.col("price").alias("peak"))
    paired = peaks.join(base, keys).join(counts, keys).where("n > n_peak AND n_peak > 0")
    rest = forwards.offpeak(F.col("base"), F.col("peak"), F.col("n"), F.col("n_peak"))
    sides = F.inline(F.array(*(F.struct(F.lit(load).alias("load"), price.alias("price")) for load, price in (("Peak", F.col("peak")), ("Offpeak", rest)))))
    # a pair stands for its month's level, which is its quarter's or year's where the month has no quote: then the longer contract
    # is met only if its other months are free to make up for it, so pairs are kept for months with quotes of their own
    own = t.quotes.where("month IS NOT NULL").select(*keys)
    pairs = paired.join(own, keys, "left_semi").select(*keys, F.lit(None).cast("int").alias("quarter"), sides)
    alone = t.quotes.withColumn("load", F.lit("Base")).join(pairs.select(*keys).distinct(), keys, "left_anti")
    every = alone.select("market", "year", "quarter", "month", "load", "price").unionByName(pairs)
    first = F.make_date("year", F.coalesce("month", F.col("quarter") * 3 - 2, F.lit(1)), F.lit(1))
    long = F.when(F.col("month").isNotNull(), 1).when(F.col("quarter").isNotNull(), 3).otherwise(12)
    name = F.concat_ws("-", tg.key_of(F.col("year"), F.col("quarter"), F.col("month")), "load")
    utc = lambda d: tg.to_utc(d.cast("timestamp_ntz"), ZONE)
    return every.select(F.concat_ws("-", "market", F.col("year").cast("string")).alias("curve_id"), name.alias("contract_id"), utc(first).alias("start"), utc(F.add_months(first, long)).alias("end"), "load", "price")


def full_curve(t):
    """The curve table: price and its factors, profile type, confidence, whether the contracts are met, and bands.

    Horizons count from the first month of the curve's delivery year. A curve that misses a contract by more than the greatest
    miss keeps its product price, and its flag is false."""
    slots = t.settled("slots", lambda: factor_curve(t))
    found = t.settled("slot_contracts", lambda: slot_contracts(t, slots))
    met = curve.calibrate(slots.withColumnRenamed("raw", "price"), found, flag="met").withColumn("is_calibrated", F.coalesce("met", F.lit(False)))
    shape = bands(t).join(shape_series(t), "series").drop("series")
    rows = met.join(shape, ["market", "hour"], "left").fillna({"p10": 0.85, "p50": 1.0, "p90": 1.15})
    months = tg.months_between(F.make_date("year", F.lit(1), F.lit(1)), F.col("d"))
    price = F.col("calibrated")
    low, high = shapes.banded(price, F.col("p10"), F.col("p50"), F.col("p90"), tg.step_lookup(months, tg.WIDENING, 4.2))
    kind = F.when(months <= 6, "M+1..M+6").when(months <= 12, "M+7..M+12").otherwise("Y+2/Y+3")
    return rows.select(
        "curve_id", "market", "ts", "is_peak", price.alias("price_shape"), "base", "f_s", "f_w", "f_h", "f_q", "f_wv", kind.alias("profile_type"),
        tg.step_lookup(months, tg.CONFIDENCE, 0.45).alias("confidence"), F.col("is_calibrated").alias("calibrated"), low.alias("p10"), high.alias("p90"),
    )


@query("crv12_curve")
def crv12(t):
    numbers = ("base", "f_s", "f_w", "f_h", "f_q", "f_wv", "p10", "p90")
    return full_curve(t).select("curve_id", S("ts"), R("price_shape", "price_shape", 4), *(R(c, c, 5) for c in numbers), "profile_type", "confidence", "calibrated")
