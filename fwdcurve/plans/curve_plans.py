"""Queries FWD1-FWD14 and CRV1-CRV18: contracts, cascade, assembly, calibration, variants."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import timegrid as tg
from ..operators import curve, forwards, joins
from ..operators import windows as win
from ..sources import writers
from .registry import query
from .shape_plans import BANDS, DAYS, FW, FWS, bands, seasonal_factor
from .table_plans import FULL, HOUR_WAYS, HOURLY, LOOKUP, PAIR, YEARLY, full_years, hourly, market_hours, pair
from .time_plans import HOURS, R, S, month_hours

RATIO = f"""{YEARLY}, {FULL}, rat AS (SELECT p.market, p.year, p.kind, p.no, p.m / y.mean AS ratio FROM (
  SELECT market, CAST(year(d) AS INT) AS year, 'quarter' AS kind, CAST(quarter(d) AS INT) AS no, avg(price) AS m FROM daily GROUP BY ALL UNION ALL
  SELECT market, CAST(year(d) AS INT), 'month', CAST(month(d) AS INT), avg(price) FROM daily GROUP BY ALL) p JOIN full_years y USING (market, year)),
mrat AS (SELECT market, kind, no, avg(ratio) AS ratio FROM rat GROUP BY ALL)"""
CASC = f"""{HOURS}, {RATIO}, qh AS (SELECT year, quarter, sum(hours) AS hours FROM mh GROUP BY ALL),
cq0 AS (SELECT y.market, y.year, qh.quarter, qh.hours, coalesce(r.ratio, 1) AS ratio, k.price AS quoted, y.price AS parent FROM (SELECT * FROM quotes WHERE quarter IS NULL AND month IS NULL) y JOIN qh USING (year)
  LEFT JOIN mrat r ON r.market = y.market AND r.kind = 'quarter' AND r.no = qh.quarter LEFT JOIN quotes k ON k.market = y.market AND k.year = y.year AND k.quarter = qh.quarter),
cq AS (SELECT market, year, quarter, hours, coalesce(quoted, (parent * sum(hours) OVER w - sum(coalesce(quoted * hours, 0)) OVER w) * ratio / nullif(sum(CASE WHEN quoted IS NULL THEN ratio * hours END) OVER w, 0)) AS price, quoted IS NULL AS derived FROM cq0 WINDOW w AS (PARTITION BY market, year)),
cm0 AS (SELECT q.market, q.year, q.quarter, mh.month, mh.hours, coalesce(r.ratio, 1) AS ratio, k.price AS quoted, q.price AS parent FROM cq q JOIN mh USING (year, quarter)
  LEFT JOIN mrat r ON r.market = q.market AND r.kind = 'month' AND r.no = mh.month LEFT JOIN quotes k ON k.market = q.market AND k.year = q.year AND k.month = mh.month),
cm AS (SELECT market, year, quarter, month, hours, coalesce(quoted, (parent * sum(hours) OVER w - sum(coalesce(quoted * hours, 0)) OVER w) * ratio / nullif(sum(CASE WHEN quoted IS NULL THEN ratio * hours END) OVER w, 0)) AS price, quoted IS NULL AS derived FROM cm0 WINDOW w AS (PARTITION BY market, year, quarter))"""


def ratios(t):
    return forwards.seasonal_ratios(t.daily, full_years(t))


def quarters(t):
    return forwards.cascade_quarters(t.quotes, month_hours(t), forwards.mean_ratios(ratios(t)))


def months(t):
    return forwards.cascade_months(quarters(t), t.quotes, month_hours(t), forwards.mean_ratios(ratios(t)))


LOADS = f"""{HOURLY}, {HOUR_WAYS}, lhours AS (SELECT market, d, price, ((d + to_hours(hour)) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Zurich' AS lt FROM mhours),
phours AS (SELECT market, d, price, CAST(year(lt) AS INT) AS year, CAST(quarter(lt) AS INT) AS quarter, CAST(month(lt) AS INT) AS month, isodow(lt) <= 5 AND hour(lt) BETWEEN 8 AND 19 AS peak FROM lhours)"""


def load_hours(t):
    """(market, d, year, quarter, month, price, is_peak): the hours of the daily prices in local time, peak from Monday to
    Friday, 8 to 20."""
    local = tg.local_time(F.col("d").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("hour")))
    part = lambda f, name: f("lt").alias(name)
    build = lambda: market_hours(t).withColumn("lt", local).select("market", "d", part(F.year, "year"), part(F.quarter, "quarter"), part(F.month, "month"), "price", tg.peak_weekday(F.col("lt")).alias("is_peak"))
    return t.settled("load_hours", build)


PROXY = f"""{LOADS}, lasts AS (SELECT market, max(d) AS last FROM daily GROUP BY market),
froms AS (SELECT market, CASE WHEN count(*) FILTER (d > last - INTERVAL {forwards.SHAPE_DAYS} day) >= 180 THEN any_value(last) - INTERVAL {forwards.SHAPE_DAYS} day ELSE DATE '0001-01-01' END AS since FROM daily JOIN lasts USING (market) GROUP BY market),
pyears AS (SELECT market, CAST(year(last) + 1 + i AS INT) AS year, anchor * pow(1 + decay, i) AS level FROM lasts
  JOIN (SELECT market, avg(price) AS anchor FROM daily JOIN lasts USING (market) WHERE d > last - INTERVAL {forwards.ANCHOR_DAYS} day GROUP BY market) USING (market)
  JOIN (SELECT market, CASE WHEN count(c) >= 2 THEN greatest(-0.10, least(0.0, median(c))) ELSE -0.03 END AS decay FROM (SELECT market, mean / lag(mean) OVER (PARTITION BY market ORDER BY year) - 1 AS c FROM yearly) GROUP BY market) USING (market), range(4) r(i)),
pmonths AS (SELECT market, month, CASE WHEN abs(avg(m) OVER (PARTITION BY market)) < 1 THEN 1.0 ELSE m / avg(m) OVER (PARTITION BY market) END AS share FROM (SELECT market, CAST(month(d) AS INT) AS month, avg(price) AS m FROM daily JOIN froms USING (market) WHERE d > since GROUP BY ALL)),
ppeaks AS (SELECT market, month, avg(price) FILTER (peak) / avg(price) AS ratio FROM phours JOIN froms USING (market) WHERE d > since GROUP BY ALL HAVING avg(price) > 0),
pgrid AS (SELECT y.market, year, CAST(ceil(month / 3.0) AS INT) AS quarter, month, level * coalesce(share, 1.0) AS base, level * coalesce(share, 1.0) * coalesce(ratio, {forwards.PROXY_PEAK}) AS peak
  FROM (SELECT *, CAST(unnest(range(1, 13)) AS INT) AS month FROM pyears) y LEFT JOIN pmonths USING (market, month) LEFT JOIN ppeaks USING (market, month)),
prox AS (SELECT market, year, NULL::INT AS quarter, NULL::INT AS month, level AS base, NULL::DOUBLE AS peak FROM pyears UNION ALL SELECT market, year, quarter, NULL, avg(base), avg(peak) FROM pgrid GROUP BY ALL UNION ALL SELECT market, year, NULL, month, base, peak FROM pgrid)"""


@query("fwd1_spot_proxy", "SELECT market, year, quarter, month, round(base, 6) AS base, round(peak, 6) AS peak FROM prox", f"{YEARLY}, {PROXY}")
def fwd1(t):
    """Yearly, quarterly and monthly quotes, the latter two with peaks, of the four years after a market's last price."""
    return forwards.proxy_quotes(t.daily, load_hours(t)).select("market", "year", "quarter", "month", R("base", "base"), R("peak", "peak"))


@query("fwd2_seasonal_ratios", "SELECT market, kind, no, round(ratio, 6) AS ratio FROM mrat", RATIO)
def fwd2(t):
    return forwards.mean_ratios(ratios(t)).select("market", "kind", "no", R("ratio", "ratio"))


TREND = "SELECT market, kind, no, avg(ratio) AS base, regr_slope(ratio, year::DOUBLE) AS slope, max(year) AS last FROM rat GROUP BY ALL HAVING count(*) >= 3"


@query("fwd3_ratio_trend", f"SELECT market, kind, no, round(base + greatest(-0.2 * base, least(0.2 * base, slope * (2004 - last))), 6) AS ratio FROM ({TREND})", RATIO)
def fwd3(t):
    r = ratios(t).groupBy("market", "kind", "no").agg(F.avg("ratio").alias("base"), F.regr_slope("ratio", F.col("year").cast("double")).alias("slope"), F.max("year").alias("last"), F.count(F.lit(1)).alias("n"))
    return r.where("n >= 3").select("market", "kind", "no", R(forwards.trended_ratio(F.col("base"), F.col("slope"), F.lit(2004) - F.col("last")), "ratio"))


PEAKR = """pr AS (SELECT market, month, avg(ratio) AS ratio FROM (SELECT market, year, month, avg(price) FILTER (peak) / avg(price) AS ratio FROM phours JOIN full_years USING (market, year) GROUP BY ALL HAVING count(*) >= 24 AND avg(price) > 0) WHERE ratio IS NOT NULL GROUP BY ALL)"""


def peak_ratios(t):
    return t.settled("peak_ratios", lambda: forwards.peak_ratios(load_hours(t), full_years(t)))


@query("fwd4_peak_ratio", "SELECT market, month, round(ratio, 6) AS ratio FROM pr", f"{YEARLY}, {FULL}, {LOADS}, {PEAKR}")
def fwd4(t):
    return peak_ratios(t).select("market", "month", R("ratio", "ratio"))


PEAKQ = f"""{PEAKR}, peakq AS (SELECT market, year, CASE WHEN month IS NULL THEN quarter END AS quarter, month, peak FROM (SELECT market, year, quarter, month, avg(price) AS peak FROM phours WHERE peak GROUP BY GROUPING SETS ((market, year), (market, year, quarter), (market, year, quarter, month)))
  WHERE year % 4 = 0 AND (quarter IS NULL OR (quarter = 2 AND month IS NULL) OR month = 1)),
pers AS (SELECT market, CASE WHEN month IS NULL THEN quarter END AS quarter, month, avg(ratio) AS ratio FROM (SELECT market, CAST(ceil(month / 3.0) AS INT) AS quarter, month, coalesce(ratio, {forwards.DEFAULT_PEAK}) AS ratio
  FROM (SELECT DISTINCT market, CAST(unnest(range(1, 13)) AS INT) AS month FROM daily) LEFT JOIN pr USING (market, month)) GROUP BY GROUPING SETS ((market), (market, quarter), (market, quarter, month))),
lq AS (SELECT q.market, CAST(q.year AS INT) AS year, CAST(q.quarter AS INT) AS quarter, CAST(q.month AS INT) AS month, q.price, coalesce(p.peak, q.price * coalesce(r.ratio, {forwards.DEFAULT_PEAK})) AS peak, p.peak IS NULL AS synthetic FROM quotes q
  LEFT JOIN peakq p ON p.market = q.market AND p.year = q.year AND p.quarter IS NOT DISTINCT FROM q.quarter AND p.month IS NOT DISTINCT FROM q.month LEFT JOIN pers r ON r.market = q.market AND r.quarter IS NOT DISTINCT FROM q.quarter AND r.month IS NOT DISTINCT FROM q.month)"""


def peak_quotes(t):
    """Quoted peaks: every fourth year has one of the year, of the second quarter and of January."""
    rows = load_hours(t).where("is_peak")
    sets = rows.groupingSets([["market", "year"], ["market", "year", "quarter"], ["market", "year", "quarter", "month"]], "market", "year", "quarter", "month").agg(F.avg("price").alias("peak"))
    sets = sets.where((F.col("year") % 4 == 0) & (F.col("quarter").isNull() | (F.col("month").isNull() & (F.col("quarter") == 2)) | (F.col("month") == 1)))
    return sets.select("market", "year", F.when(F.col("month").isNull(), F.col("quarter")).alias("quarter"), "month", "peak")


def load_quotes(t):
    """quotes with a peak price each, quoted or synthetic."""
    return forwards.with_peaks(t.quotes, peak_quotes(t), forwards.period_ratios(peak_ratios(t), t.daily.select("market").distinct()))


@query("fwd5_missing_peaks", "SELECT market, year, quarter, month, round(price, 6) AS base, round(peak, 6) AS peak, synthetic FROM lq", f"{YEARLY}, {FULL}, {LOADS}, {PEAKQ}")
def fwd5(t):
    """A peak price for every base quote: its own, or the base price by the ratios of its months."""
    return load_quotes(t).select("market", "year", "quarter", "month", R("price", "base"), R("peak", "peak"), "synthetic")


QCOLS = "market, CAST(year AS INT) AS year, quarter, CAST(hours AS BIGINT) AS hours, round(price, 6) AS price, derived"


@query("fwd6_cascade_full", f"SELECT {QCOLS} FROM cq WHERE year % 2 = 1", CASC)
def fwd6(t):
    return quarters(t).where("year % 2 = 1").select("market", "year", "quarter", "hours", R("price", "price"), "derived")


@query("fwd7_cascade_partial", f"SELECT {QCOLS} FROM cq WHERE year % 2 = 0", CASC)
def fwd7(t):
    return quarters(t).where("year % 2 = 0").select("market", "year", "quarter", "hours", R("price", "price"), "derived")


@query("fwd8_cascade_months", "SELECT market, CAST(year AS INT) AS year, quarter, month, hours, round(price, 6) AS price, derived FROM cm", CASC)
def fwd8(t):
    return months(t).select("market", "year", "quarter", "month", "hours", R("price", "price"), "derived")


@query("fwd9_whole_cascade", "SELECT market, CAST(year AS INT) AS year, NULL::INT AS quarter, NULL::INT AS month, round(price, 6) AS price FROM quotes WHERE quarter IS NULL AND month IS NULL UNION ALL SELECT market, CAST(year AS INT), quarter, NULL, round(price, 6) FROM cq UNION ALL SELECT market, CAST(year AS INT), NULL, month, round(price, 6) FROM cm", CASC)
def fwd9(t):
    null = F.lit(None).cast("int")
    years = t.quotes.where("quarter IS NULL AND month IS NULL").select("market", "year", null.alias("quarter"), null.alias("month"), "price")
    q = quarters(t).select("market", "year", "quarter", null.alias("month"), "price")
    m = months(t).select("market", "year", null.alias("quarter"), "month", "price")
    return years.unionByName(q).unionByName(m).select("market", "year", "quarter", "month", R("price", "price"))


@query("fwd10_conservation", "SELECT q.market, CAST(q.year AS INT) AS year, q.quarter, round(any_value(q.price), 5) AS price, round(sum(m.price * m.hours) / sum(m.hours), 5) AS implied, abs(sum(m.price * m.hours) / sum(m.hours) - any_value(q.price)) <= 0.001 AS conserved FROM cq q JOIN cm m USING (market, year, quarter) GROUP BY q.market, q.year, q.quarter", CASC)
def fwd10(t):
    out = forwards.conservation(months(t), quarters(t).select("market", "year", "quarter", "price"), ["market", "year", "quarter"])
    return out.select("market", "year", "quarter", R("price", "price", 5), R("implied", "implied", 5), "conserved")


LOADC = f"""{CASC}, {LOADS}, {PEAKQ},
pq AS (SELECT year, quarter, sum(peak_hours) AS hours FROM mh GROUP BY ALL),
pk AS (SELECT market, CASE WHEN month IS NULL THEN 'quarter' ELSE 'month' END AS kind, coalesce(month, quarter) AS no, m.ratio * p.ratio AS ratio FROM pers p JOIN mrat m USING (market) WHERE coalesce(p.month, p.quarter) = m.no AND m.kind = CASE WHEN p.month IS NULL THEN 'quarter' ELSE 'month' END),
pc0 AS (SELECT y.market, y.year, pq.quarter, pq.hours, coalesce(r.ratio, 1) AS ratio, k.peak AS quoted, y.peak AS parent FROM (SELECT * FROM lq WHERE quarter IS NULL AND month IS NULL) y JOIN pq USING (year)
  LEFT JOIN pk r ON r.market = y.market AND r.kind = 'quarter' AND r.no = pq.quarter LEFT JOIN peakq k ON k.market = y.market AND k.year = y.year AND k.quarter = pq.quarter),
pc AS (SELECT market, year, quarter, coalesce(quoted, (parent * sum(hours) OVER w - sum(coalesce(quoted * hours, 0)) OVER w) * ratio / nullif(sum(CASE WHEN quoted IS NULL THEN ratio * hours END) OVER w, 0)) AS price FROM pc0 WINDOW w AS (PARTITION BY market, year)),
pm0 AS (SELECT q.market, q.year, q.quarter, mh.month, mh.peak_hours AS hours, coalesce(r.ratio, 1) AS ratio, k.peak AS quoted, q.price AS parent FROM pc q JOIN mh USING (year, quarter)
  LEFT JOIN pk r ON r.market = q.market AND r.kind = 'month' AND r.no = mh.month LEFT JOIN peakq k ON k.market = q.market AND k.year = q.year AND k.month = mh.month),
pm AS (SELECT market, year, quarter, month, coalesce(quoted, (parent * sum(hours) OVER w - sum(coalesce(quoted * hours, 0)) OVER w) * ratio / nullif(sum(CASE WHEN quoted IS NULL THEN ratio * hours END) OVER w, 0)) AS price FROM pm0 WINDOW w AS (PARTITION BY market, year, quarter)),
lm AS (SELECT c.market, CAST(c.year AS INT) AS year, c.quarter, c.month, c.hours, mh.peak_hours, c.price AS base, pm.price AS peak, (c.price * c.hours - pm.price * mh.peak_hours) / nullif(c.hours - mh.peak_hours, 0) AS offpeak FROM cm c JOIN pm USING (market, year, quarter, month) JOIN mh USING (year, quarter, month))"""


def load_months(t):
    """Base, peak and off-peak price of every month: both cascades, the peaks' by peak hours."""
    pers = forwards.period_ratios(peak_ratios(t), t.daily.select("market").distinct()).where("quarter IS NOT NULL OR month IS NOT NULL")
    pers = pers.select("market", F.when(F.col("month").isNull(), "quarter").otherwise("month").alias("kind"), F.coalesce("month", "quarter").alias("no"), F.col("ratio").alias("peak_ratio"))
    shares = forwards.mean_ratios(ratios(t)).join(pers, ["market", "kind", "no"]).select("market", "kind", "no", (F.col("ratio") * F.col("peak_ratio")).alias("ratio"))
    quoted = peak_quotes(t).withColumnRenamed("peak", "price")
    years = load_quotes(t).where("quarter IS NULL AND month IS NULL").select("market", "year", "quarter", "month", F.col("peak").alias("price"))
    peaks = years.unionByName(quoted.where("quarter IS NOT NULL OR month IS NOT NULL"))
    of, shares = t.settled("month_hours", lambda: month_hours(t)), t.settled("peak_shares", lambda: shares)
    peaks, by_peak = t.settled("peaks", lambda: peaks), of.withColumn("hours", F.col("peak_hours"))
    peak = forwards.cascade_months(forwards.cascade_quarters(peaks, by_peak, shares), peaks, by_peak, shares)
    return forwards.load_months(t.settled("months", lambda: months(t)), peak, of)


@query("fwd11_offpeak_identity", "SELECT market, year, quarter, month, round(sum(base * hours) / sum(hours), 6) AS base, round(sum(peak * peak_hours) / sum(peak_hours), 6) AS peak, round(sum(offpeak * (hours - peak_hours)) / sum(hours - peak_hours), 6) AS offpeak FROM lm GROUP BY GROUPING SETS ((market, year), (market, year, quarter), (market, year, quarter, month))", LOADC)
def fwd11(t):
    """Base, peak and off-peak price of every month, quarter and year; hour by hour the latter two make up the first."""
    mean = lambda price, hours: F.sum(F.col(price) * hours) / F.sum(hours)
    rest = F.col("hours") - F.col("peak_hours")
    sets = load_months(t).groupingSets([["market", "year"], ["market", "year", "quarter"], ["market", "year", "quarter", "month"]], "market", "year", "quarter", "month")
    return sets.agg(R(mean("base", F.col("hours")), "base"), R(mean("peak", F.col("peak_hours")), "peak"), R(mean("offpeak", rest), "offpeak"))


@query("fwd12_contract_specs", "SELECT market, CAST(year AS INT) AS year, month, CAST((make_timestamp(year, month, 1, 0, 0, 0.0) AT TIME ZONE 'Europe/Zurich') AT TIME ZONE 'UTC' AS VARCHAR) AS start_utc, CAST((make_timestamp(CASE WHEN month = 12 THEN year + 1 ELSE year END, month % 12 + 1, 1, 0, 0, 0.0) AT TIME ZONE 'Europe/Zurich') AT TIME ZONE 'UTC' AS VARCHAR) AS end_utc, hours FROM cm", CASC)
def fwd12(t):
    start = F.make_date("year", "month", F.lit(1))
    utc = lambda d: tg.to_utc(d.cast("timestamp_ntz")).cast("string")
    return months(t).select("market", "year", "month", utc(start).alias("start_utc"), utc(F.add_months(start, 1)).alias("end_utc"), "hours")


def contracts(t):
    """Disjoint contracts of each month: peak and off-peak where a peak is quoted for the month, its quarter or its year, else base."""
    mh = month_hours(t)
    grid = t.quotes.select("market", "year").distinct().join(mh.select("year", "quarter", "month"), "year")
    peaks = forwards.level_of(grid, peak_quotes(t).withColumnRenamed("peak", "price"), "peak").where("peak IS NOT NULL")
    return forwards.monthly_contracts(t.quotes, peaks, mh)


_LEVEL = """LEFT JOIN {0} m ON m.market = g.market AND m.year = g.year AND m.month = g.month LEFT JOIN {0} q ON q.market = g.market AND q.year = g.year AND q.quarter = g.quarter AND q.month IS NULL
  LEFT JOIN {0} a ON a.market = g.market AND a.year = g.year AND a.quarter IS NULL AND a.month IS NULL"""
CONTRACTS = f"""ctg AS (SELECT DISTINCT k.market, CAST(k.year AS INT) AS year, mh.quarter, mh.month, mh.hours, mh.peak_hours FROM quotes k JOIN mh USING (year)),
ctb AS (SELECT g.*, coalesce(m.price, q.price, a.price) AS base FROM ctg g {_LEVEL.format("quotes")}),
ctp AS (SELECT g.*, coalesce(m.peak, q.peak, a.peak) AS peak FROM ctb g {_LEVEL.format("peakq")}),
ct AS (SELECT market, year, month, 'Peak' AS load, peak AS price, peak_hours AS hours FROM ctp WHERE peak IS NOT NULL
  UNION ALL SELECT market, year, month, 'Offpeak', (base * hours - peak * peak_hours) / (hours - peak_hours), hours - peak_hours FROM ctp WHERE peak IS NOT NULL
  UNION ALL SELECT market, year, month, 'Base', base, hours FROM ctp WHERE peak IS NULL)"""


@query("fwd13_disjoint_contracts", "SELECT market, year, month, load, round(price, 6) AS price, hours FROM ct WHERE price IS NOT NULL", f"{HOURS}, {YEARLY}, {FULL}, {LOADS}, {PEAKQ}, {CONTRACTS}")
def fwd13(t):
    return contracts(t).select("market", "year", "month", "load", R("price", "price"), "hours")


HISTORY = f"""hq AS (SELECT x.market, quoted, CAST(year(quoted + to_months(k)) AS INT) AS year, CAST(month(quoted + to_months(k)) AS INT) AS month, level * coalesce(r.ratio, 1) AS base, level * coalesce(r.ratio, 1) * coalesce(p.ratio, {forwards.DEFAULT_PEAK}) AS peak
  FROM (SELECT c.market, c.quoted, k, avg(x.price) AS level FROM (SELECT DISTINCT market, CAST(date_trunc('month', d) AS DATE) AS quoted FROM daily) c JOIN daily x ON x.market = c.market AND x.d < c.quoted AND x.d >= c.quoted - INTERVAL 90 day, (SELECT CAST(unnest(range(1, 4)) AS INT) AS k) GROUP BY ALL) x
  LEFT JOIN mrat r ON r.market = x.market AND r.kind = 'month' AND r.no = month(quoted + to_months(k)) LEFT JOIN pr p ON p.market = x.market AND p.month = month(quoted + to_months(k)))"""


def quote_history(t):
    """(market, quoted, year, month, base, peak): at each month's start the next three months, by the mean of the 90 days
    before and the month's ratios. A day is exploded into the months that look back on it."""
    days = t.daily.select("market", "d", "price", F.explode(F.sequence(F.add_months(F.trunc("d", "month"), 1), F.trunc(F.date_add("d", 90), "month"), F.expr("INTERVAL 1 MONTH"))).alias("quoted"))
    own = t.daily.select("market", F.trunc("d", "month").alias("quoted")).distinct()
    level = days.where(F.col("d") >= F.date_sub("quoted", 90)).join(own, ["market", "quoted"]).groupBy("market", "quoted").agg(F.avg("price").alias("level"))
    rows = level.withColumn("of", F.explode(F.array(*(F.add_months("quoted", k) for k in (1, 2, 3))))).withColumns({"year": F.year("of"), "month": F.month("of")})
    share = forwards.mean_ratios(ratios(t)).where("kind = 'month'").select("market", F.col("no").alias("month"), "ratio")
    rows = rows.join(share, ["market", "month"], "left").join(peak_ratios(t).withColumnRenamed("ratio", "peak_ratio"), ["market", "month"], "left")
    base = F.col("level") * F.coalesce("ratio", F.lit(1.0))
    return rows.select("market", "quoted", "year", "month", base.alias("base"), (base * F.coalesce("peak_ratio", F.lit(forwards.DEFAULT_PEAK))).alias("peak"))


@query("fwd14_quote_history", "SELECT market, CAST(quoted AS VARCHAR) AS quoted, printf('%d-%02d', year, month) AS product, round(base, 6) AS base, round(peak, 6) AS peak, round(base - lag(base) OVER (PARTITION BY market, year, month ORDER BY quoted), 6) + 0.0 AS change, quoted = max(quoted) OVER (PARTITION BY market) AS latest FROM hq", f"{RATIO}, {LOADS}, {PEAKR}, {HISTORY}")
def fwd14(t):
    """Each product's history: base and peak price at each date of quotation, the change since the one before, and
    whether it is the market's latest."""
    rows = quote_history(t)
    last = rows.groupBy("market").agg(F.max("quoted").alias("last"))
    change = F.col("base") - F.lag("base").over(Window.partitionBy("market", "year", "month").orderBy("quoted"))
    rows = rows.join(last, "market").withColumns({"change": change, "latest": F.col("quoted") == F.col("last")})
    return rows.select("market", S("quoted"), tg.key_of(F.col("year"), F.lit(None).cast("int"), F.col("month")).alias("product"), R("base", "base"), R("peak", "peak"), (R("change", "x") + 0.0).alias("change"), "latest")


@query("crv1_base_level", "SELECT market, CAST(d AS VARCHAR) AS d, round(base, 6) AS base FROM base", LOOKUP)
def crv1(t):
    return joins.base_lookup(t.daily, t.quotes).select("market", S("d"), R("base", "base"))


def month_means(t):
    return t.daily.groupBy(F.col("market").alias("key"), F.to_date(F.date_trunc("month", "d")).alias("month_start")).agg(F.avg("price").alias("base"))


def smoothed_days(t):
    return curve.smooth_base(t.daily.select(F.col("market").alias("key"), "d", "price"), month_means(t))


def _edge(a: str, b: str, d: str, e: str) -> str:
    raw = f"((2 * {a} + {b}) * {d} - {a} * {e}) / ({a} + {b})"
    return f"CASE WHEN {b} IS NULL THEN {d} WHEN sign({raw}) <> sign({d}) THEN 0.0 WHEN sign({d}) <> sign({e}) AND abs({raw}) > 3 * abs({d}) THEN 3 * {d} ELSE {raw} END"


def cubic_sql(source: str, month: str, level: str) -> str:
    """pieces: the cubics between knots at the middles of the months of source (market, month, level)."""
    return f"""knots AS (SELECT market, {level} AS y, date_diff('day', DATE '1970-01-01', CAST({month} AS DATE)) + day(last_day(CAST({month} AS DATE))) / 2.0 AS x FROM {source}),
steps AS (SELECT market, x, y, lead(x) OVER w - x AS h1, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS d1, x - lag(x) OVER w AS h0, (y - lag(y) OVER w) / (x - lag(x) OVER w) AS d0,
  lead(x, 2) OVER w - lead(x) OVER w AS h2, (lead(y, 2) OVER w - lead(y) OVER w) / (lead(x, 2) OVER w - lead(x) OVER w) AS d2, lag(x) OVER w - lag(x, 2) OVER w AS hm, (lag(y) OVER w - lag(y, 2) OVER w) / (lag(x) OVER w - lag(x, 2) OVER w) AS dm
  FROM knots WINDOW w AS (PARTITION BY market ORDER BY x)),
sloped AS (SELECT market, x, y, CASE WHEN d0 IS NULL AND d1 IS NULL THEN 0.0 WHEN d0 IS NULL THEN {_edge("h1", "h2", "d1", "d2")} WHEN d1 IS NULL THEN {_edge("h0", "hm", "d0", "dm")} WHEN d0 * d1 <= 0 THEN 0.0
  ELSE (3 * h1 + 3 * h0) / ((2 * h1 + h0) / d0 + (h1 + 2 * h0) / d1) END AS m FROM steps),
pieces AS (SELECT market, x, y, m, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(m) OVER w AS m1, min(x) OVER (PARTITION BY market) AS lo FROM sloped WINDOW w AS (PARTITION BY market ORDER BY x))"""


CUBIC = f"""mmeans AS (SELECT market, date_trunc('month', d) AS month_start, avg(price) AS base FROM daily GROUP BY ALL), {cubic_sql("mmeans", "month_start", "base")},
spans AS (SELECT *, max(x) OVER (PARTITION BY market) AS hi FROM pieces WHERE x1 IS NOT NULL),
cubic AS (SELECT p.market, p.d, (p.n - s.x) / (s.x1 - s.x) AS t, s.x1 - s.x AS h, y, y1, m, m1 FROM (SELECT market, d, date_diff('day', DATE '1970-01-01', d) AS n FROM daily) p
  LEFT JOIN spans s ON s.market = p.market AND p.n >= ceil(s.x) - CASE WHEN s.x = lo THEN 40 ELSE 0 END AND p.n <= ceil(s.x1) + CASE WHEN s.x = hi THEN 40 ELSE -1 END)"""


@query("crv2_smooth_base", "SELECT market, CAST(d AS VARCHAR) AS d, round((2 * t * t * t - 3 * t * t + 1) * y + (t * t * t - 2 * t * t + t) * h * m + (3 * t * t - 2 * t * t * t) * y1 + (t * t * t - t * t) * h * m1, 6) AS smooth FROM cubic", CUBIC)
def crv2(t):
    return smoothed_days(t).select(F.col("key").alias("market"), S("d"), R("smooth", "smooth"))


@query("crv3_month_restore")
def crv3(t):
    """The smooth base with knots moved so that each month keeps its mean."""
    work = writers.shared_folder(t.spark, "knots")

    def settle(table, k):
        table.write.parquet(f"{work}/{k}")
        return t.spark.read.schema(table.schema).parquet(f"{work}/{k}")

    rows = curve.restored_months(t.daily.select(F.col("market").alias("key"), "d", "price"), month_means(t), settle)
    return rows.select(F.col("key").alias("market"), S("d"), R("smooth", "restored"))


@query("crv4_positivity", "SELECT market, count(*) FILTER (price - 100 < 1) AS floored, round(min(greatest(price - 100, 1.0)), 6) AS low FROM daily GROUP BY market")
def crv4(t):
    x = F.col("price") - 100
    return t.daily.groupBy("market").agg(F.count_if(x < 1).alias("floored"), R(F.min(F.greatest(x, F.lit(1.0))), "low"))


@query("crv5_flat_season", "SELECT market, CAST(d AS VARCHAR) AS d, 1.0::DOUBLE AS f_s FROM daily")
def crv5(t):
    return t.daily.select("market", S("d"), F.lit(1.0).alias("f_s"))


FWM = f"{DAYS}, {FW}, {FWS}, dayf AS (SELECT x.market, x.d, x.price, coalesce(s.f, w.f, 1.0) AS f FROM wdays x LEFT JOIN fws s USING (market, season, day_type) LEFT JOIN fw w ON w.market = x.market AND w.day_type = x.day_type), fwm AS (SELECT market, d, price, f / avg(f) OVER (PARTITION BY market, year(d), month(d)) AS f_w FROM dayf)"


def day_factors(t):
    """daily with f_w: the seasonal day-type factor, mean 1 in each month."""
    rows = t.daily.join(t.calendar, "d")
    rows = rows.withColumn("day_type", F.when(F.col("market") == "CH", F.col("day_type_ch")).otherwise(F.col("day_type_de")))
    rows = rows.join(seasonal_factor(t), ["market", "season", "day_type"], "left").fillna(1.0, ["f"]).withColumns({"y": F.year("d"), "mon": F.month("d")})
    return rows.withColumn("f_w", win.normalised("f", ["market", "y", "mon"])).select("market", "d", "price", "f_w")


@query("crv6_day_factor", "SELECT market, CAST(d AS VARCHAR) AS d, round(f_w, 6) AS f_w FROM fwm", FWM)
def crv6(t):
    return day_factors(t).select("market", S("d"), R("f_w", "f_w"))


RAW = f"{FWM}, {LOOKUP}, curve AS (SELECT f.market, f.d, f.price AS spot, base, f_w, base * f_w AS raw FROM fwm f JOIN base b ON b.market = f.market AND b.d = f.d)"


def raw_curve(t):
    """(market, d, spot, base, f_w, raw): product of the base level and the factors."""
    base = joins.base_lookup(t.daily.select("market", "d"), t.quotes)
    rows = day_factors(t).withColumnRenamed("price", "spot").join(base, ["market", "d"])
    return rows.withColumn("raw", F.col("base") * F.col("f_w"))


def curve_slots(t):
    """Raw curve of each market with the regime of its days: working days stand for peak."""
    return raw_curve(t).select(F.col("market").alias("curve_id"), F.col("d").cast("timestamp_ntz").alias("ts"), (F.weekday("d") < 5).alias("is_peak"), F.col("raw").alias("price"), "spot")


def curve_contracts(t, slots):
    """All quotes as Base contracts, which overlap, and the Peak and Offpeak pairs of the quoted months with a peak price.

    The off-peak price is the one that peak and base imply by the curve's own slots, so a pair keeps its month's
    mean; it stands for the month's own quote. A month without off-peak slots has its base alone."""
    month, keys = F.to_date(F.date_trunc("month", "ts")), ["market", "year", "month"]
    counts = slots.groupBy(F.col("curve_id").alias("market"), F.year(month).alias("year"), F.month(month).alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_peak").alias("n_peak"))
    none = t.spark.createDataFrame([], "market string, year int, month int, peak double")
    base = forwards.monthly_contracts(t.quotes, none, month_hours(t)).select(*keys, F.col("price").alias("base"))
    peaks = contracts(t).where("load = 'Peak'").select(*keys, F.col("price").alias("peak"))
    # a month without a quote of its own is free to make up for what its quarter or year asks
    own = t.quotes.where("month IS NOT NULL").select(*keys)
    paired = peaks.join(own, keys, "left_semi").join(base, keys).join(counts, keys).where("n > n_peak")
    rest = forwards.offpeak(F.col("base"), F.col("peak"), F.col("n"), F.col("n_peak"))
    sides = F.inline(F.array(*(F.struct(F.lit(load).alias("load"), price.alias("price")) for load, price in (("Peak", F.col("peak")), ("Offpeak", rest)))))
    pairs = paired.select(*keys, F.lit(None).cast("int").alias("quarter"), sides)
    alone = t.quotes.withColumn("load", F.lit("Base")).join(paired.select(*keys), keys, "left_anti")
    every = alone.select("market", "year", "quarter", "month", "load", "price").unionByName(pairs)
    first = F.make_date("year", F.coalesce("month", F.col("quarter") * 3 - 2, F.lit(1)), F.lit(1))
    long = F.when(F.col("month").isNotNull(), 1).when(F.col("quarter").isNotNull(), 3).otherwise(12)
    name = F.concat_ws("-", tg.key_of(F.col("year"), F.col("quarter"), F.col("month")), "load")
    return every.select(F.col("market").alias("curve_id"), name.alias("contract_id"), first.cast("timestamp_ntz").alias("start"), F.add_months(first, long).cast("timestamp_ntz").alias("end"), "load", "price")


@query("crv8_calibration")
def crv8(t):
    work = writers.shared_folder(t.spark, "calibration")

    def settle(table, name):
        table.write.parquet(f"{work}/{name}")
        return t.spark.read.schema(table.schema).parquet(f"{work}/{name}")

    # the curve and its contracts are met more than once
    slots = settle(curve_slots(t), "slots")
    return curve.calibrate(slots, settle(curve_contracts(t, slots), "contracts")).select("curve_id", S("ts"), R("price", "price"), R("calibrated", "calibrated"))


RESC = f"{RAW}, mt AS (SELECT market, y, m, avg(spot) AS target FROM (SELECT *, year(d) AS y, month(d) AS m FROM curve) GROUP BY ALL), resc AS (SELECT c.market, c.d, c.y, c.m, mt.target, raw * target / avg(raw) OVER (PARTITION BY c.market, c.y, c.m) AS price FROM (SELECT *, year(d) AS y, month(d) AS m FROM curve) c JOIN mt ON mt.market = c.market AND mt.y = c.y AND mt.m = c.m)"


def rescaled_curve(t):
    rows = raw_curve(t).withColumns({"y": F.year("d"), "m": F.month("d")})
    rows = rows.withColumn("target", F.avg("spot").over(Window.partitionBy("market", "y", "m")))
    return rows.withColumn("price", curve.rescaled(rows, ["market", "y", "m"], "raw", "target"))


@query("crv9_exact_rescale", "SELECT market, CAST(d AS VARCHAR) AS d, round(price, 6) AS price FROM resc", RESC)
def crv9(t):
    return rescaled_curve(t).select("market", S("d"), R("price", "price"))


@query("crv10_residuals", "SELECT market, CAST(y AS INT) AS year, CAST(m AS INT) AS month, round(any_value(target), 6) AS target, round(avg(price), 6) AS achieved, round(abs(avg(price) - any_value(target)), 6) AS abs_error FROM resc GROUP BY market, y, m", RESC)
def crv10(t):
    out = curve.residuals(rescaled_curve(t), ["market", "y", "m"], "price", "target")
    return out.select("market", F.col("y").alias("year"), F.col("m").alias("month"), R("target", "target"), R("achieved", "achieved"), R("abs_error", "abs_error"))


@query("crv11_smoothness", "SELECT market, round(sum(b * b) / 1e6, 6) AS cost FROM (SELECT market, lag(price) OVER w - 2 * price + lead(price) OVER w AS b FROM daily WINDOW w AS (PARTITION BY market ORDER BY d)) GROUP BY market")
def crv11(t):
    return curve.second_difference_cost(t.daily, ["market"], "d", "price").select("market", R(F.col("cost") / 1e6, "cost"))


MET = f"""{RESC}, met AS (SELECT q.market, CAST(q.year AS INT) AS year, CAST(q.quarter AS INT) AS quarter, CAST(q.month AS INT) AS month, any_value(q.price) AS quote, avg(x.price) AS mean, count(*) / CAST(CASE WHEN q.month IS NOT NULL THEN day(last_day(make_date(CAST(q.year AS INT), CAST(q.month AS INT), 1)))
    WHEN q.quarter IS NOT NULL THEN date_diff('day', make_date(CAST(q.year AS INT), CAST(q.quarter * 3 - 2 AS INT), 1), CAST(make_date(CAST(q.year AS INT), CAST(q.quarter * 3 AS INT), 1) + INTERVAL 1 month AS DATE)) ELSE date_diff('day', make_date(CAST(q.year AS INT), 1, 1), make_date(CAST(q.year AS INT) + 1, 1, 1)) END AS DOUBLE) AS coverage
  FROM quotes q JOIN resc x ON x.market = q.market AND q.year = year(x.d) AND (q.quarter IS NULL OR q.quarter = quarter(x.d)) AND (q.month IS NULL OR q.month = month(x.d)) GROUP BY q.market, q.year, q.quarter, q.month)"""


def met_quotes(t):
    """(market, year, quarter, month, quote, mean, coverage): the rescaled curve's mean over each quote's days, and the part of
    the period's days that it has."""
    met = joins.contract_slots(t.quotes, rescaled_curve(t).select("market", "d", "price"))
    first = F.make_date("year", F.coalesce("month", F.col("quarter") * 3 - 2, F.lit(1)), F.lit(1))
    long = F.when(F.col("month").isNotNull(), 1).when(F.col("quarter").isNotNull(), 3).otherwise(12)
    rows = met.groupBy("market", "year", "quarter", "month").agg(F.first("price").alias("quote"), F.avg("slot_price").alias("mean"), F.count(F.lit(1)).alias("n"))
    return rows.withColumn("coverage", F.col("n") / F.datediff(F.add_months(first, long), first))


@query("crv13_consistency", f"SELECT market, year, quarter, month, round(coverage, 6) AS coverage, round(mean / quote - 1, 6) + 0.0 AS gap, CASE WHEN coverage >= {curve.FULL_COVERAGE} THEN abs(mean / quote - 1) <= {curve.CLOSE} END AS consistent, CASE WHEN coverage >= {curve.FAIR_COVERAGE} THEN abs(mean / quote - 1) <= {curve.FAIR} END AS acceptable FROM met", MET)
def crv13(t):
    """Gap between curve and quote of each year, quarter and month; judged closely where the curve covers the period, loosely where
    it covers most of it, else not at all."""
    gap, covered = F.col("mean") / F.col("quote") - 1, F.col("coverage")
    judged = lambda least, most: F.when(covered >= least, F.abs(gap) <= most)
    return met_quotes(t).select("market", "year", "quarter", "month", R("coverage", "coverage"), (R(gap, "x") + 0.0).alias("gap"), judged(curve.FULL_COVERAGE, curve.CLOSE).alias("consistent"), judged(curve.FAIR_COVERAGE, curve.FAIR).alias("acceptable"))


@query("crv14_flavors", f"SELECT series, CAST(ts AS VARCHAR) AS ts, flavor, round(CASE flavor WHEN 'client' THEN greatest(price + 1.0 + risk, price * 1.02) WHEN 'production' THEN price + 0.8 ELSE price END, 6) AS price FROM (SELECT *, ([{', '.join(map(str, tg.RISK_BY_HOUR))}])[hour + 1] AS risk FROM hourly), (VALUES ('mid_market'), ('client'), ('production')) f(flavor)", HOURLY)
def crv14(t):
    rows = hourly(t).withColumns({"p10": F.col("price") * 0.98, "p90": F.col("price") * 1.02})
    return curve.flavors(rows, F.lit(0), F.col("hour")).select("series", S("ts"), "flavor", R("price", "price"))


@query("crv15_overlay", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(w * CASE WHEN hm > 0 THEN price * fc / hm ELSE fc END + (1 - w) * price, 6) AS price FROM (SELECT series, ts, price, hm, hm * 1.1 AS fc, greatest(0.0, least(1.0, (10 - date_diff('day', DATE '2024-01-10', CAST(ts AS DATE))) / 2.0)) AS w FROM (SELECT *, avg(price) OVER (PARTITION BY series, date_trunc('hour', ts)) AS hm FROM spot))")
def crv15(t):
    mean = F.avg("price").over(Window.partitionBy("series", F.date_trunc("hour", "ts")))
    rows = t.spot.withColumn("hm", mean)
    ahead = F.datediff(F.to_date("ts"), F.lit("2024-01-10").cast("date"))
    return rows.select("series", S("ts"), R(curve.overlaid(F.col("price"), F.col("hm") * 1.1, F.col("hm"), ahead), "price"))


@query("crv16_market_spread", "SELECT CAST(m AS VARCHAR) AS month, round(ch, 6) AS ch, round(de, 6) AS de, round(ch - de, 6) + 0.0 AS spread, round(100 * (ch - de) / nullif(de, 0), 6) + 0.0 AS percent, m = max(m) OVER () AS front FROM (SELECT CAST(date_trunc('month', d) AS DATE) AS m, avg(ch) AS ch, avg(de) AS de FROM pair GROUP BY ALL)", PAIR)
def crv16(t):
    """Term structure of two markets by month, their spread, and whether the month is the front one, the last that has prices."""
    rows = pair(t).groupBy(F.to_date(F.date_trunc("month", "d")).alias("m")).agg(F.avg("ch").alias("ch"), F.avg("de").alias("de"))
    last = rows.agg(F.max("m").alias("last"))
    spread = F.col("ch") - F.col("de")
    return rows.crossJoin(F.broadcast(last)).select(S("m", "month"), R("ch", "ch"), R("de", "de"), (R(spread, "x") + 0.0).alias("spread"), (R(100 * F.try_divide(spread, F.col("de")), "x") + 0.0).alias("percent"), (F.col("m") == F.col("last")).alias("front"))


@query("crv17_curve_vs_quotes", f"SELECT market, year, quarter, month, round(quote, 6) AS quote, CASE WHEN coverage >= {curve.FAIR_COVERAGE} THEN round(mean, 6) END AS curve, CASE WHEN coverage >= {curve.FAIR_COVERAGE} THEN round(mean - quote, 6) + 0.0 END AS diff, CASE WHEN coverage >= {curve.FAIR_COVERAGE} THEN round(100 * (mean - quote) / nullif(quote, 0), 6) + 0.0 END AS percent FROM met", MET)
def crv17(t):
    """Curve beside quotes; nothing is compared where the curve lacks more than a tenth of the days."""
    seen = lambda c: F.when(F.col("coverage") >= curve.FAIR_COVERAGE, c)
    diff = F.col("mean") - F.col("quote")
    return met_quotes(t).select("market", "year", "quarter", "month", R("quote", "quote"), seen(R("mean", "x")).alias("curve"), seen(R(diff, "x") + 0.0).alias("diff"), seen(R(100 * F.try_divide(diff, F.col("quote")), "x") + 0.0).alias("percent"))


@query("crv18_curve_stats", """SELECT market, y AS year, round(base, 6) AS base, round(peak, 6) AS peak, round(offpeak, 6) AS offpeak, round(f_low, 6) AS f_low, round(f_high, 6) AS f_high FROM (SELECT market, year AS y, avg(price) AS base, avg(price) FILTER (peak) AS peak, avg(price) FILTER (NOT peak) AS offpeak FROM phours GROUP BY ALL)
  JOIN (SELECT market, CAST(year(d) AS INT) AS y, min(f_w) AS f_low, max(f_w) AS f_high FROM curve GROUP BY ALL) USING (market, y)""", f"{RAW}, {LOADS}")
def crv18(t):
    """Base, peak and off-peak level of each year, and the range of the day factor."""
    peak = F.col("is_peak")
    levels = load_hours(t).groupBy("market", "year").agg(R(F.avg("price"), "base"), R(F.avg(F.when(peak, F.col("price"))), "peak"), R(F.avg(F.when(~peak, F.col("price"))), "offpeak"))
    ranges = raw_curve(t).groupBy("market", F.year("d").alias("year")).agg(R(F.min("f_w"), "f_low"), R(F.max("f_w"), "f_high"))
    return levels.join(ranges, ["market", "year"])


@query("crv18b_band_widths", "SELECT series, months, round(avg((p90 - p10) / greatest(p50, 0.01)) * CASE WHEN months <= 6 THEN 2.5 WHEN months <= 12 THEN 2.8 WHEN months <= 24 THEN 3.5 ELSE 4.2 END, 6) AS width FROM bands, (VALUES (6), (12), (24), (36)) h(months) GROUP BY series, months", f"{HOURLY}, {BANDS}")
def crv18b(t):
    """Mean width of the bands around a price of 1 at each horizon."""
    rows = bands(t).withColumn("months", F.explode(F.array(*(F.lit(m) for m, _ in tg.WIDENING))))
    width = F.avg((F.col("p90") - F.col("p10")) / F.greatest("p50", F.lit(0.01))) * F.first(tg.step_lookup(F.col("months"), tg.WIDENING, 4.2))
    return rows.groupBy("series", "months").agg(R(width, "width"))
