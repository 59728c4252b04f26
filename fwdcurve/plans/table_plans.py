"""Queries PRJ1-PRJ12, JON1-JON13, AGG1-AGG18, SRT1-SRT6 and SET1-SET3."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import timegrid as tg
from ..operators import aggregates as agg
from ..operators import joins, quantiles
from ..operators import windows as win
from .registry import query
from .time_plans import CAL, GRID, R, S, bounds

PAIR = "pair AS (SELECT a.d, a.price AS ch, b.price AS de FROM daily a JOIN daily b ON a.d = b.d WHERE a.market = 'CH' AND b.market = 'DE')"


def market(t, name: str, out: str):
    return t.daily.where(F.col("market") == name).select("d", F.col("price").alias(out))


def pair(t):
    """Days that both markets have, with both prices."""
    return market(t, "CH", "ch").join(market(t, "DE", "de"), "d")


@query("prj1_select_rename", "SELECT event_id, event_type AS series, round(value, 6) AS price FROM events")
def prj1(t):
    return t.events.select("event_id", F.col("event_type").alias("series"), R("value", "price"))


@query("prj2_dropna", "SELECT count(*) AS n FROM (SELECT lag(price) OVER (PARTITION BY market ORDER BY d) AS p, price FROM daily) WHERE p IS NOT NULL AND price IS NOT NULL")
def prj2(t):
    rows = t.daily.withColumn("p", F.lag("price").over(win.by(["market"], "d"))).dropna(subset=["p", "price"])
    return rows.agg(F.count(F.lit(1)).alias("n"))


@query("prj3_clip", "SELECT market, CAST(d AS VARCHAR) AS d, round(greatest(30.0, least(60.0, price)), 6) AS price FROM daily")
def prj3(t):
    return t.daily.select("market", S("d"), R(F.greatest(F.lit(30.0), F.least(F.lit(60.0), F.col("price"))), "price"))


@query("prj4_neutral_fill", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(coalesce(price, 1.0), 6) AS price FROM grid LEFT JOIN spot USING (series, ts)", GRID)
def prj4(t):
    rows = tg.grid(bounds(t), "15 MINUTES", ("series",)).join(t.spot, ["series", "ts"], "left").fillna(1.0, ["price"])
    return rows.select("series", S("ts"), R("price", "price"))


@query("prj5_guarded_division", "SELECT CAST(d AS VARCHAR) AS d, round(CASE WHEN abs(de - 40) > 5 THEN ch / (de - 40) END, 6) AS ratio FROM pair", PAIR)
def prj5(t):
    gap = F.col("de") - 40
    return pair(t).select(S("d"), R(F.when(F.abs(gap) > 5, F.try_divide(F.col("ch"), gap)), "ratio"))


@query("prj6_asinh", "SELECT CAST(d AS VARCHAR) AS d, market, round(asinh((price - m) / s), 6) AS y, round(sinh(asinh((price - m) / s)) * s + m, 6) AS back FROM daily JOIN (SELECT market, avg(price) AS m, greatest(stddev_pop(price), 1e-6) AS s FROM daily GROUP BY market) USING (market)")
def prj6(t):
    stats = t.daily.groupBy("market").agg(F.avg("price").alias("m"), F.greatest(F.stddev_pop("price"), F.lit(1e-6)).alias("s"))
    y = F.asinh((F.col("price") - F.col("m")) / F.col("s"))
    return t.daily.join(stats, "market").select(S("d"), "market", R(y, "y"), R(F.sinh(y) * F.col("s") + F.col("m"), "back"))


@query("prj7_tanh_damping", "SELECT market, CAST(d AS VARCHAR) AS d, round(2 * tanh(date_diff('day', DATE '1995-01-01', d) / 365.25 / 2), 6) AS damped FROM daily")
def prj7(t):
    years = F.datediff("d", F.lit("1995-01-01").cast("date")) / 365.25
    return t.daily.select("market", S("d"), R(2 * F.tanh(years / 2), "damped"))


@query("prj8_category", "SELECT p_partkey, CASE WHEN contains(lower(p_type), 'brass') THEN 'brass' WHEN contains(lower(p_type), 'steel') THEN 'steel' ELSE 'other' END AS kind FROM part")
def prj8(t):
    kind = F.lower("p_type")
    return t.part.select("p_partkey", F.when(kind.contains("brass"), "brass").when(kind.contains("steel"), "steel").otherwise("other").alias("kind"))


@query("prj9_decimal_comma", "SELECT event_id, TRY_CAST(replace(replace(CAST(event_id AS VARCHAR) || ',' || CASE WHEN event_id % 7 = 0 THEN 'x' ELSE '5' END, '.', ''), ',', '.') AS DOUBLE) AS number FROM events")
def prj9(t):
    text = F.concat(F.col("event_id").cast("string"), F.lit(","), F.when(F.col("event_id") % 7 == 0, "x").otherwise("5"))
    return t.events.select("event_id", F.replace(text, F.lit(","), F.lit(".")).try_cast("double").alias("number"))


@query("prj10_percent_or_fraction", "SELECT CAST(week AS VARCHAR) AS week, round(CASE WHEN (SELECT max(fill_pct) FROM hydro) > 1.5 THEN fill_pct / 100 ELSE fill_pct END, 6) AS fill FROM hydro")
def prj10(t):
    top = t.hydro.agg(F.max("fill_pct").alias("top"))
    return t.hydro.crossJoin(F.broadcast(top)).select(S("week"), R(F.when(F.col("top") > 1.5, F.col("fill_pct") / 100).otherwise(F.col("fill_pct")), "fill"))


@query("prj11_direction_split", "SELECT CAST(d AS VARCHAR) AS d, round(greatest(ch - de, 0.0), 6) AS export, round(least(ch - de, 0.0), 6) AS import FROM pair", PAIR)
def prj11(t):
    flow, zero = F.col("ch") - F.col("de"), F.lit(0.0)
    return pair(t).select(S("d"), R(F.greatest(flow, zero), "export"), R(F.least(flow, zero), "import"))


@query("prj12_fixed_shares", "SELECT CAST(d AS VARCHAR) AS d, border, round(price * share, 6) AS part FROM daily, (VALUES ('DE', 0.30), ('FR', 0.35), ('IT', 0.25), ('AT', 0.10)) s(border, share) WHERE market = 'CH'")
def prj12(t):
    # Shares of the borders.
    shares = F.array(*(F.struct(F.lit(b).alias("border"), F.lit(s).alias("share")) for b, s in (("DE", 0.30), ("FR", 0.35), ("IT", 0.25), ("AT", 0.10))))
    return market(t, "CH", "price").select("d", "price", F.inline(shares)).select(S("d"), "border", R(F.col("price") * F.col("share"), "part"))


@query("jon1_inner", "SELECT CAST(d AS VARCHAR) AS d, round(ch, 6) AS ch, round(de, 6) AS de FROM pair", PAIR)
def jon1(t):
    return pair(t).select(S("d"), R("ch", "ch"), R("de", "de"))


@query("jon2_left", "SELECT CAST(a.d AS VARCHAR) AS d, round(a.price, 6) AS ch, round(b.price, 6) AS de FROM daily a LEFT JOIN (SELECT * FROM daily WHERE market = 'DE') b ON a.d = b.d WHERE a.market = 'CH'")
def jon2(t):
    return market(t, "CH", "ch").join(market(t, "DE", "de"), "d", "left").select(S("d"), R("ch", "ch"), R("de", "de"))


@query("jon3_full", "SELECT CAST(coalesce(a.d, b.d) AS VARCHAR) AS d, round(a.price, 6) AS ch, round(b.price, 6) AS de FROM (SELECT * FROM daily WHERE market = 'CH') a FULL JOIN (SELECT * FROM daily WHERE market = 'DE') b ON a.d = b.d")
def jon3(t):
    return market(t, "CH", "ch").join(market(t, "DE", "de"), "d", "full").select(S("d"), R("ch", "ch"), R("de", "de"))


@query("jon4_asof", "SELECT x.market, CAST(x.d AS VARCHAR) AS d, round(h.fill_pct, 6) AS fill_pct FROM daily x ASOF LEFT JOIN hydro h ON x.d >= h.week")
def jon4(t):
    rows = joins.asof_weekly(t.daily, t.hydro, "d", "week", "fill_pct")
    return rows.select("market", S("d"), R("fill_pct", "fill_pct"))


@query("jon4b_asof_merge", "SELECT c.series, CAST(c.ts AS VARCHAR) AS ts, round(o.price, 6) AS price FROM (SELECT series, ts + INTERVAL 7 minute AS ts FROM spot) c ASOF LEFT JOIN spot o ON c.series = o.series AND c.ts >= o.ts")
def jon4b(t):
    late = t.spot.select("series", (F.col("ts") + F.expr("INTERVAL 7 MINUTES")).alias("ts"))
    return win.asof_backward(late, t.spot, "price", "ts", ["series"]).select("series", S("ts"), R("price", "price"))


LATEST = "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY revision DESC, tie1, tie2, start_ts, mw) AS rn FROM outages) WHERE rn = 1 AND status = 'O')"


def latest_outages(t):
    order = [F.desc("revision"), F.asc("tie1"), F.asc("tie2"), F.asc("start_ts"), F.asc("mw")]
    return win.keep_last(t.outages, ["id"], order).where("status = 'O'")


@query("jon5_interval_slots", "SELECT CAST(slot AS VARCHAR) AS slot, round(sum(mw), 6) AS unavailable, count(*) AS n FROM (SELECT mw, CAST(unnest(generate_series(start_ts, end_ts - INTERVAL 1 hour, INTERVAL 1 hour)) AS TIMESTAMP) AS slot FROM latest) GROUP BY slot", LATEST)
def jon5(t):
    slots = tg.grid(latest_outages(t).select("mw", F.col("start_ts").alias("start"), F.col("end_ts").alias("end")), "1 HOUR", ("mw",))
    return slots.groupBy("ts").agg(R(F.sum("mw"), "unavailable"), F.count(F.lit(1)).alias("n")).select(S("ts", "slot"), "unavailable", "n")


@query("jon6_contract_slots", "SELECT market, year, quarter, month, n, round(mean, 6) AS mean FROM (SELECT q.market, q.year, q.quarter, q.month, count(*) AS n, avg(x.price) AS mean FROM quotes q JOIN daily x ON x.market = q.market AND q.year = year(x.d) AND (q.quarter IS NULL OR q.quarter = quarter(x.d)) AND (q.month IS NULL OR q.month = month(x.d)) GROUP BY ALL)")
def jon6(t):
    return joins.contract_slots(t.quotes, t.daily).groupBy("market", "year", "quarter", "month").agg(F.count(F.lit(1)).alias("n"), R(F.avg("slot_price"), "mean"))


@query("jon7_cell_lookup", "SELECT market, CAST(d AS VARCHAR) AS d, day_type_ch AS day_type, round(coalesce(f, 1.0), 6) AS f FROM daily JOIN cal USING (d) LEFT JOIN (VALUES ('Ouvrable', 1.05), ('Samedi', 0.92), ('Dimanche', 0.78), ('Ferie_CH', 0.75), ('Ferie_DE', 0.88)) w(day_type_ch, f) USING (day_type_ch)", CAL)
def jon7(t):
    weights = t.spark.createDataFrame(list(joins.DAY_WEIGHTS.items()), "day_type string, f double")
    rows = t.daily.join(t.calendar, "d").withColumnRenamed("day_type_ch", "day_type").join(F.broadcast(weights), "day_type", "left")
    return rows.select("market", S("d"), "day_type", R(F.coalesce("f", F.lit(1.0)), "f"))


@query("jon8_climatology", "SELECT x.series, CAST(x.ts AS VARCHAR) AS ts, round(c.m, 6) AS typical FROM spot x JOIN (SELECT series, hour(ts) AS h, minute(ts) AS q, median(price) AS m FROM spot GROUP BY ALL) c ON x.series = c.series AND hour(x.ts) = c.h AND minute(x.ts) = c.q")
def jon8(t):
    rows = t.spot.withColumns({"h": F.hour("ts"), "q": F.minute("ts")})
    typical = rows.groupBy("series", "h", "q").agg(F.percentile("price", F.lit(0.5)).alias("typical"))
    return rows.join(typical, ["series", "h", "q"]).select("series", S("ts"), R("typical", "typical"))


LOOKUP = """base AS (SELECT x.market, x.d, coalesce(m.price, q.price, y.price, y1.price, y2.price) AS base FROM daily x
  LEFT JOIN quotes m ON m.market = x.market AND m.year = year(x.d) AND m.month = month(x.d)
  LEFT JOIN quotes q ON q.market = x.market AND q.year = year(x.d) AND q.quarter = quarter(x.d)
  LEFT JOIN quotes y ON y.market = x.market AND y.year = year(x.d) AND y.quarter IS NULL AND y.month IS NULL
  LEFT JOIN quotes y1 ON y1.market = x.market AND y1.year = year(x.d) - 1 AND y1.quarter IS NULL AND y1.month IS NULL
  LEFT JOIN quotes y2 ON y2.market = x.market AND y2.year = year(x.d) - 2 AND y2.quarter IS NULL AND y2.month IS NULL)"""


@query("jon9_priority_lookup", "SELECT market, CAST(d AS VARCHAR) AS d, round(base, 6) AS base FROM base", LOOKUP)
def jon9(t):
    return joins.base_lookup(t.daily, t.quotes).select("market", S("d"), R("base", "base"))


@query("jon10_semi", "SELECT CAST(d AS VARCHAR) AS d, round(price, 6) AS price FROM daily WHERE market = 'CH' AND d IN (SELECT d FROM daily WHERE market = 'DE')")
def jon10(t):
    return market(t, "CH", "price").join(market(t, "DE", "de"), "d", "left_semi").select(S("d"), R("price", "price"))


@query("jon11_anti", "SELECT CAST(d AS VARCHAR) AS d, round(price, 6) AS price FROM daily WHERE market = 'CH' AND d NOT IN (SELECT d FROM daily WHERE market = 'DE')")
def jon11(t):
    return market(t, "CH", "price").join(market(t, "DE", "de"), "d", "left_anti").select(S("d"), R("price", "price"))


#: Days before the last one from which the seasonal naive forecast is scored; the week before them is what it repeats.
SCORED_DAYS = 16
NAIVE = f"""since AS (SELECT CAST(CAST(max(ts) AS DATE) - {SCORED_DAYS} AS TIMESTAMP) AS start FROM spot), naive AS (SELECT x.series, x.ts, x.price, coalesce(p.m, g.m) AS naive FROM since, spot x
  LEFT JOIN (SELECT series, isodow(ts) AS w, hour(ts) AS h, minute(ts) AS q, avg(price) AS m FROM spot, since WHERE ts < start AND ts >= start - INTERVAL 7 day GROUP BY ALL) p ON p.series = x.series AND p.w = isodow(x.ts) AND p.h = hour(x.ts) AND p.q = minute(x.ts)
  JOIN (SELECT series, avg(price) AS m FROM spot, since WHERE ts < start GROUP BY series) g ON g.series = x.series WHERE x.ts >= start)"""


def naive(t):
    """spot of the last SCORED_DAYS with the value of the week before them."""
    start = t.spot.agg(F.date_sub(F.to_date(F.max("ts")), SCORED_DAYS)).first()[0]
    return joins.last_week(t.spot, str(start or "1970-01-01"))


@query("jon12_last_week", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(naive, 6) AS naive FROM naive", NAIVE)
def jon12(t):
    return naive(t).select("series", S("ts"), R("naive", "naive"))


@query("jon13_pairs", "SELECT a.name AS name_a, b.name AS name_b, count(*) AS n, round(corr(a.close, b.close), 6) AS corr FROM commodities a JOIN commodities b ON a.d = b.d AND a.name < b.name GROUP BY ALL HAVING count(*) > 10")
def jon13(t):
    return joins.pairs(t.commodities).groupBy("name_a", "name_b").agg(F.count(F.lit(1)).alias("n"), R(F.corr("close_a", "close_b"), "corr")).where("n > 10")


@query("agg1_group_stats", "SELECT series, count(*) AS n, round(avg(price), 6) AS mean, round(median(price), 6) AS median, round(min(price), 6) AS low, round(max(price), 6) AS high, round(stddev_samp(price), 6) AS sd FROM spot GROUP BY series")
def agg1(t):
    p = "price"
    return t.spot.groupBy("series").agg(F.count(F.lit(1)).alias("n"), R(F.avg(p), "mean"), R(F.median(p), "median"), R(F.min(p), "low"), R(F.max(p), "high"), R(F.stddev_samp(p), "sd"))


WEIGHTED = "wd AS (SELECT x.*, exp(-ln(2) * date_diff('day', d, last) / 365.0) AS w FROM daily x JOIN (SELECT market, max(d) AS last FROM daily GROUP BY market) USING (market))"


def weighted(t):
    """daily with w, a weight that halves each year before the market's last day."""
    last = t.daily.groupBy("market").agg(F.max("d").alias("last"))
    return t.daily.join(last, "market").withColumn("w", win.decay_weight(F.col("d"), F.col("last"), 365.0))


@query("agg2_weighted_mean", "SELECT market, CAST(month(d) AS INT) AS month, round(sum(w * price) / sum(w), 6) AS mean FROM wd GROUP BY market, month(d)", WEIGHTED)
def agg2(t):
    return weighted(t).groupBy("market", F.month("d").alias("month")).agg(R(agg.weighted_mean(F.col("price"), F.col("w")), "mean"))


@query("agg3_quantiles", "SELECT market, round(quantile_cont(price, 0.01), 6) AS p1, round(quantile_cont(price, 0.10), 6) AS p10, round(quantile_cont(price, 0.25), 6) AS p25, round(quantile_cont(price, 0.50), 6) AS p50, round(quantile_cont(price, 0.90), 6) AS p90, round(quantile_cont(price, 0.99), 6) AS p99 FROM daily GROUP BY market")
def agg3(t):
    shares = (1, 10, 25, 50, 90, 99)
    q = quantiles.exact_quantiles(t.daily, ["market"], "price", [k / 100 for k in shares], t.settler("quantiles"))
    return q.select("market", *(R(F.col("q")[i], f"p{k}") for i, k in enumerate(shares)))


@query("agg4_group_broadcast", "SELECT market, CAST(d AS VARCHAR) AS d, round(price - avg(price) OVER (PARTITION BY market, year(d), month(d)), 6) AS gap FROM daily")
def agg4(t):
    mean = F.avg("price").over(Window.partitionBy("market", F.year("d"), F.month("d")))
    return t.daily.select("market", S("d"), R(F.col("price") - mean, "gap"))


@query("agg5_correlation", "SELECT CAST(year(d) AS INT) AS year, round(corr(ch, de), 6) AS corr FROM pair GROUP BY year(d)", PAIR)
def agg5(t):
    return pair(t).groupBy(F.year("d").alias("year")).agg(R(F.corr("ch", "de"), "corr"))


@query("agg6_spearman", "SELECT CAST(y AS INT) AS year, round(corr(ra, rb), 6) AS spearman FROM (SELECT y, rank() OVER (PARTITION BY y ORDER BY ch) + (count(*) OVER (PARTITION BY y, ch) - 1) / 2.0 AS ra, rank() OVER (PARTITION BY y ORDER BY de) + (count(*) OVER (PARTITION BY y, de) - 1) / 2.0 AS rb FROM (SELECT year(d) AS y, ch, de FROM pair)) GROUP BY y", PAIR)
def agg6(t):
    rows = pair(t).withColumn("year", F.year("d"))
    rows = rows.withColumns({"ra": agg.average_rank("ch", ["year"]), "rb": agg.average_rank("de", ["year"])})
    return rows.groupBy("year").agg(R(F.corr("ra", "rb"), "spearman"))


@query("agg7_regression", "SELECT market, round(regr_slope(price, x), 8) AS slope, round(regr_intercept(price, x), 6) AS intercept FROM (SELECT market, price, date_diff('day', DATE '1995-01-01', d)::DOUBLE AS x FROM daily) GROUP BY market")
def agg7(t):
    x = F.datediff("d", F.lit("1995-01-01").cast("date")).cast("double")
    return t.daily.select("market", "price", x.alias("x")).groupBy("market").agg(R(F.regr_slope("price", "x"), "slope", 8), R(F.regr_intercept("price", "x"), "intercept"))


@query("agg8_error_metrics", "SELECT CAST(year(d) AS INT) AS year, round(avg(abs(ch - de)), 6) AS mae, round(sqrt(avg((ch - de) * (ch - de))), 6) AS rmse, round(avg(ch - de), 6) AS bias, round(100 * avg(CASE WHEN abs(de) > 1 THEN abs((ch - de) / de) END), 6) AS mape, round(quantile_cont(abs(ch - de), 0.95), 6) AS p95 FROM pair GROUP BY year(d)", PAIR)
def agg8(t):
    metrics = agg.error_metrics(F.col("ch") - F.col("de"), F.col("de"))
    return pair(t).groupBy(F.year("d").alias("year")).agg(*(R(c, n) for n, c in metrics.items()))


HOURLY = "hourly AS (SELECT series, date_trunc('hour', ts) AS ts, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INT) AS hour, avg(price) AS price FROM spot GROUP BY series, date_trunc('hour', ts), CAST(ts AS DATE), hour(ts))"


def hourly(t):
    """(series, ts, d, hour, price): hourly means of spot."""
    h = t.spot.groupBy("series", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.avg("price").alias("price"))
    return h.select("series", "ts", F.to_date("ts").alias("d"), F.hour("ts").alias("hour"), "price")


HOUR_WAYS = """ends AS (SELECT min(series) AS a, max(series) AS b FROM spot),
factors AS (SELECT series, CAST(day(d) AS INT) AS dom, hour, avg(price) / avg(avg(price)) OVER (PARTITION BY series) AS f FROM hourly GROUP BY series, day(d), hour),
mhours AS (SELECT x.market, x.d, h.hour, x.price * coalesce(f.f, 1.0) AS price FROM daily x, ends, (SELECT CAST(unnest(range(24)) AS INT) AS hour) h
  LEFT JOIN factors f ON f.series = CASE x.market WHEN 'CH' THEN a ELSE b END AND f.dom = day(x.d) AND f.hour = h.hour)"""


def market_hours(t):
    """(market, d, hour, price): the daily prices spread over 24 hours by a series' hourly shape on that day of the month."""
    of = hourly(t).groupBy("series", F.dayofmonth("d").alias("dom"), "hour").agg(F.avg("price").alias("m"))
    of = of.withColumn("f", F.col("m") / F.avg("m").over(Window.partitionBy("series"))).drop("m")
    ends = t.spot.agg(F.inline(F.array(F.struct(F.lit("CH").alias("market"), F.min("series").alias("series")), F.struct(F.lit("DE").alias("market"), F.max("series").alias("series")))))
    rows = t.daily.withColumns({"hour": F.explode(F.sequence(F.lit(0), F.lit(23))), "dom": F.dayofmonth("d")})
    rows = rows.join(of.join(ends, "series").drop("series"), ["market", "dom", "hour"], "left")
    return rows.select("market", "d", "hour", (F.col("price") * F.coalesce("f", F.lit(1.0))).alias("price"))


@query("agg9_extreme_hours", "SELECT series, CAST(d AS VARCHAR) AS d, arg_max(hour, price * 1000 - hour / 1e6) AS dearest, arg_min(hour, price * 1000 + hour / 1e6) AS cheapest FROM hourly GROUP BY series, d", HOURLY)
def agg9(t):
    dearest = F.max_by("hour", F.col("price") * 1000 - F.col("hour") / 1e6)
    cheapest = F.min_by("hour", F.col("price") * 1000 + F.col("hour") / 1e6)
    return hourly(t).groupBy("series", "d").agg(dearest.alias("dearest"), cheapest.alias("cheapest")).select("series", S("d"), "dearest", "cheapest")


@query("agg10_shares", "SELECT CAST(year(d) AS INT) AS year, round(avg(CASE WHEN ch > de THEN 1.0 ELSE 0.0 END), 6) AS share, count(*) FILTER (ch > de) AS n FROM pair GROUP BY year(d)", PAIR)
def agg10(t):
    over = F.col("ch") > F.col("de")
    return pair(t).groupBy(F.year("d").alias("year")).agg(R(agg.share(over), "share"), F.count_if(over).alias("n"))


@query("agg11_rollup", "SELECT market, CAST(y AS INT) AS year, CAST(q AS INT) AS quarter, CAST(m AS INT) AS month, count(*) AS n, round(avg(price), 6) AS base, round(avg(price) FILTER (w <= 5), 6) AS weekday, round(avg(price) FILTER (w > 5), 6) AS weekend FROM (SELECT market, year(d) AS y, quarter(d) AS q, month(d) AS m, isodow(d) AS w, price FROM daily) GROUP BY GROUPING SETS ((market, y, m), (market, y, q), (market, y))")
def agg11(t):
    rows = t.daily.select("market", F.year("d").alias("year"), F.quarter("d").alias("quarter"), F.month("d").alias("month"), (F.weekday("d") < 5).alias("work"), "price")
    sets = rows.groupingSets([["market", "year", "month"], ["market", "year", "quarter"], ["market", "year"]], "market", "year", "quarter", "month")
    return sets.agg(F.count(F.lit(1)).alias("n"), R(F.avg("price"), "base"), R(F.avg(F.when(F.col("work"), F.col("price"))), "weekday"), R(F.avg(F.when(~F.col("work"), F.col("price"))), "weekend"))


@query("agg12_pivot", "SELECT series, CAST(d AS VARCHAR) AS d, " + ", ".join(f"round(avg(price) FILTER (hour = {h}), 6) AS h{h}" for h in range(24)) + " FROM hourly GROUP BY series, d", HOURLY)
def agg12(t):
    wide = hourly(t).groupBy("series", "d").pivot("hour", list(range(24))).agg(F.avg("price"))
    return wide.select("series", S("d"), *(R(str(h), f"h{h}") for h in range(24)))


@query("agg13_histogram", "SELECT series, CAST(greatest(0, least(10, floor(price / 20.0) + 1)) AS BIGINT) AS bin, count(*) AS n FROM spot GROUP BY ALL")
def agg13(t):
    bins = F.greatest(F.lit(0), F.least(F.lit(10), F.floor(F.col("price") / 20.0) + 1)).cast("long")
    return t.spot.groupBy("series", bins.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("agg14_distinct", "SELECT market, count(DISTINCT year(d)) AS years, count(DISTINCT d) AS days FROM daily GROUP BY market")
def agg14(t):
    return t.daily.groupBy("market").agg(F.count_distinct(F.year("d")).alias("years"), F.count_distinct("d").alias("days"))


YEARLY = "yearly AS (SELECT market, CAST(year(d) AS INT) AS year, avg(price) AS mean, count(*) AS n FROM daily GROUP BY market, year(d))"


def yearly(t):
    return t.daily.groupBy("market", F.year("d").alias("year")).agg(F.avg("price").alias("mean"), F.count(F.lit(1)).alias("n"))


@query("agg15_yearly_change", "SELECT market, round(median(change), 6) AS median_change FROM (SELECT market, mean / lag(mean) OVER (PARTITION BY market ORDER BY year) - 1 AS change FROM yearly) GROUP BY market", YEARLY)
def agg15(t):
    change = F.col("mean") / F.lag("mean").over(win.by(["market"], "year")) - 1
    return yearly(t).select("market", change.alias("change")).groupBy("market").agg(R(F.median("change"), "median_change"))


FULL = "full_years AS (SELECT y.* FROM yearly y JOIN (SELECT market, median(n) AS mid FROM yearly GROUP BY market) USING (market) WHERE n >= 0.95 * mid)"


def full_years(t):
    """Years of a market with at least 95 % of the median number of days."""
    y = yearly(t)
    return y.join(y.groupBy("market").agg(F.median("n").alias("mid")), "market").where("n >= 0.95 * mid").drop("mid")


@query("agg16_full_years", "SELECT market, year, n FROM full_years", f"{YEARLY}, {FULL}")
def agg16(t):
    return full_years(t).select("market", "year", "n")


HALVES = "halves AS (SELECT market, CAST(month(d) AS INT) AS month, CASE WHEN d >= DATE '1998-01-01' THEN 1 ELSE 0 END AS half, price FROM daily)"


@query("agg17_welch", "SELECT market, month, round((m1 - m0) / sqrt(v0 / n0 + v1 / n1), 6) AS t, round((v0 / n0 + v1 / n1) * (v0 / n0 + v1 / n1) / ((v0 / n0) * (v0 / n0) / (n0 - 1) + (v1 / n1) * (v1 / n1) / (n1 - 1)), 4) AS df FROM (SELECT market, month, avg(price) FILTER (half = 0) AS m0, avg(price) FILTER (half = 1) AS m1, var_samp(price) FILTER (half = 0) AS v0, var_samp(price) FILTER (half = 1) AS v1, count(*) FILTER (half = 0) AS n0, count(*) FILTER (half = 1) AS n1 FROM halves GROUP BY ALL)", HALVES)
def agg17(t):
    rows = t.daily.select("market", F.month("d").alias("month"), (F.col("d") >= F.lit("1998-01-01").cast("date")).cast("int").alias("half"), "price")
    return agg.welch(rows, ["market", "month"], "half", "price").select("market", "month", R("t", "t"), R("df", "df", 4))


@query("agg17b_welch_p")
def agg17b(t):
    rows = t.daily.select("market", F.month("d").alias("month"), (F.col("d") >= F.lit("1998-01-01").cast("date")).cast("int").alias("half"), "price")
    tests = agg.welch(rows, ["market", "month"], "half", "price").select("market", "month", "t", "df")
    return agg.with_p_value(tests, ["market"]).select("market", "month", R("p", "p"), "significant")


@query("agg18_mse_parts", "SELECT CAST(month(d) AS INT) AS month, round(avg(ch - de) * avg(ch - de), 6) AS bias2, round(var_pop(ch - de), 6) AS variance, round(avg((ch - de) * (ch - de)) * count(*) / (SELECT sum((ch - de) * (ch - de)) FROM pair), 6) AS share FROM pair GROUP BY month(d)", PAIR)
def agg18(t):
    e = F.col("ch") - F.col("de")
    parts = pair(t).groupBy(F.month("d").alias("month")).agg(F.avg(e).alias("b"), F.var_pop(e).alias("v"), F.sum(e * e).alias("s"))
    total = parts.agg(F.sum("s").alias("all"))
    return parts.crossJoin(F.broadcast(total)).select("month", R(F.col("b") * F.col("b"), "bias2"), R("v", "variance"), R(F.col("s") / F.col("all"), "share"))


@query("srt1_sort", "SELECT market, CAST(d AS VARCHAR) AS d, round(price, 6) AS price FROM daily ORDER BY market, d")
def srt1(t):
    return t.daily.orderBy("market", "d").select("market", S("d"), R("price", "price"))


@query("srt2_worst_cells", """SELECT market, kind, name, n, round(rmse, 6) AS rmse FROM (SELECT *, row_number() OVER (PARTITION BY market, kind ORDER BY rmse DESC, name) AS rank FROM (
  SELECT market, 'hour' AS kind, CAST(hour AS VARCHAR) AS name, count(*) AS n, sqrt(avg(e * e)) AS rmse FROM werr GROUP BY ALL UNION ALL SELECT market, 'cell', CAST(month(d) AS INT) || '/' || CAST(isodow(d) - 1 AS INT) || '/' || hour, count(*), sqrt(avg(e * e)) FROM werr GROUP BY ALL HAVING count(*) >= 20))
  WHERE rank <= CASE kind WHEN 'hour' THEN 3 ELSE 15 END""", f"{HOURLY}, {HOUR_WAYS}, werr AS (SELECT * FROM (SELECT *, lag(price, 168) OVER (PARTITION BY market ORDER BY d, hour) - price AS e FROM mhours) WHERE e IS NOT NULL)")
def srt2(t):
    """Each market's three worst hours and 15 worst cells (month, weekday, hour) of at least 20 rows, by the error of the week before."""
    w = Window.partitionBy("market").orderBy("d", "hour")
    rows = market_hours(t).withColumn("e", F.lag("price", 168).over(w) - F.col("price")).where("e IS NOT NULL")
    cell = F.concat_ws("/", F.month("d"), F.weekday("d"), "hour")
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), c.alias("name")) for k, c in (("hour", F.col("hour").cast("string")), ("cell", cell))))
    sums = rows.select("market", "e", F.inline(kinds)).groupBy("market", "kind", "name").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"))
    rank = F.row_number().over(Window.partitionBy("market", "kind").orderBy(F.desc("rmse"), "name"))
    best = sums.where("kind = 'hour' OR n >= 20").withColumn("rank", rank).where("rank <= CASE kind WHEN 'hour' THEN 3 ELSE 15 END")
    return best.select("market", "kind", "name", "n", R("rmse", "rmse"))


@query("srt3_top_per_group", "SELECT series, CAST(d AS VARCHAR) AS d, hour FROM (SELECT *, row_number() OVER (PARTITION BY series, d ORDER BY price DESC, hour) AS rn FROM hourly) WHERE rn <= 8", HOURLY)
def srt3(t):
    rn = F.row_number().over(win.by(["series", "d"], [F.desc("price"), F.asc("hour")]))
    return hourly(t).withColumn("rn", rn).where("rn <= 8").select("series", S("d"), "hour")


@query("srt4_latest", "SELECT market, CAST(d AS VARCHAR) AS d, round(price, 6) AS price FROM daily ORDER BY d DESC, market LIMIT 50")
def srt4(t):
    return t.daily.orderBy(F.desc("d"), "market").limit(50).select("market", S("d"), R("price", "price"))


@query("srt5_sample", "SELECT event_id FROM events ORDER BY md5('s1:' || CAST(event_id AS VARCHAR)), event_id LIMIT 500")
def srt5(t):
    draw = F.md5(F.concat(F.lit("s1:"), F.col("event_id").cast("string")).cast("binary"))
    return t.events.select("event_id", draw.alias("draw")).orderBy("draw", "event_id").limit(500).select("event_id")


@query("srt6_every_kth", "SELECT market, CAST(d AS VARCHAR) AS d FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY d) AS rn FROM daily) WHERE rn % 7 = 0")
def srt6(t):
    return t.daily.withColumn("rn", F.row_number().over(win.by(["market"], "d"))).where("rn % 7 = 0").select("market", S("d"))


@query("set1_union_dedup", "SELECT DISTINCT CAST(d AS VARCHAR) AS d FROM (SELECT d FROM daily WHERE market = 'CH' UNION ALL SELECT d FROM daily WHERE market = 'DE')")
def set1(t):
    return market(t, "CH", "p").select("d").unionByName(market(t, "DE", "p").select("d")).distinct().select(S("d"))


@query("set2_intersect", "SELECT CAST(d AS VARCHAR) AS d FROM (SELECT d FROM daily WHERE market = 'CH' INTERSECT SELECT d FROM daily WHERE market = 'DE')")
def set2(t):
    return market(t, "CH", "p").select("d").intersect(market(t, "DE", "p").select("d")).select(S("d"))


@query("set3_except", "SELECT CAST(d AS VARCHAR) AS d FROM (SELECT d FROM daily WHERE market = 'CH' EXCEPT SELECT d FROM daily WHERE market = 'DE')")
def set3(t):
    return market(t, "CH", "p").select("d").subtract(market(t, "DE", "p").select("d")).select(S("d"))
