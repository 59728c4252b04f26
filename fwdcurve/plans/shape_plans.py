"""Queries SHP1-SHP23: shape factors and their application."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import timegrid as tg
from ..operators import joins, shapes
from ..operators import windows as win
from .registry import query
from .table_plans import HOUR_WAYS, HOURLY, WEIGHTED, hourly, market_hours, weighted
from .time_plans import CAL, ENRICHED, R, S, enriched

CELL = shapes.CELL
W_ROWS = "wrows AS (SELECT series, ts, local_ts, d, hour, quarter, season, day_type_ch AS day_type, price, exp(-ln(2) * date_diff('day', CAST(ts AS DATE), CAST(last AS DATE)) / 30.0) AS w FROM enriched JOIN (SELECT series, max(ts) AS last FROM spot GROUP BY series) USING (series))"
FH = f"""{ENRICHED}, {W_ROWS},
fh_raw AS (SELECT series, season, day_type, hour, sum(w * price) / sum(w) AS m, count(*) AS n FROM wrows GROUP BY ALL),
fh_grid AS (SELECT g.*, r.m FROM (SELECT series, season, day_type, CAST(unnest(range(24)) AS INT) AS hour FROM fh_raw GROUP BY series, season, day_type HAVING sum(n) >= 96) g LEFT JOIN fh_raw r USING (series, season, day_type, hour)),
fh_fill AS (SELECT series, season, day_type, hour, coalesce(m, y0 + (y1 - y0) * (hour - x0) / nullif(x1 - x0, 0), y0, y1) AS y FROM (SELECT *,
  last_value(CASE WHEN m IS NOT NULL THEN hour END IGNORE NULLS) OVER b AS x0, last_value(m IGNORE NULLS) OVER b AS y0, first_value(CASE WHEN m IS NOT NULL THEN hour END IGNORE NULLS) OVER f AS x1, first_value(m IGNORE NULLS) OVER f AS y1 FROM fh_grid
  WINDOW b AS (PARTITION BY series, season, day_type ORDER BY hour ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY series, season, day_type ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
fh AS (SELECT series, season, day_type, hour, y / avg(y) OVER (PARTITION BY series, season, day_type) AS f FROM fh_fill)"""
KERNEL = "(SELECT CAST(k AS INT) AS shift, exp(-0.5 * k * k) / (SELECT sum(exp(-0.5 * j * j)) FROM range(-4, 5) r(j)) AS k FROM range(-4, 5) r(k))"
FH_SMOOTH = f"fh_s AS (SELECT series, season, day_type, hour, f / avg(f) OVER (PARTITION BY series, season, day_type) AS f FROM (SELECT series, season, day_type, (hour + shift + 24) % 24 AS hour, sum(f * k) AS f FROM fh, {KERNEL} GROUP BY ALL))"
FH_ALL = """fh_all AS (SELECT series, season, day_type, hour, coalesce(f, avg(f) OVER (PARTITION BY series, hour, season), avg(f) OVER (PARTITION BY series, hour, day_type), avg(f) OVER (PARTITION BY series, hour), 1.0) AS f
  FROM (SELECT * FROM (SELECT DISTINCT series FROM fh_s), (VALUES ('Hiver'), ('Printemps'), ('Ete'), ('Automne')) s(season), (VALUES ('Ouvrable'), ('Samedi'), ('Dimanche'), ('Ferie_CH'), ('Ferie_DE')) t(day_type), (SELECT CAST(unnest(range(24)) AS INT) AS hour)) LEFT JOIN fh_s USING (series, season, day_type, hour))"""


def weighted_rows(t):
    """enriched spot rows with their cell and a weight that halves every 30 days."""
    last = t.spot.groupBy("series").agg(F.to_date(F.max("ts")).alias("last"))
    rows = enriched(t).withColumnRenamed("day_type_ch", "day_type").join(last, "series")
    return rows.withColumn("w", win.decay_weight(F.to_date("ts"), F.col("last"), 30.0))


def profile(t):
    return shapes.hourly_profile(weighted_rows(t))


CELL_SQL = "SELECT series, season, day_type, hour, round(f, 6) AS f FROM "


@query("shp1_hourly_profile", CELL_SQL + "fh", FH)
def shp1(t):
    return profile(t).select(*CELL, "hour", R("f", "f"))


@query("shp2_smoothed", CELL_SQL + "fh_s", f"{FH}, {FH_SMOOTH}")
def shp2(t):
    return shapes.smoothed(profile(t)).select(*CELL, "hour", R("f", "f"))


@query("shp3_fallback", CELL_SQL + "fh_all", f"{FH}, {FH_SMOOTH}, {FH_ALL}")
def shp3(t):
    return shapes.with_fallback(shapes.smoothed(profile(t))).select(*CELL, "hour", R("f", "f"))


DAYS = f"{CAL}, {WEIGHTED}, wdays AS (SELECT market, d, price, w, season, CASE market WHEN 'CH' THEN day_type_ch ELSE day_type_de END AS day_type FROM wd JOIN cal USING (d))"


def weighted_days(t):
    """daily with weight, season and the day type of its market."""
    rows = weighted(t).join(t.calendar, "d")
    return rows.withColumn("day_type", F.when(F.col("market") == "CH", F.col("day_type_ch")).otherwise(F.col("day_type_de")))


FW = "fw AS (SELECT market, day_type, CASE WHEN count(*) >= 20 THEN sum(w * price) / sum(w) / any_value(a) ELSE 1.0 END AS f FROM wdays JOIN (SELECT market, sum(w * price) / sum(w) AS a FROM wdays GROUP BY market) USING (market) GROUP BY market, day_type)"
FWS = "fws AS (SELECT market, season, day_type, CASE WHEN count(*) >= 20 THEN sum(w * price) / sum(w) / any_value(a) END AS f FROM wdays JOIN (SELECT market, season, sum(w * price) / sum(w) AS a FROM wdays GROUP BY market, season) USING (market, season) GROUP BY market, season, day_type)"


@query("shp4_day_factor", "SELECT market, day_type, round(f, 6) AS f FROM fw", f"{DAYS}, {FW}")
def shp4(t):
    return shapes.day_factor(weighted_days(t), ["market"], 20).select("market", "day_type", R("f", "f"))


def seasonal_factor(t):
    rows = weighted_days(t)
    own = rows.groupBy("market", "season", "day_type").agg((F.sum(F.col("w") * F.col("price")) / F.sum("w")).alias("m"), F.count(F.lit(1)).alias("n"))
    every = rows.groupBy("market", "season").agg((F.sum(F.col("w") * F.col("price")) / F.sum("w")).alias("all"))
    own = own.join(every, ["market", "season"]).withColumn("own", F.when(F.col("n") >= 20, F.col("m") / F.col("all")))
    return own.join(shapes.day_factor(rows, ["market"], 20), ["market", "day_type"]).select("market", "season", "day_type", F.coalesce("own", "f").alias("f"))


@query("shp5_seasonal_day_factor", "SELECT market, season, day_type, round(coalesce(fws.f, fw.f), 6) AS f FROM fws JOIN fw USING (market, day_type)", f"{DAYS}, {FW}, {FWS}")
def shp5(t):
    return seasonal_factor(t).select("market", "season", "day_type", R("f", "f"))


CELLH = f"""{HOURLY}, {HOUR_WAYS}, {CAL}, chours AS (SELECT m.*, season, CASE market WHEN 'CH' THEN day_type_ch ELSE day_type_de END AS day_type FROM mhours m JOIN cal USING (d)),
cyear AS (SELECT market, season, day_type, y, hour, m / avg(m) OVER (PARTITION BY market, season, day_type, y) AS f FROM (SELECT market, season, day_type, year(d)::DOUBLE AS y, hour, avg(price) AS m FROM chours GROUP BY ALL)),
slopes AS (SELECT * FROM (SELECT *, max(abs(slope)) OVER (PARTITION BY market, season, day_type) AS most FROM (SELECT market, season, day_type, hour, regr_slope(f, y) AS slope, count(*) AS years FROM cyear GROUP BY ALL HAVING count(*) >= 3)) WHERE most > {shapes.LEAST_TREND})"""


def cell_hours(t):
    """The hours of the daily prices with season and their market's day type."""
    rows = market_hours(t).join(t.calendar, "d")
    return rows.select("market", "d", "hour", "price", "season", F.when(F.col("market") == "CH", F.col("day_type_ch")).otherwise(F.col("day_type_de")).alias("day_type"))


@query("shp6_profile_trend", "SELECT market, season, day_type, hour, round(slope, 8) + 0.0 AS slope, years FROM slopes", CELLH)
def shp6(t):
    """Trend over years of each hour's place in its cell's profile, of cells in which one hour moves."""
    return shapes.profile_trends(cell_hours(t), ["market", "season", "day_type"]).select("market", "season", "day_type", "hour", (R("slope", "x", 8) + 0.0).alias("slope"), "years")


APPLY = f"""{CELLH}, cprof AS (SELECT market, season, day_type, hour, m / avg(m) OVER (PARTITION BY market, season, day_type) AS f FROM (SELECT market, season, day_type, hour, avg(price) AS m FROM chours GROUP BY ALL)),
fdays AS (SELECT market, last, CAST(unnest(generate_series(last + 1, last + 1095, INTERVAL 1 day)) AS DATE) AS d FROM (SELECT market, max(d) AS last FROM daily GROUP BY market)), fcal AS ({cal.sql("fdays")}),
fslots AS (SELECT f.market, f.d, h.hour, season, CASE f.market WHEN 'CH' THEN day_type_ch ELSE day_type_de END AS day_type, (date_diff('day', last, f.d) + h.hour / 24.0) / 365.25 AS ahead FROM fdays f JOIN fcal USING (d), (SELECT CAST(unnest(range(24)) AS INT) AS hour) h),
fapp AS (SELECT s.market, s.d, s.hour, greatest(0.4, least(2.0, coalesce(p.f, 1.0) + coalesce(k.slope, 0.0) * {shapes.TREND_YEARS} * tanh(ahead / {shapes.TREND_YEARS}))) AS g FROM fslots s LEFT JOIN cprof p USING (market, season, day_type, hour) LEFT JOIN slopes k USING (market, season, day_type, hour))"""


@query("shp7_apply_hourly", "SELECT market, CAST(d AS VARCHAR) AS d, hour, round(greatest(0.4, least(2.0, g / avg(g) OVER (PARTITION BY market, d))), 6) AS f FROM fapp", APPLY)
def shp7(t):
    """f_H of the three years after each market's last day: the cell's profile moved along its trend, which levels off, clipped,
    with mean 1 a day, clipped again; a cell without a profile is flat."""
    cell, hours = ["market", "season", "day_type"], cell_hours(t)
    mean = hours.groupBy(*cell, "hour").agg(F.avg("price").alias("m"))
    table = mean.select(*cell, "hour", (F.col("m") / F.avg("m").over(Window.partitionBy(*cell))).alias("f"))
    table = table.join(shapes.profile_trends(hours, cell).drop("years"), [*cell, "hour"], "left")
    last = t.daily.groupBy("market").agg(F.max("d").alias("last"))
    days = last.withColumn("d", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", 1095))))
    days = days.join(cal.day_calendar(days.select("d").distinct()), "d")
    slots = days.select("market", "d", "season", F.when(F.col("market") == "CH", F.col("day_type_ch")).otherwise(F.col("day_type_de")).alias("day_type"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"), "last")
    years = (F.datediff("d", "last") + F.col("hour") / 24.0) / 365.25
    rows = slots.join(table, [*cell, "hour"], "left").withColumn("g", shapes.trended_factor(F.coalesce("f", F.lit(1.0)), F.coalesce("slope", F.lit(0.0)), years))
    return rows.select("market", S("d"), "hour", R(shapes.clipped_factor(win.normalised("g", ["market", "d"])), "f"))


@query("shp8_analogue_weight", "SELECT x.market, CAST(x.d AS VARCHAR) AS d, round(coalesce(greatest(0.3, exp(-0.5 * ((h.fill_pct - n.now) / 15.0) * ((h.fill_pct - n.now) / 15.0))), 1.0), 6) AS w FROM daily x ASOF LEFT JOIN hydro h ON x.d >= h.week CROSS JOIN (SELECT arg_max(fill_pct, week) AS now FROM hydro) n")
def shp8(t):
    now = t.hydro.agg(F.max_by("fill_pct", "week").alias("now"))
    rows = joins.asof_weekly(t.daily, t.hydro, "d", "week", "fill_pct").crossJoin(F.broadcast(now))
    z = (F.col("fill_pct") - F.col("now")) / 15.0
    # greatest skips nulls, so a day before the first week is told apart
    w = F.when(F.col("fill_pct").isNull(), F.lit(SHP8_NULL)).otherwise(F.greatest(F.lit(0.3), F.exp(-0.5 * z * z)))
    return rows.select("market", S("d"), R(w, "w"))


#: DuckDB's greatest skips nulls too, so there the floor holds for such days.
SHP8_NULL = 0.3


@query("shp9_week_climatology", "SELECT CAST(weekofyear(week) AS INT) AS iso_week, round(avg(fill_pct), 6) AS fill FROM hydro GROUP BY weekofyear(week)")
def shp9(t):
    return t.hydro.groupBy(F.weekofyear("week").alias("iso_week")).agg(R(F.avg("fill_pct"), "fill"))


RATIOS = f"{ENRICHED}, {W_ROWS}, ratios AS (SELECT *, price / m AS ratio FROM (SELECT *, avg(price) OVER (PARTITION BY series, date_trunc('hour', ts)) AS m FROM wrows) WHERE abs(m) > 0.1)"
FQ = "fq AS (SELECT series, season, day_type, hour, quarter, mid / avg(mid) OVER (PARTITION BY series, season, day_type, hour) AS f FROM (SELECT series, season, day_type, hour, quarter, median(ratio) AS mid FROM ratios GROUP BY ALL HAVING count(*) >= 8))"


def ratios(t):
    return shapes.quarter_ratios(weighted_rows(t), CELL)


def quarter_table(t):
    mid = ratios(t).groupBy(*CELL, "hour", "quarter").agg(F.median("ratio").alias("mid"), F.count(F.lit(1)).alias("n")).where("n >= 8")
    return mid.select(*CELL, "hour", "quarter", win.normalised("mid", [*CELL, "hour"]).alias("f"))


@query("shp10_quarter_base", "SELECT series, season, day_type, hour, quarter, round(f, 6) AS f FROM fq", f"{RATIOS}, {FQ}")
def shp10(t):
    return quarter_table(t).select(*CELL, "hour", "quarter", R("f", "f"))


@query("shp10b_quarter_huber")
def shp10b(t):
    """Robust quarter factors of every cell with a ratio; a cell with a thin quarter takes those of another cell."""
    rows = ratios(t)
    located = shapes.huber_by(rows, [*CELL, "hour", "quarter"], "ratio").where("location IS NOT NULL")
    whole = located.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*CELL, "hour"))).where("n = 4")
    base = whole.select(*CELL, "hour", "quarter", win.normalised("location", [*CELL, "hour"]).alias("f"))
    filled = shapes.quarter_fallback(rows.select(*CELL, "hour").distinct(), base)
    return filled.select(*CELL, "hour", "quarter", R("f", "f"))


EXOGENOUS = ("solar_regime", "load_deviation", "flow_deviation")


def exogenous(t):
    """(series, at, EXOGENOUS) of each hour, from other series than the one to explain: the tercile of their mean price in that hour
    of the day stands for solar regimes, the monthly z-score of the number of events for load, that of the gap between the
    dearest and the cheapest of them for flows."""
    at = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    of = t.spot.groupBy("series", at.alias("at")).agg(F.avg("price").alias("p"))
    load = t.events.groupBy(F.col("event_type").alias("series"), at.alias("at")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    of = of.join(load, ["series", "at"])
    names = of.select("series").distinct()
    # each hour is told to every series but its own; there are a few series
    told = of.select("at", "p", "n", F.col("series").alias("teller")).join(names, F.col("teller") != F.col("series"))
    rows = told.groupBy("series", "at").agg(F.avg("p").alias("p"), F.avg("n").alias("n"), (F.max("p") - F.min("p")).alias("gap"))
    rows = rows.withColumns({"month": F.date_trunc("month", "at"), "hour": F.hour("at")})
    edges = rows.groupBy("series", "month", "hour").agg(F.percentile("p", F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("q"))
    rows = rows.join(edges, ["series", "month", "hour"])
    regime = F.when(F.col("p") <= F.col("q")[0], 0.0).when(F.col("p") <= F.col("q")[1], 1.0).otherwise(2.0)
    return rows.select("series", "at", regime.alias("solar_regime"), win.zscore("n", ["series", "month"]).alias("load_deviation"), win.zscore("gap", ["series", "month"]).alias("flow_deviation"))


def quarter_corrections(t):
    """(*CELL, hour, quarter, accepted, intercept, coefs) of the ratio's distance from its own base factor, or 1, on EXOGENOUS."""
    at = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    rows = ratios(t).withColumn("at", at).join(exogenous(t), ["series", "at"]).join(quarter_table(t).withColumnRenamed("f", "base"), [*CELL, "hour", "quarter"], "left")
    rows = rows.withColumn("gap", F.col("ratio") - F.coalesce("base", F.lit(1.0))).select(*CELL, "hour", "quarter", "ts", "gap", *EXOGENOUS)
    return shapes.ridge_correction(rows, [*CELL, "hour", "quarter"], list(EXOGENOUS), "gap", most=shapes.MOST_CORRECTION)


@query("shp11_quarter_correction")
def shp11(t):
    return quarter_corrections(t).select(*CELL, "hour", "quarter", "accepted", R("intercept", "intercept"), F.transform("coefs", lambda c: F.round(c, 6)).cast("string").alias("coefs"))


QUARTERED = "appq AS (SELECT e.series, e.ts, coalesce(q.f, 1.0) AS f, date_trunc('hour', e.ts) AS h FROM wrows e LEFT JOIN fq q USING (series, season, day_type, hour, quarter))"


@query("shp12_apply_quarter", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(f / avg(f) OVER (PARTITION BY series, h), 6) AS f FROM appq", f"{RATIOS}, {FQ}, {QUARTERED}")
def shp12(t):
    """Base factor of each slot's quarter, with mean 1 over the slots of its hour."""
    rows = enriched(t).withColumnRenamed("day_type_ch", "day_type").join(quarter_table(t), [*CELL, "hour", "quarter"], "left")
    rows = rows.withColumns({"f": F.coalesce("f", F.lit(1.0)), "h": F.date_trunc("hour", "ts")})
    return rows.select("series", S("ts"), R(win.normalised("f", ["series", "h"]), "f"))


@query("shp12b_corrected_quarter")
def shp12b(t):
    """The same with the correction by exogenous columns of the cells that have one."""
    at = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    rows = enriched(t).withColumnRenamed("day_type_ch", "day_type").withColumn("at", at).join(quarter_table(t), [*CELL, "hour", "quarter"], "left")
    rows = rows.join(exogenous(t), ["series", "at"], "left").join(quarter_corrections(t).where("accepted"), [*CELL, "hour", "quarter"], "left")
    move = F.col("intercept") + F.aggregate(F.zip_with(F.array(*EXOGENOUS), "coefs", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    rows = rows.withColumn("f", F.coalesce("f", F.lit(1.0)) + F.coalesce(move, F.lit(0.0)))
    return rows.select("series", S("ts"), R(win.normalised("f", ["series", "at"]), "f"))


_ORDER = ["Ferie_DE", *shapes.STAND_IN.values()]
CHAIN = f"""whole AS (SELECT *, count(*) OVER (PARTITION BY series, season, day_type, hour) AS n FROM fq),
cells AS (SELECT * FROM (SELECT DISTINCT series FROM fq), (SELECT unnest({list(shapes.SEASONS)}) AS season), (SELECT unnest({list(shapes.DAY_TYPES)}) AS day_type), (SELECT CAST(unnest(range(24)) AS INT) AS hour)),
ranked AS (SELECT c.*, o.quarter, o.f, CASE WHEN o.season = c.season AND list_position({_ORDER}, o.day_type) >= list_position({_ORDER}, c.day_type) THEN list_position({_ORDER}, o.day_type) - list_position({_ORDER}, c.day_type)
  WHEN o.day_type = '{_ORDER[-1]}' THEN 10 + list_position({list(shapes.SEASONS)}, o.season) END AS place FROM cells c JOIN whole o ON o.series = c.series AND o.hour = c.hour AND o.n = 4)"""


@query("shp13_quarter_fallback", "SELECT c.series, c.season, c.day_type, c.hour, q.quarter, round(coalesce(r.f, 1.0), 6) AS f FROM cells c, (SELECT CAST(unnest(range(1, 5)) AS INT) AS quarter) q LEFT JOIN (SELECT series, season, day_type, hour, quarter, arg_min(f, place) AS f FROM ranked WHERE place IS NOT NULL GROUP BY ALL) r ON r.series = c.series AND r.season = c.season AND r.day_type = c.day_type AND r.hour = c.hour AND r.quarter = q.quarter", f"{RATIOS}, {FQ}, {CHAIN}")
def shp13(t):
    """Quarter factors of all 20 cells and 24 hours of each series: the cell's own, if its four quarters are known, else those of
    the same season's next day type, else of a working day of the first season that has them, else 1."""
    table = quarter_table(t)
    names = lambda values: F.explode(F.array(*map(F.lit, values)))
    cells = table.select("series").distinct().withColumn("season", names(shapes.SEASONS)).withColumn("day_type", names(shapes.DAY_TYPES)).withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    whole = table.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*CELL, "hour"))).where("n = 4").drop("n")
    return shapes.quarter_fallback(cells, whole).select(*CELL, "hour", "quarter", R("f", "f"))


OBSERVED = f"""{RATIOS}, {HOURLY}, fhobs AS (SELECT series, hour, price / avg(price) OVER (PARTITION BY series, d) AS f FROM hourly),
fwobs AS (SELECT series, CAST(isodow(d) - 1 AS INT) AS slot, m / avg(m) OVER (PARTITION BY series, date_trunc('week', d)) AS f FROM (SELECT series, d, avg(price) AS m FROM hourly GROUP BY ALL)),
inhour AS (SELECT series, median(sd) AS mid FROM (SELECT series, date_trunc('hour', ts) AS h, stddev_samp(price) AS sd FROM spot GROUP BY ALL) GROUP BY series),
observed AS (SELECT series, 'f_Q' AS factor, quarter AS slot, ratio AS f FROM ratios UNION ALL SELECT series, 'f_H', hour, f FROM fhobs UNION ALL SELECT series, 'f_W', slot, f FROM fwobs)"""


@query("shp14_observed", "SELECT series, factor, slot, count(*) AS n, round(avg(f), 6) AS mean, round(median(f), 6) AS mid, round(stddev_samp(f), 6) AS sd, coalesce(any_value(i.mid), 0) < 1e-6 AS flat FROM observed JOIN inhour i USING (series) GROUP BY series, factor, slot", OBSERVED)
def shp14(t):
    """Observed factors: quarters to their hour, hours to their day, weekdays to their week; a series is flat if its prices hardly
    differ within the median hour."""
    h = hourly(t)
    mean = lambda rows, c, *keys: F.col(c) / F.avg(c).over(Window.partitionBy("series", *keys))
    quarters = ratios(t).select("series", F.lit("f_Q").alias("factor"), F.col("quarter").alias("slot"), F.col("ratio").alias("f"))
    hours = h.select("series", F.lit("f_H").alias("factor"), F.col("hour").alias("slot"), mean(h, "price", "d").alias("f"))
    days = h.groupBy("series", "d").agg(F.avg("price").alias("m")).withColumn("week", F.date_trunc("week", "d"))
    weekdays = days.select("series", F.lit("f_W").alias("factor"), F.weekday("d").alias("slot"), mean(days, "m", "week").alias("f"))
    inside = t.spot.groupBy("series", F.date_trunc("hour", "ts").alias("h")).agg(F.stddev_samp("price").alias("sd")).groupBy("series").agg(F.median("sd").alias("mid_sd"))
    rows = quarters.unionByName(hours).unionByName(weekdays).join(inside, "series")
    return rows.groupBy("series", "factor", "slot").agg(F.count(F.lit(1)).alias("n"), R(F.avg("f"), "mean"), R(F.median("f"), "mid"), R(F.stddev_samp("f"), "sd"), (F.coalesce(F.first("mid_sd"), F.lit(0.0)) < 1e-6).alias("flat"))


REGRESSORS = ("hs", "hc", "hs2", "hc2", "ws", "wc", "ms", "mc", "weekend", "peak", "before1", "before7")


def regressor_rows(t):
    """(series, ts, d, target, w, REGRESSORS): two harmonics of the hour, cycles of weekday and day of the month, flags and
    the same hour's ratio one and seven days before (1 where it is missing); weights halve every 30 days."""
    rows = hourly(t).withColumn("m", F.avg("price").over(Window.partitionBy("series", "d"))).where("m > 5")
    rows = rows.withColumn("target", F.greatest(F.lit(0.2), F.least(F.lit(3.0), F.col("price") / F.col("m"))))
    days = F.datediff("d", F.lit("1970-01-01"))
    w = Window.partitionBy("series", "hour").orderBy(days)
    before = lambda k: F.coalesce(F.max("target").over(w.rangeBetween(-k, -k)), F.lit(1.0))
    (hs, hc), (hs2, hc2) = tg.cyclic(F.col("hour"), 24), tg.cyclic(F.col("hour"), 12)
    (ws, wc), (ms, mc) = tg.cyclic(F.weekday("d"), 7), tg.cyclic(F.dayofmonth("d"), 31)
    flags = ((F.weekday("d") >= 5).cast("double"), F.col("hour").between(8, 19).cast("double"))
    columns = dict(zip(REGRESSORS, (hs, hc, hs2, hc2, ws, wc, ms, mc, *flags, before(1), before(7)), strict=True))
    age = win.decay_weight(F.col("d"), F.max("d").over(Window.partitionBy("series")), 30.0)
    return rows.select("series", "ts", "d", "target", age.alias("w"), *(c.alias(n) for n, c in columns.items()))


MLP = """feat0 AS (SELECT *, greatest(0.2, least(3.0, price / m)) AS target FROM (SELECT *, avg(price) OVER (PARTITION BY series, d) AS m FROM hourly) WHERE m > 5),
feat AS (SELECT a.*, sin(a.hour * 2 * pi() / 24) AS hs, cos(a.hour * 2 * pi() / 24) AS hc, sin(a.hour * 2 * pi() / 12) AS hs2, cos(a.hour * 2 * pi() / 12) AS hc2, sin((isodow(a.d) - 1) * 2 * pi() / 7) AS ws, cos((isodow(a.d) - 1) * 2 * pi() / 7) AS wc,
  sin(day(a.d) * 2 * pi() / 31) AS ms, cos(day(a.d) * 2 * pi() / 31) AS mc, CASE WHEN isodow(a.d) >= 6 THEN 1.0 ELSE 0.0 END AS weekend, CASE WHEN a.hour BETWEEN 8 AND 19 THEN 1.0 ELSE 0.0 END AS peak, coalesce(b.target, 1.0) AS before1, coalesce(c.target, 1.0) AS before7,
  exp(-ln(2) * date_diff('day', a.d, max(a.d) OVER (PARTITION BY a.series)) / 30.0) AS w
  FROM feat0 a LEFT JOIN feat0 b ON b.series = a.series AND b.hour = a.hour AND b.d = a.d - 1 LEFT JOIN feat0 c ON c.series = a.series AND c.hour = a.hour AND c.d = a.d - 7)"""


@query("shp15_regressor_features", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(target, 6) AS target, round(w, 6) AS w, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in REGRESSORS) + " FROM feat", f"{HOURLY}, {MLP}")
def shp15(t):
    """The twelve features of the regressor, the clipped ratio of each hour to its day, and its weight."""
    return regressor_rows(t).select("series", S("ts"), R("target", "target"), R("w", "w"), *((R(c, "x") + 0.0).alias(c) for c in REGRESSORS))


@query("shp16_regressor")
def shp16(t):
    """Tree ensemble fitted on the first two thirds of the days and applied to the rest; the prediction is floored, scaled
    to mean 1 over each day and clipped."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    rows = VectorAssembler(inputCols=list(REGRESSORS), outputCol="x").transform(regressor_rows(t))
    ends = rows.agg(F.min("d"), F.max("d")).first()
    split = F.date_add(F.lit(ends[0]), (2 * (ends[1] - ends[0]).days) // 3)
    model = RandomForestRegressor(featuresCol="x", labelCol="target", weightCol="w", numTrees=10, maxDepth=5, seed=1).fit(rows.where(F.col("d") < split))
    out = model.transform(rows.where(F.col("d") >= split)).select("series", S("ts"), "d", F.greatest("prediction", F.lit(0.05)).alias("p"))
    clipped = F.greatest(F.lit(0.2), F.least(F.lit(3.0), win.normalised("p", ["series", "d"])))
    return out.select("series", "ts", R(clipped, "f"))


WATER = """water_m AS (SELECT market, make_date(CAST(year(d) AS INT), CAST(month(d) AS INT), 1) AS month, avg(price) AS p, avg(fill - typical) AS dev
  FROM (SELECT x.market, x.d, x.price, h.fill_pct AS fill, c.typical FROM daily x ASOF LEFT JOIN hydro h ON x.d >= h.week LEFT JOIN (SELECT weekofyear(week) AS w, avg(fill_pct) AS typical FROM hydro GROUP BY ALL) c ON c.w = weekofyear(h.week)) WHERE fill IS NOT NULL GROUP BY ALL),
water_x AS (SELECT market, p, season, avg(p) OVER (PARTITION BY market) AS mean, count(*) OVER (PARTITION BY market) AS months,
  coalesce(date_diff('day', min(month) OVER (PARTITION BY market), month) / nullif(date_diff('day', min(month) OVER (PARTITION BY market), max(month) OVER (PARTITION BY market)), 0), 0.0) AS trend,
  CASE WHEN season = 'Hiver' THEN dev ELSE 0.0 END AS hiver, CASE WHEN season = 'Printemps' THEN dev ELSE 0.0 END AS printemps, CASE WHEN season = 'Ete' THEN dev ELSE 0.0 END AS ete, CASE WHEN season = 'Automne' THEN dev ELSE 0.0 END AS automne
  FROM (SELECT *, CASE WHEN month(month) IN (11, 12, 1, 2, 3) THEN 'Hiver' WHEN month(month) IN (4, 5) THEN 'Printemps' WHEN month(month) = 10 THEN 'Automne' ELSE 'Ete' END AS season FROM water_m))"""


@query("shp17_water_value_fit", "SELECT market, season, round(regr_slope(p, dev), 6) AS slope, count(*) AS months FROM (SELECT market, CASE WHEN m IN (11, 12, 1, 2, 3) THEN 'Hiver' WHEN m IN (4, 5) THEN 'Printemps' WHEN m = 10 THEN 'Automne' ELSE 'Ete' END AS season, p, dev FROM (SELECT x.market, year(x.d) AS y, month(x.d) AS m, avg(x.price) AS p, avg(h.fill_pct) AS dev FROM daily x ASOF LEFT JOIN hydro h ON x.d >= h.week GROUP BY ALL)) GROUP BY market, season")
def shp17(t):
    """Price on fill for each season alone, without the trend; shp17b has the whole regression."""
    rows = joins.asof_weekly(t.daily, t.hydro, "d", "week", "fill_pct")
    months = rows.groupBy("market", F.year("d").alias("y"), F.month("d").alias("m")).agg(F.avg("price").alias("p"), F.avg("fill_pct").alias("dev"))
    return months.groupBy("market", cal.season(F.col("m")).alias("season")).agg(R(F.regr_slope("p", "dev"), "slope"), F.count(F.lit(1)).alias("months"))


@query("shp17c_water_design", """SELECT market, round(trend, 6) AS trend, round(p, 6) AS p, round(hiver, 6) AS hiver, round(printemps, 6) AS printemps, round(ete, 6) AS ete, round(automne, 6) AS automne, months FROM water_x""", WATER)
def shp17c(t):
    """The design rows of the water value's regression: a month's mean price, the trend and the reservoir's deviation
    from its usual level in the month's season."""
    return water_months(t).select("market", *(R(c, c) for c in ("trend", "p", "hiver", "printemps", "ete", "automne")), "months")


def water_months(t):
    usual = t.hydro.groupBy(F.weekofyear("week").alias("w")).agg(F.avg("fill_pct").alias("typical"))
    deviations = t.hydro.withColumn("w", F.weekofyear("week")).join(usual, "w").select("week", (F.col("fill_pct") - F.col("typical")).alias("dev"))
    rows = joins.asof_weekly(t.daily, deviations, "d", "week", "dev").where("dev IS NOT NULL")
    months = rows.groupBy("market", F.to_date(F.date_trunc("month", "d")).alias("month")).agg(F.avg("price").alias("p"), F.avg("dev").alias("dev"))
    return shapes.water_design(months)


@query("shp17b_water_value_betas")
def shp17b(t):
    return shapes.water_fit(water_months(t)).select("market", R("beta", "beta", 8), *(R(c, c) for c in shapes.WATER_SEASONS), "months")


@query("shp18_water_value", """SELECT market, CAST(d AS VARCHAR) AS d, round(greatest(0.8, least(1.2, raw / avg(raw) OVER (PARTITION BY market))), 6) AS f FROM (SELECT market, d, greatest(0.8, least(1.2, 1.0 + 0.03 * coalesce(dev, 0) * CASE season WHEN 'Hiver' THEN -0.8 WHEN 'Printemps' THEN -0.3 WHEN 'Ete' THEN -0.1 ELSE -0.5 END)) AS raw
  FROM (SELECT x.market, x.d, (h.fill_pct - 80) / 5 AS dev FROM daily x ASOF LEFT JOIN hydro h ON x.d >= h.week) JOIN cal USING (d))""", CAL)
def shp18(t):
    rows = joins.asof_weekly(t.daily, t.hydro, "d", "week", "fill_pct").join(t.calendar, "d")
    f = shapes.water_value((F.col("fill_pct") - 80) / 5, F.col("season"), Window.partitionBy("market"))
    return rows.select("market", S("d"), R(f, "f"))


BANDS = "bands AS (SELECT series, hour, CASE WHEN n >= 20 AND abs(m) >= 1 THEN a / m ELSE 0.85 END AS p10, CASE WHEN n >= 20 AND abs(m) >= 1 THEN b / m ELSE 1.0 END AS p50, CASE WHEN n >= 20 AND abs(m) >= 1 THEN c / m ELSE 1.15 END AS p90 FROM (SELECT series, hour, count(*) AS n, avg(price) AS m, quantile_cont(price, 0.1) AS a, quantile_cont(price, 0.5) AS b, quantile_cont(price, 0.9) AS c FROM hourly GROUP BY series, hour))"


def bands(t):
    q = hourly(t).groupBy("series", "hour").agg(F.count(F.lit(1)).alias("n"), F.avg("price").alias("m"), F.percentile("price", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q"))
    ok = (F.col("n") >= 20) & (F.abs("m") >= 1)
    return q.select("series", "hour", *(F.when(ok, F.col("q")[k] / F.col("m")).otherwise(F.lit(v)).alias(n) for k, (n, v) in enumerate((("p10", 0.85), ("p50", 1.0), ("p90", 1.15)))))


@query("shp19_cell_bands", "SELECT series, hour, round(p10, 6) AS p10, round(p50, 6) AS p50, round(p90, 6) AS p90 FROM bands", f"{HOURLY}, {BANDS}")
def shp19(t):
    return bands(t).select("series", "hour", *(R(c, c) for c in ("p10", "p50", "p90")))


@query("shp19b_bootstrap_bands")
def shp19b(t):
    rows = hourly(t).withColumn("row_id", F.xxhash64("series", "ts"))
    return shapes.bootstrap_bands(rows, ["series", "hour"], "price").select("series", "hour", *(R(c, c) for c in ("p10", "p50", "p90")))


@query("shp20_apply_bands", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(price - abs(price - price * p10 / greatest(p50, 0.01)) * 2.5, 6) AS p10, round(price + abs(price * p90 / greatest(p50, 0.01) - price) * 2.5, 6) AS p90 FROM hourly JOIN bands USING (series, hour)", f"{HOURLY}, {BANDS}")
def shp20(t):
    rows = hourly(t).join(bands(t), ["series", "hour"])
    months = tg.months_between(F.lit("2024-01-01").cast("date"), F.col("ts"))
    lo, hi = shapes.banded(F.col("price"), F.col("p10"), F.col("p50"), F.col("p90"), tg.step_lookup(months, tg.WIDENING, 4.2))
    return rows.select("series", S("ts"), R(lo, "p10"), R(hi, "p90"))


@query("shp21_exogenous_forecast", "SELECT series, CAST(g.ts AS VARCHAR) AS ts, round(m, 6) AS typical FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-02 23:45:00', INTERVAL 15 minute)) AS TIMESTAMP) AS ts) g JOIN (SELECT series, hour(ts) AS h, minute(ts) AS q, median(price) AS m FROM spot GROUP BY ALL) c ON hour(g.ts) = h AND minute(g.ts) = q")
def shp21(t):
    typical = t.spot.groupBy("series", F.hour("ts").alias("h"), F.minute("ts").alias("q")).agg(F.median("price").alias("typical"))
    ahead = tg.grid(t.spark.range(1).select(F.lit("2024-02-01").cast("timestamp_ntz").alias("start"), F.lit("2024-02-03").cast("timestamp_ntz").alias("end")), "15 MINUTES")
    return ahead.withColumns({"h": F.hour("ts"), "q": F.minute("ts")}).join(typical, ["h", "q"]).select("series", S("ts"), R("typical", "typical"))


@query("shp22_deviation_ramp", "SELECT CAST(week AS VARCHAR) AS week, round(dev * (1 - (row_number() OVER (PARTITION BY year(week) ORDER BY week) - 1) / greatest(count(*) OVER (PARTITION BY year(week)) - 1, 1)), 6) + 0.0 AS deviation FROM (SELECT week, (SELECT arg_max(fill_pct, week) FROM hydro) - (SELECT avg(fill_pct) FROM hydro) AS dev FROM hydro)")
def shp22(t):
    now = t.hydro.agg((F.max_by("fill_pct", "week") - F.avg("fill_pct")).alias("dev"))
    rows = t.hydro.withColumn("y", F.year("week")).crossJoin(F.broadcast(now))
    n = F.count(F.lit(1)).over(Window.partitionBy("y"))
    ramp = 1 - (F.row_number().over(Window.partitionBy("y").orderBy("week")) - 1) / F.greatest(n - 1, F.lit(1))
    return rows.select(S("week"), (R(F.col("dev") * ramp, "x") + 0.0).alias("deviation"))


_BANDS23 = "CASE WHEN de <= q[1] THEN 'low' WHEN de <= q[2] THEN 'mid' ELSE 'high' END"


@query("shp23_diagnostics", f"""SELECT dimension, bucket, count(*) AS n, round(corr(ch, de), 6) AS corr, round(regr_slope(ch, de), 6) AS slope, round(avg(ch) FILTER (de > q[2]) - avg(ch) FILTER (de <= q[1]), 6) AS gap FROM (
  SELECT ch, de, q, unnest(['hour', 'season', 'season x band', 'all']) AS dimension, unnest([CAST(hour AS VARCHAR), season, season || ' x ' || {_BANDS23}, 'all']) AS bucket FROM (SELECT a.d, a.hour, a.price AS ch, b.price AS de FROM mhours a JOIN mhours b ON b.d = a.d AND b.hour = a.hour WHERE a.market = 'CH' AND b.market = 'DE')
  JOIN cal USING (d), (SELECT quantile_cont(price, [0.3333333333333333, 0.6666666666666666]) AS q FROM mhours WHERE market = 'DE')) GROUP BY dimension, bucket""", f"{HOURLY}, {HOUR_WAYS}, {CAL}")
def shp23(t):
    """Correlation and slope of the price on the other market's, by hour, season, season and price band, and the price's gap between
    that market's dear and cheap hours."""
    hours = market_hours(t)
    side = lambda m, c: hours.where(F.col("market") == m).select("d", "hour", F.col("price").alias(c))
    edges = hours.where("market = 'DE'").agg(F.percentile("price", F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("q"))
    rows = side("CH", "ch").join(side("DE", "de"), ["d", "hour"]).join(t.calendar, "d").crossJoin(F.broadcast(edges))
    low, high = F.col("de") <= F.col("q")[0], F.col("de") > F.col("q")[1]
    band = F.when(low, "low").when(high, "high").otherwise("mid")
    buckets = {"hour": F.col("hour").cast("string"), "season": F.col("season"), "season x band": F.concat_ws(" x ", "season", band), "all": F.lit("all")}
    long = rows.select("ch", "de", low.alias("low"), high.alias("high"), F.inline(F.array(*(F.struct(F.lit(n).alias("dimension"), c.alias("bucket")) for n, c in buckets.items()))))
    gap = F.avg(F.when(F.col("high"), F.col("ch"))) - F.avg(F.when(F.col("low"), F.col("ch")))
    return long.groupBy("dimension", "bucket").agg(F.count(F.lit(1)).alias("n"), R(F.corr("ch", "de"), "corr"), R(F.regr_slope("ch", "de"), "slope"), R(gap, "gap"))
