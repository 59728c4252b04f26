"""Queries FCT1-FCT10 and VAL1-VAL20: forecasting, backtests, error reports, quality gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import timegrid as tg
from ..operators import aggregates as agg
from ..operators import forecast as fc
from ..operators import joins, recurrence, shapes, trees
from ..operators import windows as win
from ..sources import writers
from .curve_plans import RESC, rescaled_curve
from .registry import query
from .shape_plans import BANDS, CELL, FQ, RATIOS, bands, quarter_table, ratios
from .table_plans import HOUR_WAYS, HOURLY, NAIVE, PAIR, hourly, market_hours, naive, pair
from .time_plans import CAL, R, S

COLUMNS = ["lag1", "lag2", "lag3", "lag7", "momentum", "vol7", "weekday"]
OVER = "(PARTITION BY market ORDER BY d)"
WEEK = "(PARTITION BY market ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"


EXOGENOUS_SQL = """SELECT h.market, h.d, h.hour, h.price, n.price AS neighbour, l.load, g.gas, w.fill_pct AS fill FROM mhours h LEFT JOIN mhours n ON n.d = h.d AND n.hour = h.hour AND n.market <> h.market
  LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS load FROM lineitem GROUP BY ALL) l ON l.d = h.d LEFT JOIN (SELECT d, avg(close) AS gas FROM commodities GROUP BY d) g ON g.d = h.d ASOF LEFT JOIN hydro w ON h.d >= w.week"""


def exogenous_days(t):
    """(d, fill, load, gas) of each day: the latest week's fill, the quantity shipped, the commodities' mean close."""
    load = t.lineitem.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.sum("l_quantity").alias("load"))
    gas = t.commodities.groupBy("d").agg(F.avg("close").alias("gas"))
    days = t.daily.select("d").distinct()
    return joins.asof_weekly(days, t.hydro, "d", "week", "fill_pct").withColumnRenamed("fill_pct", "fill").join(load, "d", "left").join(gas, "d", "left")


def exogenous_hours(t):
    """Every hour with the neighbour's price, the day's load and gas price and the latest week's fill."""
    hours = market_hours(t)
    other = hours.select(F.when(F.col("market") == "CH", "DE").otherwise("CH").alias("market"), "d", "hour", F.col("price").alias("neighbour"))
    return hours.join(other, ["market", "d", "hour"], "left").join(exogenous_days(t), "d", "left")


_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in ("price", "neighbour", "load", "gas", "fill"))


@query("fct1_exogenous", f"SELECT market, CAST(d AS VARCHAR) AS d, hour, {_ROUNDED} FROM ({EXOGENOUS_SQL})", f"{HOURLY}, {HOUR_WAYS}")
def fct1(t):
    return exogenous_hours(t).select("market", S("d"), "hour", *(R(c, c) for c in ("price", "neighbour", "load", "gas", "fill")))


@query("fct2_features", f"SELECT market, CAST(d AS VARCHAR) AS d, round(lag(price, 1) OVER {OVER}, 6) AS lag1, round(lag(price, 7) OVER {OVER}, 6) AS lag7, round(lag(price, 1) OVER {OVER} - lag(price, 7) OVER {OVER}, 6) AS momentum, round(CASE WHEN count(price) OVER {WEEK} >= 3 THEN stddev_samp(price) OVER {WEEK} END, 6) AS vol7, CAST(isodow(d) - 1 AS INT) AS weekday FROM daily")
def fct2(t):
    rows = fc.features(t.daily)
    return rows.select("market", S("d"), R("lag1", "lag1"), R("lag7", "lag7"), R("momentum", "momentum"), R("vol7", "vol7"), F.col("weekday").cast("int").alias("weekday"))


WINDOWS = (42, 56, 84, 180, 365)


def rolling(t):
    """(training rows, test rows) of each market and cutoff: a cutoff is the first of a month, once a full window
    lies before it; its training rows are those of the 365 days before, its test rows the days of its month."""
    rows = fc.features(t.daily)
    cutoffs = fc.month_starts(t.daily, ["market"], F.date_add("first", max(WINDOWS)), "cutoff")
    return fc.before(rows, cutoffs, ["market"], "cutoff", F.date_sub("cutoff", max(WINDOWS))), fc.within(rows, cutoffs, ["market"], "cutoff")


def trained(t):
    train, test = rolling(t)
    return fc.fits(train, ["market", "cutoff"], COLUMNS, WINDOWS), test


def forecasts(t):
    """(market, cutoff, d, price, forecast) of each day from the latest cutoff before it."""
    models, test = trained(t)
    return fc.applied(test, models, ["market", "cutoff"], COLUMNS)


def hour_rows(t, ahead: int = 0):
    """Feature rows of both markets' hours and, with null prices, of the days ahead: each is the other's neighbour; the shipped
    quantity stands for load."""
    hours = market_hours(t)
    other = hours.withColumn("market", F.when(F.col("market") == "CH", "DE").otherwise("CH"))
    return fc.hour_features(hours, other, exogenous_days(t), ["load"], {"gas": 2, "fill": 0}, ahead=ahead)


def _hour_sql() -> str:
    own = "OVER (PARTITION BY market, hour ORDER BY d)"
    back = lambda c, k: f"lag({c}, {k}) {own}"
    columns = {}
    for k in (1, 2, 3, 7):
        columns |= {f"{c}_d{k}": back(c, k) for c in ("price", "mean", "peak", "offpeak", "max")}
    week = "OVER (PARTITION BY market, hour ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    columns |= {"momentum": f"{back('price', 1)} - {back('price', 2)}", "vol7": f"CASE WHEN count(price) {week} >= 3 THEN stddev_samp(price) {week} END"}
    for k in (1, 2, 7):
        columns |= {f"beside_d{k}": back("beside", k), f"beside_mean_d{k}": back("beside_mean", k)}
    columns |= {"spread_d1": f"{back('price', 1)} - {back('beside', 1)}", "load_d0": "load", "load_d1": back("load", 1), "load_d7": back("load", 7), "gas_d2": back("gas", 2), "fill_d0": "fill"}
    columns |= {f"dow_{k}": f"CASE WHEN isodow(d) = {k + 1} THEN 1.0 ELSE 0.0 END" for k in range(6)}
    columns |= {"weekend": "CASE WHEN isodow(d) >= 6 THEN 1.0 ELSE 0.0 END", "month_sin": "sin(month(d) * pi() / 6)", "month_cos": "cos(month(d) * pi() / 6)"}
    chosen = ", ".join(f"round({v}, 6) + 0.0 AS {n}" for n, v in columns.items())
    return f"""SELECT market, CAST(d AS VARCHAR) AS d, hour, round(price, 6) AS price, {chosen} FROM (
  SELECT h.*, n.price AS beside, n.beside_mean, l.load, g.gas, w.fill_pct AS fill
  FROM (SELECT *, count(price) OVER p AS n_hours, avg(price) OVER p AS mean, avg(price) FILTER (hour BETWEEN 8 AND 19) OVER p AS peak, avg(price) FILTER (hour NOT BETWEEN 8 AND 19) OVER p AS offpeak, max(price) OVER p AS max FROM mhours WINDOW p AS (PARTITION BY market, d)) h
  LEFT JOIN (SELECT *, avg(price) OVER (PARTITION BY market, d) AS beside_mean FROM mhours) n ON n.d = h.d AND n.hour = h.hour AND n.market <> h.market
  LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS load FROM lineitem GROUP BY ALL) l ON l.d = h.d
  LEFT JOIN (SELECT d, avg(close) AS gas FROM commodities GROUP BY d) g ON g.d = h.d
  ASOF LEFT JOIN hydro w ON h.d >= w.week WHERE n_hours >= 23)"""


@query("fct2b_hourly_features", _hour_sql(), f"{HOURLY}, {HOUR_WAYS}")
def fct2b(t):
    rows = hour_rows(t)
    return rows.select("market", S("d"), "hour", R("price", "price"), *(R(c, c) for c in fc.feature_names(rows)))


def hour_models(t, latest: bool = False):
    """(feature rows, models of every market, hour, cutoff and window, or of the latest cutoff), written once."""
    work = writers.shared_folder(t.spark, "hours")
    rows = t.settled("hour_rows", lambda: hour_rows(t))
    fc.hourly_fits(rows, WINDOWS, fc.feature_names(rows), latest=latest).write.parquet(f"{work}/models")
    return rows, t.spark.read.parquet(f"{work}/models")


def hour_backtest(t):
    """(market, hour, d, cutoff, actual, forecast) of each day from the latest cutoff before it, recalibrated to the
    spread of the 28 days before."""
    rows, models = hour_models(t)
    asked = rows.withColumn("cutoff", F.to_date(F.date_trunc("month", "d")))
    found = fc.hourly_forecasts(asked, models, fc.feature_names(rows)).select("market", "hour", "d", "cutoff", F.col("price").alias("actual"), "forecast")
    w = win.by(["market", "hour"], "d", -28, -1)
    found = found.withColumns({"mf": F.avg("forecast").over(w), "sf": F.stddev_samp("forecast").over(w), "ma": F.avg("actual").over(w), "sa": F.stddev_samp("actual").over(w)})
    better = fc.recalibrated(*(F.col(c) for c in ("forecast", "mf", "sf", "ma", "sa")))
    return found.withColumn("forecast", F.coalesce(F.when(F.col("sf").isNotNull(), better), F.col("forecast"))).drop("mf", "sf", "ma", "sa")


@query("fct3b_hourly_fits")
def fct3b(t):
    _, models = hour_models(t)
    return models.select("market", "hour", S("cutoff"), "window", R("intercept", "intercept", 5), F.transform("coefs", lambda c: F.round(c, 5)).cast("string").alias("coefs"))


AHEAD = 10


def _carried_sql() -> str:
    """Feature rows of the days ahead from those of the last 14 days: what lies k days before a day ahead, or the last day."""
    lag = lambda c, k: f"CASE WHEN {k} >= ahead THEN max({c}) FILTER (pos = {k} - ahead) ELSE max({c}) FILTER (pos = 0) END"
    columns = {f"{c}_d{k}": lag(c, k) for k in (1, 2, 3, 7) for c in ("price", "mean", "peak", "offpeak", "max")}
    columns |= {f"{c}_d{k}": lag(c, k) for k in (1, 2, 7) for c in ("beside", "beside_mean")}
    columns |= {"load_d0": "avg(load) FILTER (pos < 28)", "load_d1": f"CASE WHEN ahead = 1 THEN {lag('load', 1)} ELSE avg(load) FILTER (pos < 28) END", "load_d7": f"CASE WHEN ahead <= 7 THEN {lag('load', 7)} ELSE avg(load) FILTER (pos < 28) END", "gas_d2": lag("gas", 2), "fill_d0": "max(fill) FILTER (pos = 0)"}
    chosen = ", ".join(f"round({v}, 6) + 0.0 AS {n}" for n, v in columns.items())
    return f"""SELECT market, CAST(any_value(last) + CAST(ahead AS INT) AS VARCHAR) AS d, hour, CAST(ahead AS INT) AS ahead, {chosen} FROM (
  SELECT h.*, n.price AS beside, n.beside_mean, l.load, g.gas, w.fill_pct AS fill, row_number() OVER (PARTITION BY h.market, h.hour ORDER BY h.d DESC) - 1 AS pos, max(h.d) OVER (PARTITION BY h.market, h.hour) AS last
  FROM (SELECT *, count(price) OVER p AS n_hours, avg(price) OVER p AS mean, avg(price) FILTER (hour BETWEEN 8 AND 19) OVER p AS peak, avg(price) FILTER (hour NOT BETWEEN 8 AND 19) OVER p AS offpeak, max(price) OVER p AS max FROM mhours WINDOW p AS (PARTITION BY market, d)) h
  LEFT JOIN (SELECT *, avg(price) OVER (PARTITION BY market, d) AS beside_mean FROM mhours) n ON n.d = h.d AND n.hour = h.hour AND n.market <> h.market
  LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS load FROM lineitem GROUP BY ALL) l ON l.d = h.d
  LEFT JOIN (SELECT d, avg(close) AS gas FROM commodities GROUP BY d) g ON g.d = h.d
  ASOF LEFT JOIN hydro w ON h.d >= w.week WHERE n_hours >= 23), range(1, {AHEAD + 1}) r(ahead) GROUP BY market, hour, ahead"""


def future_rows(t):
    """Feature rows of the AHEAD days after each market's last one, with ahead."""
    rows = hour_rows(t, AHEAD).withColumn("ahead", F.row_number().over(Window.partitionBy("market", "hour", F.col("price").isNull()).orderBy("d")))
    return rows.where("price IS NULL")


@query("fct5b_future_rows", _carried_sql(), f"{HOURLY}, {HOUR_WAYS}")
def fct5b(t):
    """Feature rows of the days ahead, but for the calendar and what other columns imply."""
    rows = future_rows(t)
    derived = ("momentum", "vol7", "spread_d1", "weekend", "month_sin", "month_cos", *(f"dow_{k}" for k in range(6)))
    names = [c for c in fc.feature_names(rows) if c not in (*derived, "ahead")]
    return rows.select("market", S("d"), "hour", "ahead", *((R(c, "x") + 0.0).alias(c) for c in names))


@query("fct8b_hourly_forecasts")
def fct8b(t):
    """The next days' hours of each market with bands, from the feature rows of those days; bands are the 90 percent quantile
    of the last 90 days' absolute errors of the same models, wider with the days ahead."""
    rows, models = hour_models(t, latest=True)
    columns, (market, hour) = fc.feature_names(rows), ("market", "hour")
    cutoffs = models.select(market, hour, "cutoff").distinct()
    found = fc.hourly_forecasts(future_rows(t).join(cutoffs, [market, hour]), models, columns)
    tested = fc.hourly_forecasts(rows.join(cutoffs, [market, hour]).where(F.col("d") >= F.date_sub("cutoff", 90)), models, columns)
    misses = tested.groupBy(market, hour).agg(F.percentile(F.abs(F.col("forecast") - F.col("price")), F.lit(0.9)).alias("width"), F.count(F.lit(1)).alias("n"))
    found = found.join(misses, [market, hour], "left").withColumn("forecast", F.greatest("forecast", F.lit(-50.0)))
    half = fc.conformal_half(F.col("width"), F.coalesce("n", F.lit(0)), F.col("forecast"), F.col("ahead"))
    local = F.make_timestamp_ntz(F.year("d"), F.month("d"), F.dayofmonth("d"), F.col("hour"), F.lit(0), F.lit(0))
    return found.select(market, tg.to_utc(local).cast("string").alias("ts"), F.col("ahead").alias("days_ahead"), R("forecast", "forecast"), R(F.col("forecast") - half, "p10"), R(F.col("forecast") + half, "p90"))


@query("fct9b_hourly_backtest")
def fct9b(t):
    """Every hour of each day from the latest monthly fits, corrected by the last errors of its hour."""
    rows = recurrence.corrected(hour_backtest(t), ["market", "hour"], "d")
    return rows.select("market", "hour", S("d"), R("corrected", "forecast"), R("actual", "actual"), R("error", "error"))


@query("fct3_regularised_fits")
def fct3(t):
    models, _ = trained(t)
    return models.select("market", S("cutoff"), "window", R("intercept", "intercept", 5), F.transform("coefs", lambda c: F.round(c, 5)).cast("string").alias("coefs"))


@query("fct4_tree_blend")
def fct4(t):
    """60/40 blend of the linear forecast with boosted trees over all series, an ensemble for each cutoff, all grown together."""
    train, test = (side.dropna(subset=COLUMNS).select("cutoff", "market", "d", "price", *COLUMNS) for side in rolling(t))
    rows = train.withColumn("asked", F.lit(False)).unionByName(test.withColumns({"asked": F.lit(True), "price": F.lit(None).cast("double")}))
    found = trees.boosted(rows, ["cutoff"], COLUMNS, "price", t.settler("trees")).where("asked").select("market", "cutoff", "d", "prediction")
    return forecasts(t).join(found, ["market", "cutoff", "d"]).select("market", S("d"), R(0.6 * F.col("forecast") + 0.4 * F.col("prediction"), "forecast"))


@query("fct5_future_features", f"SELECT market, ahead, round(arg_max(price, d), 6) AS last, round(avg(price), 6) AS mean28 FROM (SELECT market, d, price, row_number() OVER (PARTITION BY market ORDER BY d DESC) AS rn FROM daily), (SELECT CAST(unnest(range(1, 11)) AS INT) AS ahead) WHERE rn <= 28 GROUP BY market, ahead")
def fct5(t):
    rows = t.daily.withColumn("rn", F.row_number().over(Window.partitionBy("market").orderBy(F.desc("d")))).where("rn <= 28")
    base = rows.groupBy("market").agg(R(F.max_by("price", "d"), "last"), R(F.avg("price"), "mean28"))
    return base.select("market", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("ahead"), "last", "mean28")


@query("fct6_recalibration", "SELECT market, CAST(d AS VARCHAR) AS d, round(greatest(f - sa, least(f + sa, ma + (f - mf) * least(coalesce(sa / nullif(sf, 0), 1.0), 2.0))), 6) AS forecast FROM (SELECT market, d, lag7 AS f, avg(lag7) OVER w AS mf, stddev_samp(lag7) OVER w AS sf, avg(price) OVER w AS ma, stddev_samp(price) OVER w AS sa FROM (SELECT market, d, price, lag(price, 7) OVER (PARTITION BY market ORDER BY d) AS lag7 FROM daily) WINDOW w AS (PARTITION BY market ORDER BY d ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)) WHERE f IS NOT NULL AND sf IS NOT NULL")
def fct6(t):
    rows = t.daily.withColumn("f", F.lag("price", 7).over(win.by(["market"], "d")))
    w = win.by(["market"], "d", -28, -1)
    rows = rows.withColumns({"mf": F.avg("f").over(w), "sf": F.stddev_samp("f").over(w), "ma": F.avg("price").over(w), "sa": F.stddev_samp("price").over(w)}).dropna(subset=["f", "sf"])
    return rows.select("market", S("d"), R(fc.recalibrated(*(F.col(c) for c in ("f", "mf", "sf", "ma", "sa"))), "forecast"))


@query("fct7_conformal", "SELECT series, hour, round(quantile_cont(abs(price - naive), 0.9), 6) AS half_width FROM (SELECT series, CAST(hour(ts) AS INT) AS hour, price, naive FROM naive) GROUP BY series, hour", NAIVE)
def fct7(t):
    rows = naive(t)
    return rows.groupBy("series", F.hour("ts").alias("hour")).agg(R(F.percentile(F.abs(F.col("price") - F.col("naive")), F.lit(0.9)), "half_width"))


@query("fct7b_conformal_bands", """SELECT series, hour, ahead, round(forecast, 6) AS forecast, round(forecast - half, 6) AS p10, round(forecast + half, 6) AS p90 FROM (
  SELECT *, CASE WHEN n >= 20 THEN width * (1.0 + 0.05 * (ahead - 1)) ELSE 1.28 * abs(forecast) * (0.05 + 0.01 * ahead) END AS half FROM (
    SELECT series, CAST(hour(ts) AS INT) AS hour, count(*) AS n, quantile_cont(abs(price - naive), 0.9) AS width, arg_max(naive, ts) AS forecast FROM naive GROUP BY ALL), (SELECT CAST(unnest(range(1, 11)) AS INT) AS ahead))""", NAIVE)
def fct7b(t):
    """Bands of the next ten days around the latest naive forecast of each series and hour."""
    rows = naive(t)
    per = rows.groupBy("series", F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.percentile(F.abs(F.col("price") - F.col("naive")), F.lit(0.9)).alias("width"), F.max_by("naive", "ts").alias("forecast"))
    per = per.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(10))))
    half = fc.conformal_half(F.col("width"), F.col("n"), F.col("forecast"), F.col("ahead"))
    return per.select("series", "hour", "ahead", R("forecast", "forecast"), R(F.col("forecast") - half, "p10"), R(F.col("forecast") + half, "p90"))


@query("fct8_forecast_table")
def fct8(t):
    return forecasts(t).select("market", S("d"), R(F.greatest("forecast", F.lit(-50.0)), "forecast"), (F.datediff("d", "cutoff") + 1).alias("days_ahead"))


@query("fct9_backtest")
def fct9(t):
    rows = forecasts(t).select("market", "d", "forecast", F.col("price").alias("actual"))
    return recurrence.corrected(rows, ["market"], "d").select("market", S("d"), R("corrected", "forecast"), R("error", "error"))


@query("fct10_seasonal_naive", "SELECT series, round(avg(abs(price - naive)), 6) AS mae, round(sqrt(avg((price - naive) * (price - naive))), 6) AS rmse FROM naive GROUP BY series", NAIVE)
def fct10(t):
    e = F.col("price") - F.col("naive")
    m = agg.error_metrics(e, F.col("price"))
    return naive(t).groupBy("series").agg(R(m["mae"], "mae"), R(m["rmse"], "rmse"))


FOLDS = """starts AS (SELECT market, CAST(unnest(generate_series(CAST(date_trunc('month', min(d) + INTERVAL 24 month + INTERVAL 1 month - INTERVAL 1 day) AS DATE), max(d), INTERVAL 1 month)) AS DATE) AS fold FROM daily GROUP BY market),
lagged AS (SELECT *, lag(price, 7) OVER (PARTITION BY market ORDER BY d) AS l7 FROM daily),
folds AS (SELECT t.market, t.fold, level, actual, rmse, mae, bias, n, coverage FROM (SELECT s.market, s.fold, avg(x.price) AS actual, sqrt(avg((l7 - x.price) * (l7 - x.price))) AS rmse, avg(abs(l7 - x.price)) AS mae, avg(l7 - x.price) AS bias, count(*) AS n, avg(CASE WHEN x.price BETWEEN l7 + b.lo AND l7 + b.hi THEN 1.0 ELSE 0.0 END) AS coverage
  FROM starts s JOIN lagged x ON x.market = s.market AND date_trunc('month', x.d) = s.fold JOIN bands24 b ON b.market = s.market AND b.fold = s.fold WHERE l7 IS NOT NULL GROUP BY ALL) t JOIN bands24 USING (market, fold))"""
BANDS24 = "bands24 AS (SELECT s.market, s.fold, avg(x.price) AS level, quantile_cont(x.price - l7, 0.1) AS lo, quantile_cont(x.price - l7, 0.9) AS hi FROM starts s JOIN lagged x ON x.market = s.market AND x.d < s.fold AND x.d >= s.fold - INTERVAL 24 month WHERE l7 IS NOT NULL GROUP BY ALL)"


def monthly_folds(t, rows):
    """(training rows, test rows) of each market's months after its first 24, trained on the 24 months before."""
    folds = fc.month_starts(t.daily, ["market"], F.add_months("first", 24), "fold")
    return fc.before(rows, folds, ["market"], "fold", F.add_months("fold", -24)), fc.within(rows, folds, ["market"], "fold")


@query("val1_walk_forward", "SELECT market, CAST(fold AS VARCHAR) AS fold, round(level, 6) AS level, round(actual, 6) AS actual, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(bias, 6) + 0.0 AS bias, round(coverage, 6) AS coverage, n FROM folds", FOLDS.replace("folds AS (", BANDS24 + ",\nfolds AS (", 1))
def val1(t):
    """Monthly folds of the seasonal naive value (seven days before): the training months give the level and an 80 percent band
    of its errors, the test month its KPIs and the band's coverage. Folds come from the data, so any years have theirs."""
    rows = t.daily.withColumn("l7", F.lag("price", 7).over(win.by(["market"], "d"))).where("l7 IS NOT NULL")
    train, test = monthly_folds(t, rows)
    of = train.groupBy("market", "fold").agg(F.avg("price").alias("level"), F.percentile(F.col("price") - F.col("l7"), F.array(F.lit(0.1), F.lit(0.9))).alias("q"))
    m = agg.error_metrics(F.col("l7") - F.col("price"), F.col("price"))
    inside = (F.col("price") >= F.col("l7") + F.col("q")[0]) & (F.col("price") <= F.col("l7") + F.col("q")[1])
    per = test.join(of, ["market", "fold"]).groupBy("market", "fold").agg(F.first("level").alias("level"), F.avg("price").alias("actual"), *(m[k].alias(k) for k in ("rmse", "mae", "bias")), agg.share(inside).alias("coverage"), F.count(F.lit(1)).alias("n"))
    return per.select("market", S("fold"), *(R(c, c) for c in ("level", "actual", "rmse", "mae")), (R("bias", "x") + 0.0).alias("bias"), R("coverage", "coverage"), "n")


@query("val1b_monthly_folds")
def val1b(t):
    """Folds are rows: a fit on the 24 months before each month is tested on that month, beside the naive value of
    seven days before."""
    train, test = monthly_folds(t, fc.features(t.daily))
    level = train.groupBy("market", "fold").agg(F.avg("price").alias("level"))
    models = fc.fits(train, ["market", "fold"], COLUMNS, (2 * 366,))
    found = fc.applied(test, models, ["market", "fold"], COLUMNS).join(test.select("market", "fold", "d", "lag7"), ["market", "fold", "d"])
    m, naive = agg.error_metrics(F.col("forecast") - F.col("price"), F.col("price")), agg.error_metrics(F.col("lag7") - F.col("price"), F.col("price"))
    per = found.groupBy("market", "fold").agg(F.avg("price").alias("actual"), *(m[k].alias(k) for k in ("rmse", "mae", "bias")), naive["rmse"].alias("naive"), F.count(F.lit(1)).alias("n"))
    skill = 1 - F.try_divide("rmse", "naive")
    return per.join(level, ["market", "fold"]).select("market", S("fold"), R("level", "level"), R("actual", "actual"), R("rmse", "rmse"), R("mae", "mae"), R("bias", "bias"), R(skill, "skill"), "n")


INTRA = f"""{RATIOS}, {FQ}, obs AS (SELECT r.series, r.quarter, r.ratio, coalesce(f, 1.0) AS f, quantile_cont(ratio, 0.1) OVER (PARTITION BY r.series, r.quarter) AS lo, quantile_cont(ratio, 0.9) OVER (PARTITION BY r.series, r.quarter) AS hi FROM ratios r LEFT JOIN fq USING (series, season, day_type, hour, quarter))"""


@query("val2_intrahour", "SELECT series, count(*) AS n, round(sqrt(avg((ratio - f) * (ratio - f))), 6) AS rmse, round(sqrt(avg((ratio - 1) * (ratio - 1))), 6) AS rmse_flat, round(1 - avg((ratio - f) * (ratio - f)) / nullif(avg((ratio - 1) * (ratio - 1)), 0), 6) + 0.0 AS skill, round(avg(CASE WHEN ratio BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END), 6) AS coverage FROM obs GROUP BY series", INTRA)
def val2(t):
    """Error of the quarter factors against the observed ratios, skill against flat hours, and the coverage of each quarter's 80 percent
    band."""
    rows = ratios(t).join(quarter_table(t), [*CELL, "hour", "quarter"], "left").withColumn("f", F.coalesce("f", F.lit(1.0)))
    edges = rows.groupBy("series", "quarter").agg(F.percentile("ratio", F.array(F.lit(0.1), F.lit(0.9))).alias("q"))
    square = lambda x: F.avg((F.col("ratio") - x) * (F.col("ratio") - x))
    model, flat = square(F.col("f")), square(F.lit(1.0))
    inside = F.col("ratio").between(F.col("q")[0], F.col("q")[1])
    return rows.join(edges, ["series", "quarter"]).groupBy("series").agg(F.count(F.lit(1)).alias("n"), R(F.sqrt(model), "rmse"), R(F.sqrt(flat), "rmse_flat"), (R(1 - F.try_divide(model, flat), "x") + 0.0).alias("skill"), R(agg.share(inside), "coverage"))


EXPAND = f"""{HOURLY}, {HOUR_WAYS}, kh AS (SELECT market, d, CAST(date_trunc('month', d) AS DATE) AS fold, isodow(d) >= 6 AS weekend, hour, price FROM mhours),
cell0 AS (SELECT market, fold, weekend, hour, sum(price) AS s, count(*) AS n FROM kh GROUP BY ALL),
cgrid AS (SELECT f.market, f.fold, k.weekend, k.hour FROM (SELECT DISTINCT market, fold FROM kh) f, (SELECT DISTINCT weekend, hour FROM kh) k),
cell AS (SELECT market, fold, weekend, hour, sum(s) OVER w AS s, sum(n) OVER w AS n, sum(sum_all) OVER w AS sa, sum(n_all) OVER w AS na FROM cgrid LEFT JOIN cell0 USING (market, fold, weekend, hour)
  LEFT JOIN (SELECT market, fold, sum(s) AS sum_all, sum(n) AS n_all FROM cell0 GROUP BY ALL) USING (market, fold) WINDOW w AS (PARTITION BY market, weekend, hour ORDER BY fold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lastm AS (SELECT f.market, f.fold, avg(h.price) AS base FROM (SELECT DISTINCT market, fold FROM kh) f JOIN kh h ON h.market = f.market AND h.d < f.fold AND h.d >= f.fold - INTERVAL 30 day GROUP BY ALL),
naivew AS (SELECT f.market, f.fold, isodow(h.d) AS w, h.hour, avg(h.price) AS naive FROM (SELECT DISTINCT market, fold FROM kh) f JOIN kh h ON h.market = f.market AND h.d < f.fold AND h.d >= f.fold - INTERVAL 7 day GROUP BY ALL),
scored AS (SELECT k.market, k.fold, k.price, base * coalesce((s / n) / (sa / na), 1) AS pred, coalesce(naive, sa / na) AS naive FROM kh k JOIN cell c USING (market, fold, weekend, hour) JOIN lastm USING (market, fold) LEFT JOIN naivew v ON v.market = k.market AND v.fold = k.fold AND v.w = isodow(k.d) AND v.hour = k.hour WHERE na >= 30 * 24),
scaled AS (SELECT *, pred * avg(price) OVER (PARTITION BY market, fold) / nullif(avg(pred) OVER (PARTITION BY market, fold), 0) AS shaped FROM scored)"""


def _kpis(c: str, prefix: str) -> str:
    e = f"({c} - price)"
    return f"round(sqrt(avg({e} * {e})), 5) AS {prefix}_rmse, round(avg(abs{e}), 5) AS {prefix}_mae, round(avg{e}, 5) + 0.0 AS {prefix}_bias, round(1 - avg({e} * {e}) / greatest(avg((naive - price) * (naive - price)), 1e-10), 5) AS {prefix}_skill, round(corr({c}, price), 5) AS {prefix}_corr"


@query("val3_expanding", f"SELECT market, CAST(fold AS VARCHAR) AS fold, count(*) AS n, {_kpis('pred', 'raw')}, {_kpis('shaped', 'shape')} FROM scaled GROUP BY market, fold", EXPAND)
def val3(t):
    """Every month is forecast from all hours before it: the level of the last 30 days times the profile of weekdays and weekend
    hours; KPIs as forecast and with the month's level put right, skill against the week before."""
    found = t.settled("expanding", lambda: fc.expanding_profiles(market_hours(t)))
    mean = lambda c: F.avg(c).over(Window.partitionBy("market", "fold"))
    found = found.withColumn("shaped", F.col("pred") * mean("price") / F.nullif(mean("pred"), F.lit(0.0)))

    def kpis(c: str, prefix: str):
        e, m = F.col(c) - F.col("price"), agg.error_metrics(F.col(c) - F.col("price"), F.col("price"))
        naive = F.col("naive") - F.col("price")
        skill = 1 - F.avg(e * e) / F.greatest(F.avg(naive * naive), F.lit(1e-10))
        return [R(m["rmse"], f"{prefix}_rmse", 5), R(m["mae"], f"{prefix}_mae", 5), (R(m["bias"], "x", 5) + 0.0).alias(f"{prefix}_bias"), R(skill, f"{prefix}_skill", 5), R(F.corr(c, "price"), f"{prefix}_corr", 5)]

    return found.groupBy("market", S("fold")).agg(F.count(F.lit(1)).alias("n"), *kpis("pred", "raw"), *kpis("shaped", "shape"))


@query("val4_vs_benchmark", "SELECT count(*) AS n, round(avg(abs(ch - de)), 6) AS mae, round(sqrt(avg((ch - de) * (ch - de))), 6) AS rmse, round(avg(ch - de), 6) AS bias FROM pair", PAIR)
def val4(t):
    m = agg.error_metrics(F.col("ch") - F.col("de"), F.col("de"))
    return pair(t).agg(F.count(F.lit(1)).alias("n"), *(R(m[k], k) for k in ("mae", "rmse", "bias")))


SHIFT = f"{HOURLY}, both_h AS (SELECT a.series, a.d, a.hour, a.price AS p, b.price AS q FROM hourly a JOIN hourly b ON a.series = b.series AND a.hour = b.hour AND b.d = a.d + INTERVAL 1 day)"


def shifted(t):
    """Each hour with the same hour of the next day."""
    h = hourly(t)
    after = h.select("series", F.date_sub("d", 1).alias("d"), "hour", F.col("price").alias("q"))
    return h.select("series", "d", "hour", F.col("price").alias("p")).join(after, ["series", "d", "hour"])


PROFILE = f"""{SHIFT}, ranked_h AS (SELECT *, rank() OVER (PARTITION BY series, d ORDER BY p) + (count(*) OVER (PARTITION BY series, d, p) - 1) / 2.0 AS rp, rank() OVER (PARTITION BY series, d ORDER BY q) + (count(*) OVER (PARTITION BY series, d, q) - 1) / 2.0 AS rq FROM both_h),
dayp AS (SELECT series, d, corr(p, q) AS pearson, corr(rp, rq) AS spearman, abs(arg_max(hour, p * 1000 - hour / 1e6) - arg_max(hour, q * 1000 - hour / 1e6)) AS high, abs(arg_min(hour, p * 1000 + hour / 1e6) - arg_min(hour, q * 1000 + hour / 1e6)) AS low,
  CASE WHEN avg(abs(p - q)) > 0.01 THEN stddev_pop(p - q) / avg(abs(p - q)) END AS cv FROM ranked_h GROUP BY series, d HAVING count(*) >= 20)"""


@query("val5_profile_metrics", "SELECT series, count(*) AS days, round(median(pearson), 6) AS pearson, round(median(spearman), 6) AS spearman, round(avg(high + low), 6) AS mpd, round(avg(high), 6) AS mhd, round(median(cv), 6) AS cov_e FROM dayp GROUP BY series", PROFILE)
def val5(t):
    """Of days with 20 hours: median profile correlations, mean displacement of the dearest (and of both extreme) hours, median
    variation of the errors within a day."""
    both = shifted(t)
    rows = both.withColumns({"rp": agg.average_rank("p", ["series", "d"]), "rq": agg.average_rank("q", ["series", "d"])})
    high = lambda c: F.max_by("hour", F.col(c) * 1000 - F.col("hour") / 1e6)
    low = lambda c: F.min_by("hour", F.col(c) * 1000 + F.col("hour") / 1e6)
    e = F.col("p") - F.col("q")
    size = F.avg(F.abs(e))
    per = rows.groupBy("series", "d").agg(F.corr("p", "q").alias("pearson"), F.corr("rp", "rq").alias("spearman"), F.abs(high("p") - high("q")).alias("high"), F.abs(low("p") - low("q")).alias("low"), F.when(size > 0.01, F.stddev_pop(e) / size).alias("cv"), F.count(F.lit(1)).alias("n")).where("n >= 20")
    return per.groupBy("series").agg(F.count(F.lit(1)).alias("days"), R(F.median("pearson"), "pearson"), R(F.median("spearman"), "spearman"), R(F.avg(F.col("high") + F.col("low")), "mpd"), R(F.avg("high"), "mhd"), R(F.median("cv"), "cov_e"))


@query("val6_spread_error", "SELECT series, round(abs(sp - sq), 6) AS error, round(sp / nullif(sq, 0), 6) AS ratio FROM (SELECT series, avg(p) FILTER (hour BETWEEN 8 AND 19) - avg(p) FILTER (hour NOT BETWEEN 8 AND 19) AS sp, avg(q) FILTER (hour BETWEEN 8 AND 19) - avg(q) FILTER (hour NOT BETWEEN 8 AND 19) AS sq FROM both_h GROUP BY series)", SHIFT)
def val6(t):
    day = F.col("hour").between(8, 19)
    spread = lambda c: F.avg(F.when(day, F.col(c))) - F.avg(F.when(~day, F.col(c)))
    rows = shifted(t).groupBy("series").agg(spread("p").alias("sp"), spread("q").alias("sq"))
    return rows.select("series", R(F.abs(F.col("sp") - F.col("sq")), "error"), R(F.try_divide("sp", "sq"), "ratio"))


@query("val7_dispatch_capture", "SELECT series, round(sum(q) FILTER (rp <= 8) / sum(q) FILTER (rq <= 8), 6) AS capture, round(avg(q) FILTER (rp <= 8) / avg(q), 6) AS vs_flat FROM (SELECT *, row_number() OVER (PARTITION BY series, d ORDER BY p DESC, hour) AS rp, row_number() OVER (PARTITION BY series, d ORDER BY q DESC, hour) AS rq FROM both_h) GROUP BY series", SHIFT)
def val7(t):
    rank = lambda c: F.row_number().over(win.by(["series", "d"], [F.desc(c), F.asc("hour")]))
    rows = shifted(t).withColumns({"rp": rank("p"), "rq": rank("q")})
    chosen, best = F.when(F.col("rp") <= 8, F.col("q")), F.when(F.col("rq") <= 8, F.col("q"))
    return rows.groupBy("series").agg(R(F.sum(chosen) / F.sum(best), "capture"), R(F.avg(chosen) / F.avg("q"), "vs_flat"))


@query("val8_shape_rmse", "SELECT market, round(sqrt(avg((price * k - spot) * (price * k - spot))), 6) AS shape_rmse FROM (SELECT r.market, r.d, r.price, x.price AS spot, avg(x.price) OVER (PARTITION BY r.market) / avg(r.price) OVER (PARTITION BY r.market) AS k FROM resc r JOIN daily x USING (market, d)) GROUP BY market", RESC)
def val8(t):
    w = Window.partitionBy("market")
    rows = rescaled_curve(t).withColumn("k", F.avg("spot").over(w) / F.avg("price").over(w))
    e = F.col("price") * F.col("k") - F.col("spot")
    return rows.groupBy("market").agg(R(F.sqrt(F.avg(e * e)), "shape_rmse"))


SLICES = {
    "hour": "CAST(hour AS VARCHAR)", "weekday": "CAST(isodow(d) - 1 AS VARCHAR)", "month": "CAST(month(d) AS VARCHAR)", "season": "season", "quarter": "CAST(quarter(d) AS VARCHAR)",
    "weekend": "CASE WHEN isodow(d) >= 6 THEN 'weekend' ELSE 'weekday' END", "ramp_hours": "CASE WHEN hour BETWEEN 6 AND 10 OR hour BETWEEN 17 AND 20 THEN 'ramp' ELSE 'flat' END",
    "ramp": "CASE WHEN price > 1.05 * before THEN 'up' WHEN price < 0.95 * before THEN 'down' ELSE 'level' END",
    "quintile": "CASE WHEN price <= q[1] THEN 'Q1' WHEN price <= q[2] THEN 'Q2' WHEN price <= q[3] THEN 'Q3' WHEN price <= q[4] THEN 'Q4' ELSE 'Q5' END", "cell": "season || '/' || day_type || '/' || hour", "all": "'all'",
}
SLICED = f"""{HOURLY}, {HOUR_WAYS}, {CAL}, err AS (SELECT m.*, season, CASE market WHEN 'CH' THEN day_type_ch ELSE day_type_de END AS day_type, q, lag(m.price, 168) OVER w - m.price AS e, lag(m.price) OVER w AS before
  FROM mhours m JOIN cal USING (d) JOIN (SELECT market, quantile_cont(price, [0.2, 0.4, 0.6, 0.8]) AS q FROM mhours GROUP BY market) USING (market) WINDOW w AS (PARTITION BY market ORDER BY d, hour)),
lng AS ({" UNION ALL ".join(f"SELECT market, '{n}' AS dimension, {v} AS bucket, e FROM err WHERE e IS NOT NULL" for n, v in SLICES.items())})"""


@query("val9_error_slices", "SELECT market, dimension, bucket, count(*) AS n, round(sqrt(avg(e * e)), 5) AS rmse, round(avg(e), 5) + 0.0 AS bias, round(avg(abs(e)), 5) AS mae, round(sum(e * e) / any_value(total), 6) AS contribution FROM lng JOIN (SELECT market, sum(e * e) AS total FROM err GROUP BY market) USING (market) GROUP BY ALL", SLICED)
def val9(t):
    """Errors of the value of a week before by calendar, ramp, price quintile and cell, with each bucket's part of the squared
    error: one pass over rows that name their bucket in every dimension."""
    hours = market_hours(t)
    edges = hours.groupBy("market").agg(F.percentile("price", F.array(*map(F.lit, (0.2, 0.4, 0.6, 0.8)))).alias("q"))
    w = Window.partitionBy("market").orderBy("d", "hour")
    rows = hours.withColumns({"e": F.lag("price", 168).over(w) - F.col("price"), "before": F.lag("price").over(w)}).where("e IS NOT NULL").join(edges, "market").join(t.calendar, "d")
    rows = rows.withColumn("day_type", F.when(F.col("market") == "CH", F.col("day_type_ch")).otherwise(F.col("day_type_de")))
    h, p, text = F.col("hour"), F.col("price"), lambda c: c.cast("string")
    quintile = F.when(p <= F.col("q")[0], "Q1").when(p <= F.col("q")[1], "Q2").when(p <= F.col("q")[2], "Q3").when(p <= F.col("q")[3], "Q4").otherwise("Q5")
    buckets = {
        "hour": text(h), "weekday": text(F.weekday("d")), "month": text(F.month("d")), "season": F.col("season"), "quarter": text(F.quarter("d")), "weekend": F.when(F.weekday("d") >= 5, "weekend").otherwise("weekday"),
        # Hours in which prices usually ramp.
        "ramp_hours": F.when(h.between(6, 10) | h.between(17, 20), "ramp").otherwise("flat"), "ramp": F.when(p > 1.05 * F.col("before"), "up").when(p < 0.95 * F.col("before"), "down").otherwise("level"),
        "quintile": quintile, "cell": F.concat_ws("/", "season", "day_type", text(h)), "all": F.lit("all"),
    }
    long = rows.select("market", "e", F.inline(F.array(*(F.struct(F.lit(n).alias("dimension"), c.alias("bucket")) for n, c in buckets.items()))))
    e = F.col("e")
    sums = long.groupBy("market", "dimension", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("squares"), F.avg(e).alias("bias"), F.avg(F.abs(e)).alias("mae"))
    share = F.col("squares") / F.sum("squares").over(Window.partitionBy("market", "dimension"))
    return sums.select("market", "dimension", "bucket", "n", R(F.sqrt(F.col("squares") / F.col("n")), "rmse", 5), (R("bias", "x", 5) + 0.0).alias("bias"), R("mae", "mae", 5), R(share, "contribution"))


@query("val10_day_factor_gap", "SELECT market, weekday, round(ideal, 6) AS ideal, round(model, 6) AS model, round(model - ideal, 6) AS gap FROM (SELECT market, CAST(isodow(d) - 1 AS INT) AS weekday, avg(spot) / any_value(a) AS ideal, avg(f_w) AS model FROM curve JOIN (SELECT market, avg(spot) AS a FROM curve GROUP BY market) USING (market) GROUP BY market, isodow(d))", RESC)
def val10(t):
    rows = rescaled_curve(t)
    mean = rows.groupBy("market").agg(F.avg("spot").alias("a"))
    per = rows.join(mean, "market").groupBy("market", F.weekday("d").alias("weekday")).agg((F.avg("spot") / F.first("a")).alias("ideal"), F.avg("f_w").alias("model"))
    return per.select("market", "weekday", R("ideal", "ideal"), R("model", "model"), R(F.col("model") - F.col("ideal"), "gap"))


@query("val11_composite_score", "SELECT round(0.35 * avg(abs(ch - de)) / 15.0 + 0.30 * sqrt(avg((ch - de) * (ch - de))) / 22.3 + 0.20 * (100 * avg(CASE WHEN abs(de) > 1 THEN abs((ch - de) / de) END)) / 30.9 + 0.15 * (1 - corr(ch, de)), 6) AS score FROM pair", PAIR)
def val11(t):
    m = agg.error_metrics(F.col("ch") - F.col("de"), F.col("de"))
    # Weights and scales of the score.
    score = 0.35 * m["mae"] / 15.0 + 0.30 * m["rmse"] / 22.3 + 0.20 * m["mape"] / 30.9 + 0.15 * (1 - F.corr("ch", "de"))
    return pair(t).agg(R(score, "score"))


@query("val12_ab_variants", """SELECT market, round(mae_a, 6) AS mae_a, round(mae_b, 6) AS mae_b, round(rmse_a, 6) AS rmse_a, round(rmse_b, 6) AS rmse_b, round(bias_a, 6) + 0.0 AS bias_a, round(bias_b, 6) + 0.0 AS bias_b, round(corr_a, 6) AS corr_a, round(corr_b, 6) AS corr_b, round(100 * (rmse_b / rmse_a - 1), 6) + 0.0 AS percent, CASE WHEN rmse_b < rmse_a THEN 'B' ELSE 'A' END AS better FROM (
  SELECT c.market, avg(abs(raw - spot)) AS mae_a, avg(abs(r.price - spot)) AS mae_b, sqrt(avg((raw - spot) * (raw - spot))) AS rmse_a, sqrt(avg((r.price - spot) * (r.price - spot))) AS rmse_b, avg(raw - spot) AS bias_a, avg(r.price - spot) AS bias_b, corr(raw, spot) AS corr_a, corr(r.price, spot) AS corr_b FROM curve c JOIN resc r USING (market, d) GROUP BY c.market)""", RESC)
def val12(t):
    """Two curves, raw (A) and rescaled (B), by every KPI; the better one has the lower RMSE."""
    kinds = F.array(*(F.struct(F.lit(n).alias("variant"), F.col(c).alias("p")) for n, c in (("a", "raw"), ("b", "price"))))
    rows = rescaled_curve(t).select("market", "spot", F.inline(kinds))
    m = agg.error_metrics(F.col("p") - F.col("spot"), F.col("spot"))
    wide = rows.groupBy("market").pivot("variant", ["a", "b"]).agg(*(m[k].alias(k) for k in ("mae", "rmse", "bias")), F.corr("p", "spot").alias("corr"))
    named = [R(f"{v}_{k}", f"{k}_{v}") if k != "bias" else (R(f"{v}_{k}", "x") + 0.0).alias(f"{k}_{v}") for k in ("mae", "rmse", "bias", "corr") for v in "ab"]
    return wide.select("market", *named, (R(100 * (F.col("b_rmse") / F.col("a_rmse") - 1), "x") + 0.0).alias("percent"), F.when(F.col("b_rmse") < F.col("a_rmse"), "B").otherwise("A").alias("better"))


WORK = f"""{HOURLY}, {HOUR_WAYS}, {CAL}, prof AS (SELECT market, month, hour, m / avg(m) OVER (PARTITION BY market, month) AS f FROM (SELECT market, CAST(date_trunc('month', d) AS DATE) AS month, hour, avg(price) AS m FROM mhours JOIN cal USING (d) WHERE CASE market WHEN 'CH' THEN day_type_ch ELSE day_type_de END = 'Ouvrable' GROUP BY ALL)),
cuts AS (SELECT p.*, CAST(month + to_months(k) AS DATE) AS cut, k <= 0 AS after FROM prof p, (SELECT CAST(unnest(range(-11, 13)) AS INT) AS k)),
tests AS (SELECT market, cut, hour, count(*) FILTER (NOT after) AS n0, count(*) FILTER (after) AS n1, avg(f) FILTER (NOT after) AS m0, avg(f) FILTER (after) AS m1, var_samp(f) FILTER (NOT after) AS v0, var_samp(f) FILTER (after) AS v1 FROM cuts GROUP BY ALL HAVING count(*) = 24)"""


@query("val13_structural_break", "SELECT market, CAST(cut AS VARCHAR) AS cut, hour, round((m1 - m0) / nullif(sqrt(v0 / n0 + v1 / n1), 0), 5) + 0.0 AS t FROM tests", WORK)
def val13(t):
    """Welch's t of each hour's place in the profile of working days, twelve months after each month's start against the twelve
    before."""
    return profile_tests(t).select("market", S("cut"), "hour", (R("t", "x", 5) + 0.0).alias("t"))


def profile_tests(t):
    rows = market_hours(t).join(t.calendar, "d").where(F.when(F.col("market") == "CH", F.col("day_type_ch")).otherwise(F.col("day_type_de")) == "Ouvrable")
    return agg.sliding_breaks(rows, ["market"])


@query("val13b_breaks")
def val13b(t):
    """Months at which the profile breaks: the least p-value of the 24 hours, corrected for their number, is below 0.05; the
    look-back recommended is from the market's last break on, 12 months at least, 36 without one."""
    return agg.breaks(profile_tests(t), ["market"]).select("market", S("cut"), R("p", "p"), "broken", "lookback_months")


#: What a series of prices has to have.
REQUIRED, LEAST_ROWS, STALE_HOURS = {"series", "ts", "price"}, 100, 48


@query("val14_input_gate", f"SELECT series, count(*) > 0 AS filled, true AS columns, count(*) >= {LEAST_ROWS} AS enough, count(*) = count(DISTINCT ts) AS unique_ts, count(DISTINCT ts) = date_diff('minute', min(ts), max(ts)) / 15 + 1 AS no_gaps, count(*) FILTER (price IS NULL) = 0 AS no_nulls, date_diff('minute', max(ts), any_value(as_of)) <= {60 * STALE_HOURS} AS fresh FROM spot, (SELECT max(ts) AS as_of FROM spot) GROUP BY series")
def val14(t, as_of: str | None = None):
    """Checks of each series in one pass; it is stale by as_of, or else by the newest time of all series."""
    now = t.spot.agg((F.max("ts") if as_of is None else F.lit(as_of).cast("timestamp_ntz")).alias("now"))
    minutes = lambda a, b: F.timestamp_diff("MINUTE", a, b)
    n = F.count_distinct("ts")
    rows = t.spot.crossJoin(F.broadcast(now)).groupBy("series")
    return rows.agg((F.count(F.lit(1)) > 0).alias("filled"), F.lit(set(t.spot.columns) >= REQUIRED).alias("columns"), (F.count(F.lit(1)) >= LEAST_ROWS).alias("enough"), (F.count(F.lit(1)) == n).alias("unique_ts"), (n == minutes(F.min("ts"), F.max("ts")) / 15 + 1).alias("no_gaps"), (F.count_if(F.col("price").isNull()) == 0).alias("no_nulls"), (minutes(F.max("ts"), F.first("now")) <= 60 * STALE_HOURS).alias("fresh"))


_MONTHS = "greatest((year(ts) - year(first)) * 12 + month(ts) - month(first), 0)"
_STEP = lambda steps, above: "CASE " + " ".join(f"WHEN m <= {k} THEN {v}" for k, v in steps) + f" ELSE {above} END::DOUBLE"
BANDED = f"""{HOURLY}, {BANDS}, banded0 AS (SELECT h.*, b.p10 AS b10, b.p50 AS b50, b.p90 AS b90, {_MONTHS} AS m FROM (SELECT *, min(ts) OVER (PARTITION BY series) AS first FROM hourly) h JOIN bands b USING (series, hour)),
banded AS (SELECT series, ts, d, hour, price, price - abs(price - price * b10 / greatest(b50, 0.01)) * {_STEP(tg.WIDENING, 4.2)} AS p10, price + abs(price * b90 / greatest(b50, 0.01) - price) * {_STEP(tg.WIDENING, 4.2)} AS p90, {_STEP(tg.CONFIDENCE, 0.45)} AS confidence FROM banded0)"""


def banded(t):
    """Hours with bands and confidence by their months from the series' first one."""
    rows = hourly(t).join(bands(t).withColumnsRenamed({c: f"b_{c}" for c in ("p10", "p50", "p90")}), ["series", "hour"])
    months = tg.months_between(F.min("ts").over(Window.partitionBy("series")), F.col("ts"))
    lo, hi = shapes.banded(F.col("price"), F.col("b_p10"), F.col("b_p50"), F.col("b_p90"), tg.step_lookup(months, tg.WIDENING, 4.2))
    return rows.select("series", "ts", "d", "hour", "price", lo.alias("p10"), hi.alias("p90"), tg.step_lookup(months, tg.CONFIDENCE, 0.45).alias("confidence"))


@query("val15_output_gate", "SELECT series, count(*) FILTER (price IS NULL) = 0 AS no_nulls, count(*) FILTER (abs(price) > 10000) = 0 AS in_range, count(*) FILTER (p10 > p90) = 0 AS bands_ordered, count(*) FILTER (confidence NOT BETWEEN 0 AND 1) = 0 AS confidence_ok FROM banded GROUP BY series", BANDED)
def val15(t):
    none = lambda bad: F.count_if(bad) == 0
    return banded(t).groupBy("series").agg(none(F.col("price").isNull()).alias("no_nulls"), none(F.abs("price") > 10000).alias("in_range"), none(F.col("p10") > F.col("p90")).alias("bands_ordered"), none(~F.col("confidence").between(0, 1)).alias("confidence_ok"))


# Usual range of prices and of factors, limits of recent errors.
USUAL_PRICE, USUAL_FACTOR, LIMITS = (-50, 500), (0.1, 5.0), {"rmse": 26, "mae": 20, "bias": 5}


@query("val16_daily_gate", f"""SELECT series, min(b.price) >= {USUAL_PRICE[0]} AND max(b.price) <= {USUAL_PRICE[1]} AS usual_price, min(b.price / m) >= {USUAL_FACTOR[0]} AND max(b.price / m) <= {USUAL_FACTOR[1]} AS usual_factors, min(p90 - p10) >= 0 AS bands_positive, round(avg(p90 - p10), 6) AS mean_width, any_value(rmse) <= {LIMITS['rmse']} AS rmse_ok, any_value(mae) <= {LIMITS['mae']} AS mae_ok, abs(any_value(bias)) <= {LIMITS['bias']} AS bias_ok
  FROM (SELECT *, avg(price) OVER (PARTITION BY series, d) AS m FROM banded) b JOIN (SELECT series, sqrt(avg((naive - price) * (naive - price))) AS rmse, avg(abs(naive - price)) AS mae, avg(naive - price) AS bias FROM naive WHERE ts > (SELECT max(ts) FROM spot) - INTERVAL 7 day GROUP BY series) r USING (series) GROUP BY series""", f"{BANDED}, {NAIVE}")
def val16(t):
    """Ranges of prices, of hour factors and of bands, and the errors of the last seven days against their limits."""
    m = agg.error_metrics(F.col("naive") - F.col("price"), F.col("price"))
    last = t.spot.agg((F.max("ts") - F.expr("INTERVAL 7 DAYS")).alias("from"))
    recent = naive(t).crossJoin(F.broadcast(last)).where(F.col("ts") > F.col("from")).groupBy("series").agg(*(m[k].alias(k) for k in LIMITS))
    rows = banded(t).withColumn("f", F.col("price") / F.avg("price").over(Window.partitionBy("series", "d"))).join(recent, "series")
    within = lambda c, ends: (F.min(c) >= ends[0]) & (F.max(c) <= ends[1])
    width = F.col("p90") - F.col("p10")
    limits = [(F.abs(F.first(k)) <= limit).alias(f"{k}_ok") for k, limit in LIMITS.items()]
    return rows.groupBy("series").agg(within("price", USUAL_PRICE).alias("usual_price"), within("f", USUAL_FACTOR).alias("usual_factors"), (F.min(width) >= 0).alias("bands_positive"), R(F.avg(width), "mean_width"), *limits)


@query("val17_benchmark_gate", "SELECT market, mae <= 20 AS passed, CASE WHEN mae <= 20 THEN 'ok' ELSE 'mae above 20' END AS reason FROM (SELECT r.market, avg(abs(r.price - x.price)) AS mae FROM resc r JOIN daily x USING (market, d) GROUP BY r.market)", RESC)
def val17(t):
    rows = rescaled_curve(t).groupBy("market").agg(F.avg(F.abs(F.col("price") - F.col("spot"))).alias("mae"))
    # Fixed value: the limit of the mean absolute error.
    ok = F.col("mae") <= 20
    return rows.select("market", ok.alias("passed"), F.when(ok, "ok").otherwise("mae above 20").alias("reason"))


@query("val18_parameter_search", "SELECT market, arg_min(half_life, rmse) AS best, round(min(rmse), 5) AS rmse FROM (SELECT market, half_life, sqrt(avg((price - level) * (price - level))) AS rmse FROM (SELECT b.market, h.half_life, b.d, any_value(b.price) AS price, sum(a.price * exp(-ln(2) * date_diff('day', a.d, b.d) / h.half_life)) / sum(exp(-ln(2) * date_diff('day', a.d, b.d) / h.half_life)) AS level FROM daily a JOIN daily b ON a.market = b.market AND a.d < b.d AND a.d >= b.d - INTERVAL 30 day, (VALUES (3.0), (7.0), (30.0)) h(half_life) GROUP BY b.market, h.half_life, b.d) GROUP BY market, half_life) GROUP BY market")
def val18(t):
    """Trials are rows: each half-life is tried on every day in one plan."""
    return half_lives(t, t.daily)


def half_lives(t, days):
    test = days.select("market", F.col("d").alias("b"), F.col("price").alias("actual"), F.explode(F.sequence(F.date_sub("d", 30), F.date_sub("d", 1))).alias("d"))
    trials = F.explode(F.array(F.lit(3.0), F.lit(7.0), F.lit(30.0)))
    rows = t.daily.join(test, ["market", "d"]).withColumn("half_life", trials)
    w = F.exp(-F.lit(0.6931471805599453) * F.datediff("b", "d") / F.col("half_life"))
    level = rows.groupBy("market", "half_life", "b").agg(F.first("actual").alias("actual"), agg.weighted_mean(F.col("price"), w).alias("level"))
    e = F.col("actual") - F.col("level")
    scores = level.groupBy("market", "half_life").agg(F.sqrt(F.avg(e * e)).alias("rmse"))
    return scores.groupBy("market").agg(F.min_by("half_life", "rmse").alias("best"), R(F.min("rmse"), "rmse", 5))


@query("val19_attribution", """SELECT l.market, round(hour_rmse, 6) AS hour_rmse, round(dow_spread, 6) AS dow_spread, round(month_bias, 6) AS month_bias, round(level, 6) AS level, round(intraday, 6) AS intraday FROM (SELECT market, abs(avg(e)) AS level FROM err WHERE e IS NOT NULL GROUP BY market) l
  JOIN (SELECT market, avg(r) AS hour_rmse FROM (SELECT market, sqrt(avg(e * e)) AS r FROM err GROUP BY market, hour) GROUP BY market) USING (market) JOIN (SELECT market, stddev_samp(r) AS dow_spread FROM (SELECT market, sqrt(avg(e * e)) AS r FROM err GROUP BY market, isodow(d)) GROUP BY market) USING (market)
  JOIN (SELECT market, avg(abs(b)) AS month_bias FROM (SELECT market, avg(e) AS b FROM err GROUP BY market, month(d)) GROUP BY market) USING (market) JOIN (SELECT market, sqrt(avg((e - m) * (e - m))) AS intraday FROM (SELECT market, e, avg(e) OVER (PARTITION BY market, d) AS m FROM err WHERE e IS NOT NULL) GROUP BY market) USING (market)""", SLICED)
def val19(t):
    """What a market's error is made of: mean error by hour, spread by weekday, bias by month, level, and the part within days."""
    w = Window.partitionBy("market").orderBy("d", "hour")
    rows = market_hours(t).withColumn("e", F.lag("price", 168).over(w) - F.col("price")).where("e IS NOT NULL")
    e, of = F.col("e"), lambda *by: rows.groupBy("market", *by)
    rmse, within = F.sqrt(F.avg(e * e)).alias("r"), e - F.avg("e").over(Window.partitionBy("market", "d"))
    parts = [
        of("hour").agg(rmse).groupBy("market").agg(R(F.avg("r"), "hour_rmse")), of(F.weekday("d")).agg(rmse).groupBy("market").agg(R(F.stddev_samp("r"), "dow_spread")),
        of(F.month("d")).agg(F.avg("e").alias("b")).groupBy("market").agg(R(F.avg(F.abs("b")), "month_bias")), of().agg(R(F.abs(F.avg("e")), "level")),
        rows.withColumn("within", within).groupBy("market").agg(R(F.sqrt(F.avg(F.col("within") * F.col("within"))), "intraday")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "market")
    return out


@query("val20_freshness", "SELECT 'events' AS source, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS latest FROM events UNION ALL SELECT 'orders', CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) FROM orders UNION ALL SELECT 'lineitem', CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) FROM lineitem")
def val20(t):
    of = lambda name, df, c: df.agg(F.to_date(F.max(c)).cast("string").alias("latest")).select(F.lit(name).alias("source"), "latest")
    return of("events", t.events, "ts").unionByName(of("orders", t.orders, "o_orderdate")).unionByName(of("lineitem", t.lineitem, "l_shipdate"))
