"""Queries WIN1-WIN22: lags, rolling statistics, fills, z-scores, regimes, revisions, recurrences."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import timegrid as tg
from ..operators import quantiles, recurrence
from ..operators import windows as win
from .registry import query
from .table_plans import HOURLY, LATEST, PAIR, hourly, latest_outages, pair
from .time_plans import GRID, R, S, bounds

BY = "(PARTITION BY market ORDER BY d)"


@query("win1_lags", f"SELECT market, CAST(d AS VARCHAR) AS d, " + ", ".join(f"round(lag(price, {k}) OVER {BY}, 6) AS lag{k}" for k in (1, 2, 3, 7)) + " FROM daily")
def win1(t):
    return t.daily.select("market", S("d"), *(R(F.lag("price", k).over(win.by(["market"], "d")), f"lag{k}") for k in (1, 2, 3, 7)))


@query("win2_momentum", f"SELECT market, CAST(d AS VARCHAR) AS d, round(lag(price, 1) OVER {BY} - lag(price, 7) OVER {BY}, 6) AS momentum FROM daily")
def win2(t):
    w = win.by(["market"], "d")
    return t.daily.select("market", S("d"), R(F.lag("price", 1).over(w) - F.lag("price", 7).over(w), "momentum"))


ROW7 = "(PARTITION BY market ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"


@query("win3_rolling", f"SELECT market, CAST(d AS VARCHAR) AS d, round(CASE WHEN count(price) OVER {ROW7} >= 3 THEN avg(price) OVER {ROW7} END, 6) AS mean7, round(CASE WHEN count(price) OVER {ROW7} >= 3 THEN stddev_samp(price) OVER {ROW7} END, 6) AS sd7 FROM daily")
def win3(t):
    roll = lambda fn: win.rolling(fn, "price", ["market"], "d", -7, -1, 3)
    return t.daily.select("market", S("d"), R(roll(F.avg), "mean7"), R(roll(F.stddev_samp), "sd7"))


BAND = "(PARTITION BY name ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


@query("win4_bollinger", f"SELECT name, CAST(d AS VARCHAR) AS d, round(m, 6) AS sma, CASE WHEN n = 20 AND close > m + 2 * s THEN 'above' WHEN n = 20 AND close < m - 2 * s THEN 'below' WHEN n = 20 THEN 'inside' END AS signal FROM (SELECT *, count(*) OVER {BAND} AS n, CASE WHEN count(*) OVER {BAND} = 20 THEN avg(close) OVER {BAND} END AS m, stddev_samp(close) OVER {BAND} AS s FROM commodities)")
def win4(t):
    mean, sd = (win.rolling(fn, "close", ["name"], "d", -19, 0, 20) for fn in (F.avg, F.stddev_samp))
    rows = t.commodities.withColumns({"m": mean, "s": sd})
    signal = F.when(F.col("close") > F.col("m") + 2 * F.col("s"), "above").when(F.col("close") < F.col("m") - 2 * F.col("s"), "below").when(F.col("m").isNotNull(), "inside")
    return rows.select("name", S("d"), R("m", "sma"), signal.alias("signal"))


@query("win5_rolling_corr", "SELECT CAST(d AS VARCHAR) AS d, round(CASE WHEN count(*) OVER w >= 60 THEN corr(ch, de) OVER w END, 5) AS corr60 FROM pair WINDOW w AS (ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)", PAIR)
def win5(t):
    """Correlation of two markets over 60 rows; a pair of markets is the key."""
    w = win.by(["markets"], "d", -59, 0)
    rows = pair(t).withColumn("markets", F.lit("CH-DE"))
    return rows.select(S("d"), R(F.when(F.count(F.lit(1)).over(w) >= 60, F.corr("ch", "de").over(w)), "corr60", 5))


@query("win6_returns", "SELECT name, CAST(d AS VARCHAR) AS d, round(close / lag(close) OVER (PARTITION BY name ORDER BY d) - 1, 6) AS change, round(close / lag(close, 20) OVER (PARTITION BY name ORDER BY d) - 1, 6) AS change20 FROM commodities")
def win6(t):
    back = lambda k: F.col("close") / F.lag("close", k).over(win.by(["name"], "d")) - 1
    return t.commodities.select("name", S("d"), R(back(1), "change"), R(back(20), "change20"))


@query("win7_rebase", "SELECT name, CAST(d AS VARCHAR) AS d, round(100 * close / first_value(close) OVER (PARTITION BY name ORDER BY d), 6) AS rebased FROM commodities")
def win7(t):
    return t.commodities.select("name", S("d"), R(100 * F.col("close") / F.first("close").over(win.by(["name"], "d")), "rebased"))


@query("win8_fills", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(last_value(price IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS UNBOUNDED PRECEDING), 6) AS forward, round(first_value(price IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS backward FROM grid LEFT JOIN spot USING (series, ts)", GRID)
def win8(t):
    rows = tg.grid(bounds(t), "15 MINUTES", ("series",)).join(t.spot, ["series", "ts"], "left")
    return rows.select("series", S("ts"), R(win.ffill("price", ["series"], "ts"), "forward"), R(win.bfill("price", ["series"], "ts"), "backward"))


@query("win9_interpolate", """SELECT series, CAST(ts AS VARCHAR) AS ts, round(coalesce(price, y0 + (y1 - y0) * (x - x0) / nullif(x1 - x0, 0)), 6) AS price FROM (SELECT *,
  last_value(CASE WHEN price IS NOT NULL THEN x END IGNORE NULLS) OVER b AS x0, last_value(price IGNORE NULLS) OVER b AS y0, first_value(CASE WHEN price IS NOT NULL THEN x END IGNORE NULLS) OVER f AS x1, first_value(price IGNORE NULLS) OVER f AS y1
  FROM (SELECT series, ts, price, epoch(ts) AS x FROM grid LEFT JOIN spot USING (series, ts)) WINDOW b AS (PARTITION BY series ORDER BY ts ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""", GRID)
def win9(t):
    rows = tg.grid(bounds(t), "15 MINUTES", ("series",)).join(t.spot, ["series", "ts"], "left")
    filled = win.interpolated(rows, "price", ["series"], "ts", F.unix_timestamp("ts"), "filled")
    return filled.select("series", S("ts"), R("filled", "price"))


@query("win10_normalise", "SELECT series, CAST(ts AS VARCHAR) AS ts, round(price / avg(price) OVER (PARTITION BY series, d), 6) AS ratio FROM hourly", HOURLY)
def win10(t):
    return hourly(t).select("series", S("ts"), R(win.normalised("price", ["series", "d"]), "ratio"))


@query("win11_monthly_zscore", "SELECT market, CAST(d AS VARCHAR) AS d, round(coalesce((price - avg(price) OVER w) / nullif(stddev_samp(price) OVER w, 0), 0), 6) AS z FROM daily WINDOW w AS (PARTITION BY market, year(d), month(d))")
def win11(t):
    rows = t.daily.withColumn("m", F.date_trunc("month", "d"))
    return rows.select("market", S("d"), R(win.zscore("price", ["market", "m"]), "z"))


@query("win12_regime_percentile", "SELECT market, CAST(d AS VARCHAR) AS d, CASE WHEN price <= a THEN 0 WHEN price <= b THEN 1 ELSE 2 END AS regime FROM (SELECT *, date_trunc('month', d) AS m FROM daily) JOIN (SELECT market, date_trunc('month', d) AS m, quantile_cont(price, 0.33) AS a, quantile_cont(price, 0.66) AS b FROM daily GROUP BY ALL) USING (market, m)")
def win12(t):
    rows = win.quantile_edges(t.daily.withColumn("m", F.date_trunc("month", "d")), "price", ["market", "m"], [0.33, 0.66])
    return rows.select("market", S("d"), F.when(F.col("price") <= F.col("q")[0], 0).when(F.col("price") <= F.col("q")[1], 1).otherwise(2).alias("regime"))


@query("win13_regime_equal", "SELECT series, CAST(ts AS VARCHAR) AS ts, CASE WHEN lo = a OR a = b OR b = hi THEN 1 WHEN price <= a THEN 0 WHEN price <= b THEN 1 ELSE 2 END AS regime FROM (SELECT *, CAST(ts AS DATE) AS m FROM spot) JOIN (SELECT series, CAST(ts AS DATE) AS m, min(price) AS lo, max(price) AS hi, quantile_cont(price, 1.0 / 3) AS a, quantile_cont(price, 2.0 / 3) AS b FROM spot GROUP BY ALL) USING (series, m)")
def win13(t):
    rows = win.quantile_edges(t.spot.withColumn("m", F.to_date("ts")), "price", ["series", "m"], [0.0, 1 / 3, 2 / 3, 1.0])
    lo, a, b, hi = (F.col("q")[k] for k in range(4))
    # edges that coincide leave fewer than three bins: all are the middle one
    regime = F.when((lo == a) | (a == b) | (b == hi), 1).when(F.col("price") <= a, 0).when(F.col("price") <= b, 1).otherwise(2)
    return rows.select("series", S("ts"), regime.alias("regime"))


@query("win14_spikes", "SELECT series, CAST(ts AS VARCHAR) AS ts, abs(price) > cut AS spike FROM spot JOIN (SELECT series, quantile_cont(abs(price), 0.999) AS cut FROM spot GROUP BY series) USING (series)")
def win14(t):
    found = quantiles.exact_quantiles(t.spot.select("series", F.abs("price").alias("size")), ["series"], "size", [0.999], t.settler("spikes"))
    cut = found.select("series", F.col("q")[0].alias("cut"))
    return t.spot.join(cut, "series").select("series", S("ts"), (F.abs("price") > F.col("cut")).alias("spike"))


@query("win15_seasonal_zscore", """SELECT CAST(week AS VARCHAR) AS week, round(CASE WHEN weeks < 3 THEN 0 WHEN n10 >= 3 THEN coalesce((fill_pct - m10) / nullif(s10, 0), 0) WHEN n >= 2 THEN coalesce((fill_pct - m) / nullif(s, 0), 0) ELSE 0 END, 5) AS z FROM (
  SELECT a.week, any_value(a.fill_pct) AS fill_pct, any_value(a.weeks) AS weeks, count(b.fill_pct) AS n, avg(b.fill_pct) AS m, stddev_samp(b.fill_pct) AS s, count(b.fill_pct) FILTER (recent) AS n10, avg(b.fill_pct) FILTER (recent) AS m10, stddev_samp(b.fill_pct) FILTER (recent) AS s10
  FROM (SELECT *, count(*) OVER (PARTITION BY weekofyear(week)) AS weeks FROM hydro) a LEFT JOIN LATERAL (SELECT fill_pct, h.week >= a.week - INTERVAL 10 year AS recent FROM hydro h WHERE weekofyear(h.week) = weekofyear(a.week) AND h.week < a.week) b ON true GROUP BY a.week)""")
def win15(t):
    """Distance from the same week's mean of the ten years before, if they have three values, else of all years before, if
    those have two; 0 otherwise and for weeks that fewer than three years have."""
    a = t.hydro.select("week", "fill_pct", F.weekofyear("week").alias("iso"))
    a = a.withColumn("weeks", F.count(F.lit(1)).over(Window.partitionBy("iso")))
    b = t.hydro.select(F.col("week").alias("before"), F.col("fill_pct").alias("past"), F.weekofyear("week").alias("iso"))
    met = a.join(b, (a["iso"] == b["iso"]) & (b["before"] < a["week"]), "left")
    near = F.when(F.col("before") >= F.add_months("week", -120), F.col("past"))
    z = lambda x: F.coalesce((F.first("fill_pct") - F.avg(x)) / F.nullif(F.stddev_samp(x), F.lit(0.0)), F.lit(0.0))
    chosen = F.when(F.first("weeks") < 3, F.lit(0.0)).when(F.count(near) >= 3, z(near)).when(F.count("past") >= 2, z(F.col("past"))).otherwise(F.lit(0.0))
    return met.groupBy("week").agg(R(chosen, "z", 5)).select(S("week"), "z")


@query("win16_decay_weights", "SELECT market, CAST(d AS VARCHAR) AS d, round(exp(-ln(2) * date_diff('day', d, last) / 365.0), 8) AS w FROM daily JOIN (SELECT market, max(d) AS last FROM daily GROUP BY market) USING (market)")
def win16(t):
    last = t.daily.groupBy("market").agg(F.max("d").alias("last"))
    return t.daily.join(last, "market").select("market", S("d"), R(win.decay_weight(F.col("d"), F.col("last"), 365.0), "w", 8))


@query("win17_latest_revision", "SELECT id, revision, CAST(start_ts AS VARCHAR) AS start_ts, round(mw, 6) AS mw FROM latest", LATEST)
def win17(t):
    return latest_outages(t).select("id", "revision", S("start_ts"), R("mw", "mw"))




MOST_LAG, DAY_LAGS = 672, 96


@query("win18_autocorrelation", f"""SELECT series, lag, round(acf, 6) + 0.0 AS acf, round(sum(acf * acf) FILTER (lag <= {DAY_LAGS}) OVER (PARTITION BY series), 6) AS day_squares FROM (SELECT a.series, b.i - a.i AS lag, sum(a.e * b.e) / any_value(a.total) AS acf
  FROM dev a JOIN dev b ON a.series = b.series AND b.i > a.i AND b.i <= a.i + {MOST_LAG} GROUP BY ALL)""", "dev AS (SELECT *, sum(e * e) OVER (PARTITION BY series) AS total FROM (SELECT series, row_number() OVER (PARTITION BY series ORDER BY ts) AS i, price - avg(price) OVER (PARTITION BY series) AS e FROM spot))")
def win18(t):
    """Autocorrelation of each series at every lag from 1 to a week of quarters of an hour, and the sum of squares of a day's lags."""
    found = win.autocorrelations(t.spot, ["series"], "ts", "price", MOST_LAG)
    squares = F.sum(F.when(F.col("lag") <= DAY_LAGS, F.col("acf") * F.col("acf"))).over(Window.partitionBy("series"))
    return found.withColumn("squares", squares).select("series", "lag", (R("acf", "x") + 0.0).alias("acf"), R("squares", "day_squares"))


@query("win19_quintiles", "SELECT market, bin, count(*) AS n, round(avg(price), 6) AS mean FROM (SELECT market, price, CASE WHEN price <= a THEN 0 WHEN price <= b THEN 1 WHEN price <= c THEN 2 WHEN price <= e THEN 3 ELSE 4 END AS bin FROM daily JOIN (SELECT market, quantile_cont(price, 0.2) AS a, quantile_cont(price, 0.4) AS b, quantile_cont(price, 0.6) AS c, quantile_cont(price, 0.8) AS e FROM daily GROUP BY market) USING (market)) GROUP BY ALL")
def win19(t):
    rows = win.quantile_edges(t.daily, "price", ["market"], [0.2, 0.4, 0.6, 0.8])
    bins = F.size(F.filter("q", lambda x: x < F.col("price")))
    return rows.select("market", bins.alias("bin"), "price").groupBy("market", "bin").agg(F.count(F.lit(1)).alias("n"), R(F.avg("price"), "mean"))


CLIP = "greatest(-100.0, least(100.0, {0}))".format
WALK = f"""(WITH RECURSIVE asked AS MATERIALIZED (SELECT market, d, price AS actual, forecast, row_number() OVER (PARTITION BY market ORDER BY d) AS n FROM (SELECT *, lag(price, 7) OVER (PARTITION BY market ORDER BY d) AS forecast FROM daily) WHERE forecast IS NOT NULL),
walk AS (
  SELECT market, n, d, forecast, c AS corrected, c - actual AS e1, CAST(NULL AS DOUBLE) AS e2, [c - actual] AS errors FROM (SELECT *, greatest(-500.0, least(1000.0, forecast)) AS c FROM asked WHERE n = 1)
  UNION ALL SELECT market, n, d, forecast, c, c - actual, e1, list_append(errors[-13:], c - actual) FROM (
    SELECT a.*, w.e1, w.errors, greatest(-500.0, least(1000.0, a.forecast - 0.6 * {CLIP("w.e1")} - CASE WHEN w.e2 IS NULL THEN 0.0 ELSE 0.15 * {CLIP("w.e2")} END - CASE WHEN len(w.errors) >= 3 THEN 0.7 * list_avg(w.errors) ELSE 0.0 END)) AS c
    FROM walk w JOIN asked a ON a.market = w.market AND a.n = w.n + 1)
) SELECT * FROM walk)"""


@query("win20_error_recurrence", f"SELECT market, CAST(d AS VARCHAR) AS d, round(forecast, 6) AS forecast, round(corrected, 6) AS corrected, round(e1, 6) AS error FROM {WALK}")
def win20(t):
    """The price of seven rows before as a forecast, corrected day by day by the last two corrected errors and their bias."""
    w = win.by(["market"], "d")
    rows = t.daily.select("market", "d", F.col("price").alias("actual"), F.lag("price", 7).over(w).alias("forecast")).dropna()
    return recurrence.corrected(rows, ["market"], "d").select("market", S("d"), R("forecast", "forecast"), R("corrected", "corrected"), R("error", "error"))


@query("win21_period_deltas", "SELECT market, round(avg(price) FILTER (d > last - INTERVAL 7 day), 6) AS week, round(avg(price) FILTER (d > last - INTERVAL 14 day AND d <= last - INTERVAL 7 day), 6) AS week_before FROM daily JOIN (SELECT market, max(d) AS last FROM daily GROUP BY market) USING (market) GROUP BY market")
def win21(t):
    last = t.daily.groupBy("market").agg(F.max("d").alias("last"))
    age = F.datediff("last", "d")
    rows = t.daily.join(last, "market")
    return rows.groupBy("market").agg(R(F.avg(F.when(age < 7, F.col("price"))), "week"), R(F.avg(F.when((age >= 7) & (age < 14), F.col("price"))), "week_before"))


@query("win22_envelope", "SELECT CAST(weekofyear(week) AS INT) AS iso_week, round(min(fill_pct) FILTER (year(week) < y), 6) AS low, round(quantile_cont(fill_pct, 0.5) FILTER (year(week) < y), 6) AS mid, round(max(fill_pct) FILTER (year(week) < y), 6) AS high, round(avg(fill_pct) FILTER (year(week) = y), 6) AS chosen FROM hydro, (SELECT max(year(week)) AS y FROM hydro) GROUP BY weekofyear(week)")
def win22(t):
    """Range of each week over the years before the last one, and the last year's own value."""
    last = t.hydro.agg(F.max(F.year("week")).alias("y"))
    past = F.when(F.year("week") < F.col("y"), F.col("fill_pct"))
    rows = t.hydro.crossJoin(F.broadcast(last)).groupBy(F.weekofyear("week").alias("iso_week"))
    return rows.agg(R(F.min(past), "low"), R(F.percentile(past, F.lit(0.5)), "mid"), R(F.max(past), "high"), R(F.avg(F.when(F.year("week") == F.col("y"), F.col("fill_pct"))), "chosen"))
