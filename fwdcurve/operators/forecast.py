"""Short-term forecasting: lagged features, regularised fits per (hour, window), conformal bands, backtest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LAGS = (1, 2, 3, 7)


def features(days: DataFrame, key: str = "market") -> DataFrame:
    """days (key, d, price) with lags, momentum, 7-day deviation and weekday: one table for all series."""
    w = Window.partitionBy(key).orderBy("d")
    rows = days.withColumns({f"lag{k}": F.lag("price", k).over(w) for k in LAGS})
    week = w.rowsBetween(-7, -1)
    return rows.withColumns({"momentum": F.col("lag1") - F.col("lag7"), "vol7": F.when(F.count("price").over(week) >= 3, F.stddev_samp("price").over(week)), "weekday": F.weekday("d").cast("double")})


def elastic_net(x: np.ndarray, y: np.ndarray, lam: float, l1: float = 0.1, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Coordinate descent for 1/2n |y - xb|^2 + lam (l1 |b|_1 + (1 - l1)/2 |b|^2) on scaled columns."""
    mx, sx, my = x.mean(axis=0), x.std(axis=0), y.mean()
    a = (x - mx) / np.where(sx > 1e-12, sx, 1.0)
    n, p = a.shape
    b, r = np.zeros(p), y - my
    norms = (a * a).mean(axis=0) + lam * (1 - l1)
    for _ in range(rounds):
        before = b.copy()
        for j in range(p):
            rho = float(a[:, j] @ r) / n + (a[:, j] @ a[:, j] / n) * b[j]
            new = np.sign(rho) * max(abs(rho) - lam * l1, 0.0) / max(norms[j], 1e-12)
            if new != b[j]:
                r -= a[:, j] * (new - b[j])
                b[j] = new
        if np.abs(b - before).max() < 1e-7:
            break
    coef = b / np.where(sx > 1e-12, sx, 1.0)
    return coef, float(my - mx @ coef)


def best_penalty(x: np.ndarray, y: np.ndarray, penalties=(1e-3, 1e-2, 1e-1, 1.0), folds: int = 5) -> float:
    """Penalty of least squared error over contiguous folds in time order."""
    parts = np.array_split(np.arange(len(y)), folds)
    loss = []
    for lam in penalties:
        total = 0.0
        for part in parts:
            rest = np.setdiff1d(np.arange(len(y)), part)
            c, i = elastic_net(x[rest], y[rest], lam, rounds=20)
            total += float(((y[part] - x[part] @ c - i) ** 2).sum())
        loss.append(total)
    return penalties[int(np.argmin(loss))]


def month_starts(days: DataFrame, keys: list[str], earliest: Column, name: str) -> DataFrame:
    """(*keys, name): the firsts of months from `earliest`, an expression of first (day), to the last day of each key."""
    ends = days.groupBy(*keys).agg(F.min("d").alias("first"), F.max("d").alias("last"))
    start = F.to_date(F.date_trunc("month", F.date_add(F.last_day(F.date_sub(earliest, 1)), 1)))
    return ends.withColumn("start", start).where("start <= last").select(*keys, F.explode(F.sequence("start", "last", F.expr("INTERVAL 1 MONTH"))).alias(name))


def before(rows: DataFrame, starts: DataFrame, keys: list[str], name: str, since: Column) -> DataFrame:
    """rows once for each start (*keys, name) after them, from day `since` on. A start is exploded into its days, so
    the join is an equi-join."""
    days = starts.withColumn("d", F.explode(F.sequence(since, F.date_sub(name, 1))))
    return rows.join(days, [*keys, "d"])


def within(rows: DataFrame, starts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """rows of the months that begin at a start."""
    return rows.withColumn(name, F.to_date(F.date_trunc("month", "d"))).join(starts, [*keys, name])


def fits(rows: DataFrame, keys: list[str], columns: list[str], windows: tuple[int, ...]) -> DataFrame:
    """(*keys, window, intercept, coefs, mu, sd): a fit on the last `window` rows of each key; the target is
    asinh of the standardised price. One group is one series' history; groups and windows run in parallel."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        window = int(pdf["window"].iloc[0])
        pdf = pdf.sort_values("d").tail(window)
        y, x = pdf["price"].to_numpy(float), pdf[columns].to_numpy(float)
        mu, sd = float(y.mean()), max(float(y.std()), 1e-6)
        z = np.arcsinh((y - mu) / sd)
        c, i = elastic_net(x, z, best_penalty(x, z)) if len(y) >= 10 else (np.zeros(len(columns)), float(z.mean()))
        return pdf.iloc[:1][keys].assign(window=window, intercept=i, coefs=[c.tolist()], mu=mu, sd=sd)

    many = rows.dropna(subset=columns).withColumn("window", F.explode(F.array(*map(F.lit, windows))))
    null = lambda kind, c: F.lit(None).cast(kind).alias(c)
    schema = rows.select(*keys, null("int", "window"), null("double", "intercept"), null("array<double>", "coefs"), null("double", "mu"), null("double", "sd")).schema
    return many.groupBy(*keys, "window").applyInPandas(solve, schema)


def applied(rows: DataFrame, models: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """rows with forecast: the mean over the windows' models, back on the price scale."""
    x = F.array(*(F.col(c) for c in columns))
    z = F.col("intercept") + F.aggregate(F.zip_with(x, "coefs", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    each = rows.dropna(subset=columns).join(models, keys).withColumn("one", F.sinh(z) * F.col("sd") + F.col("mu"))
    return each.groupBy(*keys, "d").agg(F.first("price").alias("price"), F.avg("one").alias("forecast"))


PEAK_HOURS = (8, 19)


def hour_features(hours: DataFrame, neighbours: DataFrame, daily: DataFrame, fresh: list[str], delayed: dict[str, int], least_hours: int = 23, ahead: int = 0) -> DataFrame:
    """Feature rows (market, d, hour, price, ...) of every delivery hour, for all hours in one plan.

    hours: (market, d, hour, price); neighbours: the same with the prices of the market beside each; daily:
    (d, ...) with exogenous columns: those of `fresh` are taken of the day itself, the day before and seven days
    before, those of `delayed` so many days before. Lags count the days that have `least_hours` hours at least.

    ahead: so many days after each hour's last one have rows too, with a null price. A lag of such a day that reaches a known
    day has that day's value, one that doesn't has the last known value; the day's own fresh columns are the mean of the last 28
    days; the deviation of the week before is that of its known days, if there are three, else the last one.

    Windows are keyed by (market, hour) or (market, day), so hours run in parallel."""
    day = Window.partitionBy("market", "d")
    peak = F.col("hour").between(*PEAK_HOURS)
    stats = F.struct(F.avg("price").over(day).alias("mean"), F.avg(F.when(peak, F.col("price"))).over(day).alias("peak"), F.avg(F.when(~peak, F.col("price"))).over(day).alias("offpeak"), F.max("price").over(day).alias("max"))
    rows = hours.withColumn("n", F.count("price").over(day)).withColumn("day", stats).where(F.col("n") >= least_hours)
    beside = neighbours.select("market", "d", "hour", F.col("price").alias("beside"), F.avg("price").over(day).alias("beside_mean"))
    rows = rows.join(beside, ["market", "d", "hour"], "left").join(daily, "d", "left").withColumn("known", F.col("price"))
    if ahead:
        rows = _with_future(rows, fresh, ahead)
    w = Window.partitionBy("market", "hour").orderBy("d")
    back = lambda c, k: F.lag(c, k).over(w)
    columns = {}
    for k in LAGS:
        columns[f"price_d{k}"] = back("price", k)
        columns |= {f"{c}_d{k}": back(f"day.{c}", k) for c in ("mean", "peak", "offpeak", "max")}
    week = w.rowsBetween(-7, -1)
    columns["momentum"] = back("price", 1) - back("price", 2)
    columns["vol7"] = F.when(F.count("known").over(week) >= 3, F.stddev_samp("known").over(week))
    for k in (1, 2, 7):
        columns |= {f"beside_d{k}": back("beside", k), f"beside_mean_d{k}": back("beside_mean", k)}
    columns["spread_d1"] = back("price", 1) - back("beside", 1)
    for c in fresh:
        columns |= {f"{c}_d0": F.col(c), f"{c}_d1": back(c, 1), f"{c}_d7": back(c, 7)}
    columns |= {f"{c}_d{k}": back(c, k) if k else F.col(c) for c, k in delayed.items()}
    columns |= {f"dow_{k}": (F.weekday("d") == k).cast("double") for k in range(6)}
    angle = F.month("d") * F.lit(np.pi / 6)
    columns |= {"weekend": (F.weekday("d") >= 5).cast("double"), "month_sin": F.sin(angle), "month_cos": F.cos(angle)}
    rows = rows.select("market", "d", "hour", F.col("known").alias("price"), *(c.alias(n) for n, c in columns.items()))
    return rows.withColumn("vol7", F.when(F.col("price").isNull(), F.coalesce("vol7", F.last("vol7", True).over(w.rowsBetween(-ahead, 0)))).otherwise(F.col("vol7"))) if ahead else rows


def _with_future(rows: DataFrame, fresh: list[str], ahead: int) -> DataFrame:
    """rows (market, hour, d, price, known, day, …) with the next days of each hour: columns carried on from its last row, known
    null, fresh columns the mean of their last 28 values."""
    newest = F.row_number().over(Window.partitionBy("market", "hour").orderBy(F.desc("d")))
    recent = rows.withColumn("newest", newest).where("newest <= 28")
    carried = [c for c in rows.columns if c not in ("market", "hour", "d", "known", *fresh)]
    last = recent.groupBy("market", "hour").agg(F.max("d").alias("d"), *(F.max_by(c, "d").alias(c) for c in carried), *(F.avg(c).alias(c) for c in fresh))
    days = last.withColumn("d", F.explode(F.sequence(F.date_add("d", 1), F.date_add("d", ahead)))).withColumn("known", F.lit(None).cast("double"))
    return rows.unionByName(days.select(rows.columns))


def feature_names(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ("market", "d", "hour", "price")]


def expanding_profiles(hours: DataFrame, least_days: int = 30, recent_days: int = 30) -> DataFrame:
    """(market, fold, d, hour, price, pred, naive) of every hour of months with enough days before them: pred is the mean of the
    recent days times the cell's profile over all days before the month, a cell being an hour of a weekday or weekend.

    A profile is a ratio of sums, and a fold's sums are those of the months before it, so one running sum over a table of months
    serves all folds; nothing is fitted twice. naive is the same weekday and hour of the week before the month."""
    fold = F.to_date(F.date_trunc("month", "d"))
    rows = hours.select("market", "d", "hour", "price", fold.alias("fold"), (F.weekday("d") >= 5).alias("weekend"))
    sums = rows.groupBy("market", "fold", "weekend", "hour").agg(F.sum("price").alias("s"), F.count(F.lit(1)).alias("n"))
    every = sums.groupBy("market", "fold").agg(F.sum("s").alias("s_all"), F.sum("n").alias("n_all"))
    cells = F.explode(F.array(F.lit(False), F.lit(True))), F.explode(F.sequence(F.lit(0), F.lit(23)))
    grid = every.withColumn("weekend", cells[0]).withColumn("hour", cells[1]).join(sums, ["market", "fold", "weekend", "hour"], "left")
    before = Window.partitionBy("market", "weekend", "hour").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.select("market", "fold", "weekend", "hour", *(F.sum(c).over(before).alias(c) for c in ("s", "n", "s_all", "n_all"))).where(F.col("n_all") >= 24 * least_days)
    # a day is exploded into the month starts that look back on it
    ahead = lambda days: F.explode(F.sequence(F.add_months(F.trunc("d", "month"), 1), F.trunc(F.date_add("d", days), "month"), F.expr("INTERVAL 1 MONTH")))
    seen = lambda days: rows.where(F.trunc(F.date_add("d", days), "month") > F.col("d")).withColumn("fold", ahead(days)).where(F.col("d") >= F.date_sub("fold", days))
    base = seen(recent_days).groupBy("market", "fold").agg(F.avg("price").alias("base"))
    week = seen(7).groupBy("market", "fold", F.weekday("d").alias("w"), "hour").agg(F.avg("price").alias("naive"))
    found = rows.join(grid, ["market", "fold", "weekend", "hour"]).join(base, ["market", "fold"]).withColumn("w", F.weekday("d")).join(week, ["market", "fold", "w", "hour"], "left")
    level = F.col("s_all") / F.col("n_all")
    profile = F.coalesce((F.col("s") / F.col("n")) / level, F.lit(1.0))
    return found.select("market", "fold", "d", "hour", "price", (F.col("base") * profile).alias("pred"), F.coalesce("naive", level).alias("naive"))


def elastic_nets(gram: np.ndarray, cross: np.ndarray, lam: np.ndarray, l1: float = 0.1, rounds: int = 60) -> np.ndarray:
    """The coefficients of many elastic nets at once, one for each row of gram (x'x / n), cross (x'y / n) and lam, by
    coordinate descent."""
    b, n = np.zeros_like(cross), gram.shape[1]
    norms = np.maximum(np.einsum("bjj->bj", gram) + (lam * (1 - l1))[:, None], 1e-12)
    for _ in range(rounds):
        before = b.copy()
        for j in range(n):
            rho = cross[:, j] - np.einsum("bk,bk->b", gram[:, j], b) + gram[:, j, j] * b[:, j]
            b[:, j] = np.sign(rho) * np.maximum(np.abs(rho) - lam * l1, 0.0) / norms[:, j]
        if np.abs(b - before).max(initial=0) < 1e-7:
            break
    return b


def _moments(x: np.ndarray, y: np.ndarray) -> tuple:
    return len(y), x.sum(axis=0), y.sum(), x.T @ x, x.T @ y


def _centred(n: int, sx: np.ndarray, sy: float, sxx: np.ndarray, sxy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    mx, my = sx / n, sy / n
    return sxx / n - np.outer(mx, mx), sxy / n - mx * my, mx, my


def window_fits(samples: list[tuple[np.ndarray, np.ndarray]], penalties=(1e-3, 1e-2, 1e-1, 1.0), folds: int = 5) -> list[tuple[np.ndarray, float, float, float]]:
    """(coefs, intercept, mu, sd) of each sample (features, prices): an elastic net of asinh of the standardised price on
    scaled features; the penalty of least squared error over contiguous folds in time order. All folds, penalties
    and samples are solved together, from their moments."""
    problems, prepared = [], []
    for x, y in samples:
        mu, sd = float(y.mean()), max(float(y.std()), 1e-6)
        z, mx, sx = np.arcsinh((y - mu) / sd), x.mean(axis=0), x.std(axis=0)
        sx = np.where(sx > 1e-12, sx, 1.0)
        a = (x - mx) / sx
        parts = np.array_split(np.arange(len(y)), folds)
        every, some = _moments(a, z), [_moments(a[p], z[p]) for p in parts]
        rest = [_centred(*(e - f for e, f in zip(every, part, strict=True))) for part in some]
        problems += [(g, c, lam) for g, c, _, _ in rest for lam in penalties]
        prepared.append((a, z, mx, sx, mu, sd, parts, rest, _centred(*every)))
    if not prepared:
        return []
    tried = elastic_nets(*(np.array(v) for v in zip(*problems, strict=True)), rounds=20).reshape(len(prepared), folds, len(penalties), -1)
    chosen = []
    for (a, z, *_, parts, rest, _), nets in zip(prepared, tried, strict=True):
        loss = sum(((z[p][:, None] - m[3] - (a[p] - m[2]) @ b.T) ** 2).sum(axis=0) for p, m, b in zip(parts, rest, nets, strict=True))
        chosen.append(penalties[int(np.argmin(loss))])
    final = elastic_nets(np.array([p[-1][0] for p in prepared]), np.array([p[-1][1] for p in prepared]), np.array(chosen))
    out = []
    for (_, _, mx, sx, mu, sd, _, _, (_, _, centre, level)), b in zip(prepared, final, strict=True):
        coef = b / sx
        out.append((coef, float(level - centre @ b - mx @ coef), mu, sd))
    return out


def hourly_fits(rows: DataFrame, windows: tuple[int, ...], columns: list[str], least: int = 30, latest: bool = False) -> DataFrame:
    """(market, hour, cutoff, window, intercept, coefs, mu, sd): for each market and hour a fit on the last `window` rows
    before every cutoff, the first of each month after the largest window and the day after the last row, or for the latter alone.

    A group is one market's days at one hour; cutoffs are solved in batches inside, so rows aren't repeated for them."""
    names = ["market", "hour", "cutoff", "window", "intercept", "coefs", "mu", "sd"]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("d").reset_index(drop=True)
        d = pd.to_datetime(pdf["d"])
        x, y = pdf[columns].to_numpy(float), pdf["price"].to_numpy(float)
        starts = pd.DatetimeIndex([d.iloc[-1] + pd.Timedelta(days=1)])
        if not latest:
            starts = pd.date_range(d.iloc[0] + pd.Timedelta(days=max(windows)), d.iloc[-1], freq="MS").append(starts)
        out = []
        for at in range(0, len(starts), 12):
            asked, samples = [], []
            for cutoff in starts[at : at + 12]:
                end = int(np.searchsorted(d.to_numpy(), cutoff.to_datetime64()))
                for window in windows if end >= least else ():
                    asked.append((cutoff.date(), window))
                    samples.append((x[max(0, end - window) : end], y[max(0, end - window) : end]))
            fits_ = window_fits(samples)
            out += [(pdf["market"].iloc[0], pdf["hour"].iloc[0], *a, i, c.tolist(), mu, sd) for a, (c, i, mu, sd) in zip(asked, fits_, strict=True)]
        return pd.DataFrame(out, columns=names)

    return rows.dropna(subset=[*columns, "price"]).groupBy("market", "hour").applyInPandas(solve, "market string, hour int, cutoff date, window int, intercept double, coefs array<double>, mu double, sd double")


def hourly_forecasts(rows: DataFrame, models: DataFrame, columns: list[str]) -> DataFrame:
    """rows (market, hour, cutoff, ...) with forecast: the mean over the windows' models of their cutoff. The models of a
    cutoff become one row, so rows are met once."""
    sets = models.groupBy("market", "hour", "cutoff").agg(F.collect_list(F.struct("intercept", "coefs", "mu", "sd")).alias("models"))
    x = F.array(*(F.col(c) for c in columns))
    one = lambda m: F.sinh(m["intercept"] + F.aggregate(F.zip_with(x, m["coefs"], lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)) * m["sd"] + m["mu"]
    mean = F.aggregate(F.transform("models", one), F.lit(0.0), lambda s, v: s + v) / F.size("models")
    return rows.dropna(subset=columns).join(sets, ["market", "hour", "cutoff"]).withColumn("forecast", mean).drop("models")


def recalibrated(forecast: Column, mean_f: Column, sd_f: Column, mean_a: Column, sd_a: Column, most: float = 2.0) -> Column:
    """Forecast rescaled to the actual spread (ratio at most `most`), moved at most one deviation."""
    ratio = F.least(F.coalesce(F.try_divide(sd_a, sd_f), F.lit(1.0)), F.lit(most))
    moved = mean_a + (forecast - mean_f) * ratio
    return F.greatest(forecast - sd_a, F.least(forecast + sd_a, moved))


def conformal_half(width: Column, n: Column, forecast: Column, ahead: Column, least: int = 20) -> Column:
    """Half width of the band `ahead` days on: the residuals' quantile `width` of `n` residuals, 5 percent wider for each
    further day; with fewer than `least` residuals a spread that grows with the forecast and the days."""
    return F.when(n >= least, width * (1.0 + 0.05 * (ahead - 1))).otherwise(1.28 * F.abs(forecast) * (0.05 + 0.01 * ahead))
