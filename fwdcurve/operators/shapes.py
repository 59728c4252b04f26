"""Shape factors: hourly, day-type and quarter-hour profiles per cell (season, day type), bands, water value.

All take a series key, so one plan serves every series; the only grouped functions are small solves."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar
from .aggregates import weighted_mean
from .windows import bfill, ffill, interpolated

CELL = ["series", "season", "day_type"]


def hourly_profile(rows: DataFrame, least: int = 96) -> DataFrame:
    """(*CELL, hour, f): weighted mean price of each hour over the mean of the 24, of cells with enough rows.

    rows: (*CELL, hour, price, w). Hours without a row lie on the line between their neighbours."""
    raw = rows.groupBy(*CELL, "hour").agg(weighted_mean(F.col("price"), F.col("w")).alias("m"), F.count(F.lit(1)).alias("n"))
    cells = raw.groupBy(*CELL).agg(F.sum("n").alias("rows")).where(F.col("rows") >= least).select(*CELL)
    full = cells.select(*CELL, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")).join(raw, [*CELL, "hour"], "left")
    filled = interpolated(full, "m", CELL, "hour", F.col("hour"), "x")
    ends = filled.withColumn("y", F.coalesce("x", ffill("m", CELL, "hour"), bfill("m", CELL, "hour")))
    return ends.select(*CELL, "hour", (F.col("y") / F.avg("y").over(Window.partitionBy(*CELL))).alias("f"))


def smoothed(profile: DataFrame, sigma: float = 1.0) -> DataFrame:
    """profile smoothed by a Gaussian over the circle of 24 hours, mean 1 again."""
    radius = int(4 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    kernel = F.array(*(F.struct(F.lit(d).alias("shift"), F.lit(float(w)).alias("k")) for d, w in zip(range(-radius, radius + 1), weights / weights.sum(), strict=True)))
    spread = profile.select(*CELL, "hour", "f", F.inline(kernel)).select(*CELL, F.pmod(F.col("hour") + F.col("shift"), F.lit(24)).alias("hour"), (F.col("f") * F.col("k")).alias("part"))
    sums = spread.groupBy(*CELL, "hour").agg(F.sum("part").alias("f"))
    return sums.select(*CELL, "hour", (F.col("f") / F.avg("f").over(Window.partitionBy(*CELL))).alias("f"))


SEASONS = ("Hiver", "Printemps", "Ete", "Automne")
DAY_TYPES = ("Ouvrable", "Samedi", "Dimanche", "Ferie_CH", "Ferie_DE")


def with_fallback(profile: DataFrame) -> DataFrame:
    """All 20 cells of each series: its own value, else the season's mean, the day type's, the overall, 1."""
    names = lambda values: F.explode(F.array(*map(F.lit, values)))
    cells = profile.select("series").distinct().withColumn("season", names(SEASONS)).withColumn("day_type", names(DAY_TYPES)).withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    rows = cells.join(profile, [*CELL, "hour"], "left")
    over = lambda *keys: F.avg("f").over(Window.partitionBy("series", "hour", *keys))
    return rows.select(*CELL, "hour", F.coalesce("f", over("season"), over("day_type"), over(), F.lit(1.0)).alias("f"))


# Least trend that counts, years after which a trend has levelled off, bounds of f_H, most of a quarter's correction.
LEAST_TREND, TREND_YEARS, FACTOR_BOUNDS, MOST_CORRECTION = 0.001, 2.0, (0.4, 2.0), 0.05


def profile_trends(hours: DataFrame, cell: list[str], least_years: int = 3) -> DataFrame:
    """(*cell, hour, slope, years): trend over years of each hour's place in the year's mean profile of its cell, of hours with
    enough years, for cells in which some hour's is above LEAST_TREND in size. hours: (*cell, d, hour, price)."""
    yearly = hours.groupBy(*cell, F.year("d").cast("double").alias("y"), "hour").agg(F.avg("price").alias("m"))
    yearly = yearly.withColumn("f", F.col("m") / F.avg("m").over(Window.partitionBy(*cell, "y")))
    slopes = yearly.groupBy(*cell, "hour").agg(F.regr_slope("f", "y").alias("slope"), F.count(F.lit(1)).alias("years")).where(F.col("years") >= least_years)
    return slopes.withColumn("most", F.max(F.abs("slope")).over(Window.partitionBy(*cell))).where(F.col("most") > LEAST_TREND).drop("most")


def clipped_factor(f: Column) -> Column:
    return F.greatest(F.lit(FACTOR_BOUNDS[0]), F.least(F.lit(FACTOR_BOUNDS[1]), f))


def trended_factor(f: Column, slope: Column, years: Column) -> Column:
    """f moved along its trend for so many years, which levels off after TREND_YEARS, and clipped."""
    return clipped_factor(f + slope * TREND_YEARS * F.tanh(F.greatest(years, F.lit(0.0)) / TREND_YEARS))


def day_factor(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """(*keys, day_type, f): weighted mean of the day type over that of all days; 1 with too few rows."""
    per = rows.groupBy(*keys, "day_type").agg(weighted_mean(F.col("price"), F.col("w")).alias("m"), F.count(F.lit(1)).alias("n"))
    every = rows.groupBy(*keys).agg(weighted_mean(F.col("price"), F.col("w")).alias("all"))
    return per.join(every, keys).select(*keys, "day_type", F.when(F.col("n") >= least, F.col("m") / F.col("all")).otherwise(F.lit(1.0)).alias("f"))


def quarter_ratios(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with ratio: price over the mean of its hour, where that isn't within 0.1 of 0."""
    mean = F.avg("price").over(Window.partitionBy("series", F.date_trunc("hour", "ts")))
    return rows.withColumn("ratio", F.when(F.abs(mean) > 0.1, F.col("price") / mean)).where("ratio IS NOT NULL")


def huber_location(x: np.ndarray, eps: float = 1.35, rounds: int = 15) -> float:
    """Robust location with a jointly estimated scale, by reweighting."""
    mu, sd = float(np.median(x)), float(np.std(x)) or 1.0
    for _ in range(rounds):
        r = np.abs(x - mu)
        w = np.minimum(1.0, eps * sd / np.maximum(r, 1e-12))
        mu = float((w * x).sum() / w.sum())
        inside = r <= eps * sd
        free = inside.sum() - eps**2 * (~inside).sum()
        if free > 0 and inside.any():
            sd = max(float(np.sqrt((r[inside] ** 2).sum() / free)), 1e-9)
    return mu


def huber_by(rows: DataFrame, keys: list[str], value: str, least: int = 8) -> DataFrame:
    """(*keys, location) of groups with enough rows; a group is one quarter of one hour of a cell."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1][keys].assign(location=huber_location(pdf[value].to_numpy()) if len(pdf) >= least else None)

    schema = rows.select(*keys, F.lit(None).cast("double").alias("location")).schema
    return rows.select(*keys, value).groupBy(*keys).applyInPandas(solve, schema)


# The day type whose cell stands in for a missing one.
STAND_IN = {"Ferie_DE": "Ferie_CH", "Ferie_CH": "Dimanche", "Dimanche": "Samedi", "Samedi": "Ouvrable"}


def quarter_fallback(cells: DataFrame, base: DataFrame) -> DataFrame:
    """cells (series, season, day_type, hour) with quarter and f: the cell's own factors of base, else those of the
    same season's next day type along STAND_IN, else of a working day in the first season that has one, else 1.

    What may stand in for a cell is at most 20 cells of its series and hour."""
    rank = lambda values, c: F.array_position(F.array(*map(F.lit, values)), c).cast("int")
    # days along the chain, from the last to the first that others stand in for
    order = ["Ferie_DE", *STAND_IN.values()]
    other = base.select("series", "hour", "quarter", "f", F.col("season").alias("of_season"), F.col("day_type").alias("of_day"))
    met = cells.join(other, ["series", "hour"])
    step = rank(order, F.col("of_day")) - rank(order, F.col("day_type"))
    same = F.col("of_season") == F.col("season")
    place = F.when(same & (step >= 0), step).when(F.col("of_day") == order[-1], 10 + rank(SEASONS, F.col("of_season")))
    best = met.withColumn("place", place).where("place IS NOT NULL").groupBy(*CELL, "hour", "quarter").agg(F.min_by("f", "place").alias("f"))
    grid = cells.withColumn("quarter", F.explode(F.sequence(F.lit(1), F.lit(4))))
    return grid.join(best, [*CELL, "hour", "quarter"], "left").fillna(1.0, ["f"])


def ridge(x: np.ndarray, y: np.ndarray, alphas=(0.01, 0.1, 1.0, 10.0, 100.0)) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of a ridge fit, alpha by leave-one-out error; the intercept isn't shrunk."""
    mx, my = x.mean(axis=0), y.mean()
    a, b = x - mx, y - my
    best = None
    for alpha in alphas:
        inv = np.linalg.inv(a.T @ a + alpha * np.eye(a.shape[1]))
        coef = inv @ (a.T @ b)
        lever = np.einsum("ij,jk,ik->i", a, inv, a) + 1 / len(y)
        loss = float((((b - a @ coef) / np.maximum(1 - lever, 1e-9)) ** 2).mean())
        if best is None or loss < best[0]:
            best = (loss, coef)
    return best[1], float(my - mx @ best[1])


def ridge_correction(rows: DataFrame, keys: list[str], features: list[str], target: str, least: int = 50, gain: float = 0.02, most: float | None = None) -> DataFrame:
    """(*keys, accepted, intercept, coefs): fitted on the first half in time, kept if it explains enough of the
    second half, then fitted on all rows; coefficients and intercept are at most `most` in size."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        x, y = pdf[features].to_numpy(float), pdf[target].to_numpy(float)
        ok, coef, b = False, np.zeros(len(features)), 0.0
        if len(y) >= least:
            half = len(y) // 2
            c, i = ridge(x[:half], y[:half])
            rest = y[half:] - y[half:].mean()
            ok = float(1 - ((y[half:] - x[half:] @ c - i) ** 2).sum() / max((rest**2).sum(), 1e-12)) > gain
            if ok:
                coef, b = ridge(x, y)
                if most is not None:
                    coef, b = np.clip(coef, -most, most), float(np.clip(b, -most, most))
        return pdf.iloc[:1][keys].assign(accepted=ok, intercept=b, coefs=[coef.tolist()])

    schema = rows.select(*keys, *(F.lit(None).cast(kind).alias(c) for c, kind in (("accepted", "boolean"), ("intercept", "double"), ("coefs", "array<double>")))).schema
    return rows.groupBy(*keys).applyInPandas(solve, schema)


def bootstrap_bands(rows: DataFrame, keys: list[str], value: str, replicates: int = 20) -> DataFrame:
    """(*keys, p10, p50, p90): mean over Poisson bootstrap replicates of weighted quantiles.

    Each row's weight in a replicate is drawn from its hash, so reruns agree and nothing is gathered."""
    draw = F.pmod(F.xxhash64("row_id", "replicate"), F.lit(1 << 30)) / float(1 << 30)
    weight = F.when(draw < 0.3679, 0).when(draw < 0.7358, 1).when(draw < 0.9197, 2).when(draw < 0.9810, 3).otherwise(4)
    many = rows.select(*keys, value, "row_id", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")).withColumn("weight", weight).where("weight > 0")
    per = many.groupBy(*keys, "replicate").agg(F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)), F.col("weight")).alias("q"))
    return per.groupBy(*keys).agg(*(F.avg(F.col("q")[k]).alias(n) for k, n in enumerate(("p10", "p50", "p90"))))


def banded(price: Column, p10: Column, p50: Column, p90: Column, widen: Column) -> tuple[Column, Column]:
    """Lower and upper band: the cell's quantiles around its median, widened by horizon."""
    mid = F.greatest(p50, F.lit(0.01))
    return price - F.abs(price - price * p10 / mid) * widen, price + F.abs(price * p90 / mid - price) * widen


# Fixed values of the water value.
SENSITIVITY = {"Hiver": -0.8, "Printemps": -0.3, "Ete": -0.1, "Automne": -0.5}
FLOOR, CAP, BETA = 0.80, 1.20, -0.03


def water_value(deviation: Column, season: Column, over: Window, beta: float = BETA, full_is_lower: bool = True) -> Column:
    """Factor of the reservoir's deviation: clamped, mean 1 over the horizon, clamped again.

    full_is_lower: fuller reservoirs lower the price; False multiplies beta and sensitivity as they are."""
    of = F.coalesce(F.try_element_at(F.create_map(*(F.lit(v) for kv in SENSITIVITY.items() for v in kv)), season), F.lit(-0.3))
    clamp = lambda c: F.greatest(F.lit(FLOOR), F.least(F.lit(CAP), c))
    raw = clamp(1.0 + (-1 if full_is_lower else 1) * beta * F.coalesce(deviation, F.lit(0.0)) * of)
    return clamp(raw / F.avg(raw).over(over))


# Seasons of the water value in order, bounds of its beta, least months of a fit.
WATER_SEASONS = ("hiver", "printemps", "ete", "automne")
BETA_BOUNDS, SENSITIVITY_BOUNDS, LEAST_MONTHS = (-0.10, -0.001), (-2.0, 0.0), 12


def water_design(months: DataFrame) -> DataFrame:
    """months (market, month, p, dev) with trend (0 to 1 over a market's months) and dev in the column of its season."""
    w = Window.partitionBy("market")
    first, last = F.min("month").over(w), F.max("month").over(w)
    season = calendar.season(F.month("month"))
    trend = F.coalesce(F.try_divide(F.datediff("month", first).cast("double"), F.datediff(last, first).cast("double")), F.lit(0.0))
    sides = {c: F.when(season == name, F.col("dev")).otherwise(F.lit(0.0)) for c, name in zip(WATER_SEASONS, SENSITIVITY, strict=True)}
    return months.withColumns({"trend": trend, "months": F.count(F.lit(1)).over(w), **sides})


def water_fit(design: DataFrame) -> DataFrame:
    """(market, months, beta, one sensitivity for each season): least squares of the monthly price on trend and
    seasonal deviations, relative to the mean price; defaults below LEAST_MONTHS. A group is a market's months."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        beta, of = BETA, list(SENSITIVITY.values())
        if len(pdf) >= LEAST_MONTHS:
            sides = pdf[list(WATER_SEASONS)].to_numpy(float)
            y = pdf["p"].to_numpy(float)
            x = np.column_stack([np.ones(len(pdf)), pdf["trend"].to_numpy(float), sides])
            raw = np.linalg.lstsq(x, y, rcond=None)[0][2:] / (y.mean() or 1.0)
            n = np.array([(calendar_season(pdf["month"]) == s).sum() for s in SENSITIVITY])
            beta = float(np.clip((raw * n).sum() / n.sum(), *BETA_BOUNDS))
            if abs(beta) > 1e-6:
                of = np.clip(raw / abs(beta), *SENSITIVITY_BOUNDS).tolist()
        return pd.DataFrame([[pdf["market"].iloc[0], len(pdf), beta, *of]], columns=["market", "months", "beta", *WATER_SEASONS])

    return design.groupBy("market").applyInPandas(solve, f"market string, months long, beta double, {', '.join(f'{c} double' for c in WATER_SEASONS)}")


def calendar_season(months: pd.Series) -> np.ndarray:
    """Season of each first of a month, as calendar.season has it."""
    names = {m: s for s, ms in calendar.SEASON.items() for m in ms}
    return np.array([names[m.month] for m in months])
