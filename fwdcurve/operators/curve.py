"""Curve assembly and calibration.

Slots are (curve_id, ts, …). Contracts are (curve_id, contract_id, start, end, load, price)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timegrid as tg


def hermite(t: Column, h: Column, y0: Column, y1: Column, m0: Column, m1: Column) -> Column:
    """Cubic between two knots at distance h, t within 0 and 1."""
    return (2 * t * t * t - 3 * t * t + 1) * y0 + (t * t * t - 2 * t * t + t) * h * m0 + (3 * t * t - 2 * t * t * t) * y1 + (t * t * t - t * t) * h * m1


def monotone_slopes(knots: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """knots with slope: harmonic mean of the secants where they agree in sign, else 0; at the ends a
    three-point slope that keeps the sign and is at most three times the secant (Fritsch and Carlson)."""
    w = Window.partitionBy(key).orderBy(x)
    step = lambda k, c: F.lead(c, k).over(w) - F.lead(c, k - 1).over(w) if k > 0 else F.lag(c, -k).over(w) - F.lag(c, -k - 1).over(w)
    rows = knots.withColumns({
        "h1": F.lead(x).over(w) - F.col(x), "d1": F.try_divide(F.lead(y).over(w) - F.col(y), F.lead(x).over(w) - F.col(x)),
        "h0": F.col(x) - F.lag(x).over(w), "d0": F.try_divide(F.col(y) - F.lag(y).over(w), F.col(x) - F.lag(x).over(w)),
        "h2": step(2, x), "d2": F.try_divide(step(2, y), step(2, x)), "hm": -step(-2, x), "dm": F.try_divide(step(-2, y), step(-2, x)),
    })
    w1, w2 = 2 * F.col("h1") + F.col("h0"), F.col("h1") + 2 * F.col("h0")
    inner = F.when(F.col("d0") * F.col("d1") <= 0, F.lit(0.0)).otherwise(F.try_divide(w1 + w2, F.try_divide(w1, F.col("d0")) + F.try_divide(w2, F.col("d1"))))

    def edge(ha: str, hb: str, da: str, db: str) -> Column:
        a, b, d, e = (F.col(c) for c in (ha, hb, da, db))
        raw = F.try_divide((2 * a + b) * d - a * e, a + b)
        kept = F.when(F.signum(raw) != F.signum(d), F.lit(0.0)).when((F.signum(d) != F.signum(e)) & (F.abs(raw) > 3 * F.abs(d)), 3 * d).otherwise(raw)
        return F.when(b.isNull(), d).otherwise(kept)

    slope = F.when(F.col("d0").isNull() & F.col("d1").isNull(), F.lit(0.0)).when(F.col("d0").isNull(), edge("h1", "h2", "d1", "d2")).when(F.col("d1").isNull(), edge("h0", "hm", "d0", "dm")).otherwise(inner)
    return rows.withColumn("slope", slope).drop("h1", "d1", "h0", "d0", "h2", "d2", "hm", "dm")


def _pieces(monthly: DataFrame) -> DataFrame:
    """(key, x, x1, base, slope, base1, slope1): the cubics between the knots at the middles of months (key, month_start, base)."""
    knots = monthly.withColumn("x", F.datediff("month_start", F.lit("1970-01-01")) + F.dayofmonth(F.last_day("month_start")) / 2.0)
    knots = monotone_slopes(knots, "key", "x", "base")
    w = Window.partitionBy("key").orderBy("x")
    return knots.select("key", "x", F.lead("x").over(w).alias("x1"), "base", "slope", F.lead("base").over(w).alias("base1"), F.lead("slope").over(w).alias("slope1")).where("x1 IS NOT NULL")


def _days_of(pieces: DataFrame) -> DataFrame:
    """pieces with day_no: the days from a knot to the next, for the first and the last piece 40 more outside."""
    ends = pieces.groupBy("key").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    first = F.when(F.col("x") == F.col("lo"), F.ceil("x") - 40).otherwise(F.ceil("x"))
    last = F.when(F.col("x") == F.col("hi"), F.ceil("x1") + 40).otherwise(F.ceil("x1") - 1)
    return pieces.join(ends, "key").select(*pieces.columns, F.explode(F.sequence(first, last)).alias("day_no"))


def _numbered(days: DataFrame) -> DataFrame:
    return days.withColumn("day_no", F.datediff("d", F.lit("1970-01-01")).cast("long"))


def smooth_base(days: DataFrame, monthly: DataFrame) -> DataFrame:
    """days (key, d) with smooth: the monotone cubic through the months' means (key, month_start, base) at their middles."""
    spread, h = _days_of(_pieces(monthly)), F.col("x1") - F.col("x")
    value = hermite((F.col("day_no") - F.col("x")) / h, h, F.col("base"), F.col("base1"), F.col("slope"), F.col("slope1"))
    return _numbered(days).join(spread.select("key", "day_no", value.alias("smooth")), ["key", "day_no"], "left").drop("day_no")


def smooth_slots(slots: DataFrame, monthly: DataFrame, key: str, at: str) -> DataFrame:
    """slots (key, at, …) with smooth: the monotone cubic through the months' levels (key, month_start, base) at the time `at`.

    Knots lie at days or half days, so a slot meets its cubic by an equi-join on the half day; before the first and after the
    last knot, for 40 days, the nearest cubic is carried on."""
    pieces = _pieces(monthly)
    ends = pieces.groupBy("key").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    half = lambda x: (2 * x).cast("long")
    first = half(F.col("x")) - F.when(F.col("x") == F.col("lo"), 80).otherwise(0)
    last = half(F.col("x1")) - 1 + F.when(F.col("x") == F.col("hi"), 80).otherwise(0)
    spread = pieces.join(ends, "key").select(F.col("key").alias(key), *pieces.columns[1:], F.explode(F.sequence(first, last)).alias("half_day"))
    day, h = F.datediff(at, F.lit("1970-01-01")) + (F.hour(at) * 60 + F.minute(at)) / 1440.0, F.col("x1") - F.col("x")
    rows = slots.withColumn("_at", day).withColumn("half_day", F.floor(2 * F.col("_at")).cast("long")).join(spread.withColumnsRenamed({"base": "_y0", "base1": "_y1", "slope": "_m0", "slope1": "_m1"}), [key, "half_day"], "left")
    value = hermite((F.col("_at") - F.col("x")) / h, h, *(F.col(c) for c in ("_y0", "_y1", "_m0", "_m1")))
    return rows.withColumn("smooth", value).drop("_at", "half_day", "x", "x1", "_y0", "_y1", "_m0", "_m1")


def month_basis(days: DataFrame, monthly: DataFrame) -> DataFrame:
    """(key, month_start, x, y0, y1, m0, m1, n): sums over a month's days in a piece of what each of the piece's values
    and slopes is multiplied with. A month's mean is linear in them, whatever the knots are."""
    one, zero, h = F.lit(1.0), F.lit(0.0), F.col("x1") - F.col("x")
    t = (F.col("day_no") - F.col("x")) / h
    parts = {n: hermite(t, h, *(one if k == j else zero for j in range(4))) for k, n in enumerate(("y0", "y1", "m0", "m1"))}
    rows = _numbered(days).join(_days_of(_pieces(monthly)), ["key", "day_no"]).withColumn("month_start", F.to_date(F.date_trunc("month", "d")))
    return rows.groupBy("key", "month_start", "x").agg(*(F.sum(v).alias(n) for n, v in parts.items()), F.count(F.lit(1)).alias("n"))


def restored_months(days: DataFrame, monthly: DataFrame, settle: Callable[[DataFrame, int], DataFrame], damping: float = 0.8, rounds: int = 10, tolerance: float = 0.5) -> DataFrame:
    """smooth_base whose knots are moved until each month's mean is within tolerance of its base.

    Days are read once, for the month_basis; a round works on the knots, a row a month. settle(table, round)
    writes a round's table, so plans stay short."""
    basis = settle(month_basis(days, monthly), -1)
    knots = settle(monthly.withColumn("target", F.col("base")), 0)
    for k in range(1, rounds + 1):
        terms = F.col("y0") * F.col("base") + F.col("y1") * F.col("base1") + F.col("m0") * F.col("slope") + F.col("m1") * F.col("slope1")
        met = basis.join(_pieces(knots.drop("target")), ["key", "x"])
        means = met.groupBy("key", "month_start").agg((F.sum(terms) / F.sum("n")).alias("mean"))
        gap = F.coalesce(F.col("target") - F.col("mean"), F.lit(0.0))
        moved = settle(knots.join(means, ["key", "month_start"], "left").select("key", "month_start", (F.col("base") + damping * gap).alias("base"), "target", gap.alias("gap")), k)
        worst = moved.agg(F.max(F.abs("gap"))).first()[0]
        if worst is None or worst < tolerance:
            break
        knots = moved.drop("gap")
    return smooth_base(days, knots.drop("target"))


def rescaled(slots: DataFrame, group: list[str], price: str, target: str) -> Column:
    """price times target over the group's mean: the group's mean becomes the target, exactly."""
    mean = F.avg(price).over(Window.partitionBy(*group))
    return F.when(F.col(target).isNotNull() & (F.abs(mean) > 1e-9), F.col(price) * F.col(target) / mean).otherwise(F.col(price))


class BandSolver:
    """Cholesky factor of the calibration's bending matrix: for two regimes of k daily knots, in the order day, regime,
    squared second differences plus eps + tie on the diagonal, and -tie between the regimes. Four entries beside the
    diagonal differ from 0, so work is linear in the days."""

    WIDTH = 4

    def __init__(self, k: int, eps: float, tie: float):
        n, width = 2 * k, self.WIDTH
        band = [[0.0] * (width + 1) for _ in range(n)]
        for i in range(n):
            band[i][0] = eps + tie
            if i % 2:
                band[i][1] = -tie
        for i in range(k - 2):
            for a, u in enumerate((1.0, -2.0, 1.0)):
                for b, v in enumerate((1.0, -2.0, 1.0)[: a + 1]):
                    for r in range(2):
                        band[2 * (i + a) + r][2 * (a - b)] += u * v
        for i in range(n):
            row = band[i]
            for j in range(min(width, i), -1, -1):
                other = band[i - j]
                rest = row[j] - sum(row[q] * other[q - j] for q in range(j + 1, min(width, i) + 1) if q - j <= width)
                row[j] = rest / other[0] if j else rest**0.5
        self.band, self.n = band, n

    def solve(self, rhs: np.ndarray) -> np.ndarray:
        """Solutions for the columns of rhs."""
        x = rhs.astype(float).copy()
        for i, row in enumerate(self.band):
            for j in range(1, min(self.WIDTH, i) + 1):
                if row[j]:
                    x[i] -= row[j] * x[i - j]
            x[i] /= row[0]
        for i in range(self.n - 1, -1, -1):
            x[i] /= self.band[i][0]
            for j in range(1, min(self.WIDTH, i) + 1):
                if self.band[i][j]:
                    x[i - j] -= self.band[i][j] * x[i]
        return x


def solve_knots(stats: pd.DataFrame, targets: pd.DataFrame, eps: float = 1e-8, tie: float = 1e-6) -> pd.DataFrame:
    """Corrections at daily knots of two regimes (peak, off-peak), least in squared second differences, that
    bring each contract's mean to its target.

    stats: contract_id, day, is_peak, n, w1 (sum over slots of the elapsed part of the day); targets:
    contract_id, gap. A slot's correction lies between its day's knot and the next day's. Contracts that others
    imply change nothing; of contracts that contradict each other the gaps are met in least squares. The bending matrix
    is banded; what is solved densely has a row for each contract."""
    days = np.arange(stats["day"].min(), stats["day"].max() + 2)
    k, ids = len(days), targets["contract_id"].tolist()
    row = stats["contract_id"].map({c: i for i, c in enumerate(ids)}).to_numpy()
    at = 2 * (stats["day"].to_numpy() - days[0]) + (~stats["is_peak"].to_numpy(bool)).astype(int)
    a = np.zeros((len(ids), 2 * k))
    np.add.at(a, (row, at), (stats["n"] - stats["w1"]).to_numpy(float))
    np.add.at(a, (row, at + 2), stats["w1"].to_numpy(float))
    a /= np.maximum(a.sum(axis=1, keepdims=True), 1e-12)
    gap = targets["gap"].to_numpy(float)
    # independent combinations of the contracts
    size, u = np.linalg.eigh(a @ a.T)
    keep = size > 1e-12 * size.max(initial=0)
    u = u[:, keep] / np.sqrt(size[keep])
    a, gap = u.T @ a, u.T @ gap
    spread = BandSolver(k, eps, tie).solve(a.T)
    reduced = a @ spread
    x, left = np.zeros(2 * k), gap.copy()
    for _ in range(4):
        x += spread @ np.linalg.lstsq(reduced, left, rcond=1e-15)[0]
        left = gap - a @ x
        if np.abs(left).max(initial=0) < 1e-9:
            break
    return pd.DataFrame({"day": np.repeat(days, 2), "is_peak": np.tile([True, False], k), "knot": x})


# Coverage and distance of a period that is checked closely, and loosely.
FULL_COVERAGE, CLOSE, FAIR_COVERAGE, FAIR = 0.95, 0.005, 0.90, 0.05
# Least factor and least level of a multiplicative correction, greatest miss that is still applied.
LEAST_FACTOR, LEAST_LEVEL, GREATEST_MISS = 0.1, 0.1, 50.0


def calibrate(slots: DataFrame, contracts: DataFrame, multiplicative: bool = False, flag: str | None = None) -> DataFrame:
    """slots (curve_id, ts, is_peak, price) with calibrated: contract means met with the smoothest correction, added, or
    as a factor that is LEAST_FACTOR at least. A curve that misses a contract by more than GREATEST_MISS stays as it was;
    flag names a column that says whether the contracts were met (null without a contract).

    contracts: (curve_id, contract_id, start, end, load, price); may overlap. Slots are only aggregated, per
    contract, day and regime; one small solve per curve gives the knots, which are joined back by day. A
    contract is exploded into its days, so slots meet it by an equi-join."""
    day = F.datediff("ts", F.lit("1970-01-01"))
    rows = slots.withColumns({"day": day, "w": (F.hour("ts") * 60 + F.minute("ts")) / 1440.0})
    spans = contracts.withColumn("day", F.explode(F.sequence(F.datediff("start", F.lit("1970-01-01")), F.datediff(F.col("end") - F.expr("INTERVAL 1 SECOND"), F.lit("1970-01-01")))))
    wanted = F.when(F.col("load") == "Peak", F.col("is_peak")).when(F.col("load") == "Offpeak", ~F.col("is_peak")).otherwise(F.lit(True))
    spans = spans.withColumnRenamed("price", "target")
    met = rows.join(spans, ["curve_id", "day"]).where((F.col("ts") >= F.col("start")) & (F.col("ts") < F.col("end")) & wanted)
    stats = met.groupBy("curve_id", "contract_id", "day", "is_peak").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("w").alias("w1"), F.sum("price").alias("total"), F.first("target").alias("target"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = pdf.groupby("contract_id", as_index=False).agg(n=("n", "sum"), total=("total", "sum"), target=("target", "first"))
        sums["gap"] = sums["target"] - sums["total"] / sums["n"]
        knots = solve_knots(pdf, sums)
        moved = knots.pivot(index="day", columns="is_peak", values="knot")
        one = [moved.at[day, peak] * (n - w1) + moved.at[day + 1, peak] * w1 for day, peak, n, w1 in pdf[["day", "is_peak", "n", "w1"]].itertuples(index=False)]
        met = pdf.assign(moved=one).groupby("contract_id")["moved"].sum().reindex(sums["contract_id"]).to_numpy() / sums["n"].to_numpy()
        missed = np.abs(sums["gap"].to_numpy() - met).max(initial=0) > GREATEST_MISS
        if missed:
            knots["knot"] = 0.0
        return knots.assign(curve_id=pdf["curve_id"].iloc[0], ok=not missed)

    kind = slots.schema["curve_id"].dataType.simpleString()
    knots = stats.groupBy("curve_id").applyInPandas(solve, f"curve_id {kind}, day int, is_peak boolean, knot double, ok boolean")
    after = F.lead("knot").over(Window.partitionBy("curve_id", "is_peak").orderBy("day"))
    pairs = knots.select("curve_id", "day", "is_peak", F.col("knot").alias("k0"), after.alias("k1"), *([F.col("ok").alias(flag)] if flag else []))
    out = rows.join(pairs, ["curve_id", "day", "is_peak"], "left")
    change = F.coalesce((1 - F.col("w")) * F.col("k0") + F.col("w") * F.col("k1"), F.lit(0.0))
    if not multiplicative:
        return out.withColumn("calibrated", F.col("price") + change).drop("day", "w", "k0", "k1")
    level = F.when(F.abs("price") > LEAST_LEVEL, F.col("price")).otherwise(LEAST_LEVEL * F.signum(F.col("price") + 0.01))
    factor = F.greatest((F.col("price") + change) / level, F.lit(LEAST_FACTOR))
    out = out.withColumn("calibrated", F.col("price") * factor).drop("w", "k0", "k1")
    # the least factor moves means, so they are checked on the slots
    held = out.join(spans, ["curve_id", "day"]).where((F.col("ts") >= F.col("start")) & (F.col("ts") < F.col("end")) & wanted)
    misses = held.groupBy("curve_id", "contract_id").agg(F.abs(F.avg("calibrated") - F.first("target")).alias("miss"))
    failed = misses.groupBy("curve_id").agg(F.max("miss").alias("miss")).where(F.col("miss") > GREATEST_MISS)
    out = out.join(failed, "curve_id", "left").withColumn("calibrated", F.when(F.col("miss").isNull(), F.col("calibrated")).otherwise(F.col("price")))
    out = out.withColumn(flag, F.col(flag) & F.col("miss").isNull()) if flag else out
    return out.drop("day", "miss")


def residuals(slots: DataFrame, groups: list[str], price: str, target: str) -> DataFrame:
    """Per contract: target, achieved mean, absolute error."""
    rows = slots.where(F.col(target).isNotNull()).groupBy(*groups).agg(F.first(target).alias("target"), F.avg(price).alias("achieved"))
    return rows.withColumn("abs_error", F.abs(F.col("achieved") - F.col("target")))


def second_difference_cost(slots: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(order)
    bend = F.lag(value).over(w) - 2 * F.col(value) + F.lead(value).over(w)
    return slots.withColumn("bend", bend).groupBy(*key).agg(F.sum(F.col("bend") * F.col("bend")).alias("cost"))


def flavors(curve: DataFrame, months: Column, hour: Column) -> DataFrame:
    """Each slot three times: mid market, client offer (at least p90) and production value, with shifted bands."""
    spread, capture = tg.step_lookup(months, tg.SPREAD, 3.5), tg.step_lookup(months, tg.CAPTURE, 0.3)
    risk = F.element_at(F.array(*map(F.lit, tg.RISK_BY_HOUR)), hour + 1)
    kinds = F.array(*(F.struct(F.lit(n).alias("flavor"), add.alias("add")) for n, add in (("mid_market", F.lit(0.0)), ("client", spread + risk), ("production", capture))))
    rows = curve.select("*", F.inline(kinds))
    price = F.when(F.col("flavor") == "client", F.greatest(F.col("price") + F.col("add"), F.col("p90"))).otherwise(F.col("price") + F.col("add"))
    return rows.withColumns({"price": price, "p10": F.col("p10") + F.col("add"), "p90": F.col("p90") + F.col("add")}).drop("add")


def overlaid(price: Column, forecast: Column, hour_mean: Column, days_ahead: Column) -> Column:
    """Slots scaled to an hourly forecast up to day 8, blended out until day 10, untouched after."""
    scaled = F.when(hour_mean > 0, price * forecast / hour_mean).otherwise(forecast)
    weight = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (10 - days_ahead) / 2.0))
    return F.when(forecast.isNull(), price).otherwise(weight * scaled + (1 - weight) * price)
