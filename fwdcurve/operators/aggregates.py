"""Aggregate expressions used across shapes, validation and reports."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def weighted_mean(x: Column, w: Column) -> Column:
    return F.sum(x * w) / F.nullif(F.sum(F.when(x.isNotNull(), w)), F.lit(0.0))


def error_metrics(error: Column, actual: Column) -> dict[str, Column]:
    """mae, rmse, bias, mape (percent, where abs(actual) > 1), p95 of the absolute error."""
    return {
        "mae": F.avg(F.abs(error)), "rmse": F.sqrt(F.avg(error * error)), "bias": F.avg(error),
        "mape": 100 * F.avg(F.when(F.abs(actual) > 1, F.abs(error / actual))), "p95": F.percentile(F.abs(error), F.lit(0.95)),
    }


def share(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def average_rank(col: str, keys: list[str]) -> Column:
    """Rank within keys where ties share the mean of their ranks."""
    w = Window.partitionBy(*keys)
    return F.rank().over(w.orderBy(col)) + (F.count(F.lit(1)).over(Window.partitionBy(*keys, col)) - 1) / 2.0


def welch(df: DataFrame, keys: list[str], half: str, value: str) -> DataFrame:
    """t and degrees of freedom of the two halves (0 and 1) of value within keys."""
    part = lambda fn, k: fn(F.when(F.col(half) == k, F.col(value)))
    stats = df.groupBy(*keys).agg(*(part(fn, k).alias(f"{n}{k}") for k in (0, 1) for n, fn in (("m", F.avg), ("v", F.var_samp), ("n", F.count))))
    a, b = F.col("v0") / F.col("n0"), F.col("v1") / F.col("n1")
    return stats.withColumns({
        "t": (F.col("m1") - F.col("m0")) / F.nullif(F.sqrt(a + b), F.lit(0.0)),
        "df": (a + b) * (a + b) / F.nullif(a * a / F.nullif(F.col("n0") - 1, F.lit(0)) + b * b / F.nullif(F.col("n1") - 1, F.lit(0)), F.lit(0.0)),
    })


def incomplete_beta(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c = 1e-300, 1.0
    d = 1 / max(1 - (a + b) * x / (a + 1), tiny)
    total = d
    for m in range(1, 300):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + term / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1) < 1e-12:
            break
    return front * total


def with_p_value(tests: DataFrame, families: list[str], alpha: float = 0.05) -> DataFrame:
    """tests (t, df, …) with the two-sided p-value and whether it holds after Bonferroni within families."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(p=[incomplete_beta(df / (df + t * t), df / 2, 0.5) if df == df and t == t else None for t, df in zip(pdf["t"], pdf["df"], strict=True)])

    schema = tests.withColumn("p", F.lit(None).cast("double")).schema
    n = F.count("p").over(Window.partitionBy(*families))
    return tests.mapInPandas(add, schema).withColumn("significant", F.col("p") * n < alpha)


def sliding_breaks(hours: DataFrame, keys: list[str], months: int = 12) -> DataFrame:
    """(*keys, cut, hour, t, df): Welch's test of each hour's share of its month's mean profile, of so many months from a month's
    start on against as many before, for every start with both. hours: (*keys, d, hour, price).

    A month's profile is a row of 24 shares and lies in 2 * months pairs of windows, so it is repeated so often."""
    profile = hours.groupBy(*keys, F.to_date(F.date_trunc("month", "d")).alias("month"), "hour").agg(F.avg("price").alias("m"))
    profile = profile.withColumn("f", F.col("m") / F.avg("m").over(Window.partitionBy(*keys, "month")))
    shifts = F.explode(F.sequence(F.lit(1 - months), F.lit(months)))
    rows = profile.withColumn("shift", shifts).withColumns({"cut": F.add_months("month", F.col("shift")), "after": (F.col("shift") <= 0).cast("int")})
    tests = welch(rows, [*keys, "cut", "hour"], "after", "f")
    return tests.where((F.col("n0") == months) & (F.col("n1") == months)).select(*keys, "cut", "hour", "t", "df")


# Look-back without a break, and the least after one, in months.
FULL_LOOKBACK, LEAST_LOOKBACK = 36, 12


def breaks(tests: DataFrame, keys: list[str], alpha: float = 0.05) -> DataFrame:
    """(*keys, cut, p, broken, lookback_months) of sliding_breaks: p is the least of the hours' after Bonferroni; the look-back is
    that of the key's last break, to a year after its last cut."""
    hours = with_p_value(tests, [*keys, "cut"])
    cuts = hours.groupBy(*keys, "cut").agg(F.least(F.min("p") * F.count("p"), F.lit(1.0)).alias("p"))
    w = Window.partitionBy(*keys)
    cuts = cuts.withColumn("broken", F.coalesce(F.col("p") < alpha, F.lit(False)))
    last = F.max(F.when(F.col("broken"), F.col("cut"))).over(w)
    since = F.months_between(F.max("cut").over(w), last).cast("int") + 12
    return cuts.withColumn("lookback_months", F.when(last.isNull(), FULL_LOOKBACK).otherwise(F.least(F.greatest(since, F.lit(LEAST_LOOKBACK)), F.lit(FULL_LOOKBACK))))
