"""Exact quantiles of long series: ranges of values are narrowed by histograms until what is left to sort is short.

`percentile` keeps a group's distinct values in one buffer; here a group of any size is only counted by bins, and no task sorts
more than `limit` values of a key, unless they are equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, shares: list[float], settle: Callable[[DataFrame], DataFrame], limit: int = 100_000, bins: int = 1024, most_rounds: int = 64) -> DataFrame:
    """(*keys, q): the array of value's quantiles at `shares` within each key, interpolated between neighbouring ranks; nulls are
    left out. keys mustn't be null.

    A wanted rank lies in a range of values that so many others are below. A round counts the values of each range in equal
    bins, and the bin that holds the rank becomes the range, from its least to its greatest value. Ranges of `limit` values or fewer
    are counted value by value. settle writes the table of ranges, a few rows a key, and reads it back."""
    rows = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v"))
    ends = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    at = lambda s: F.lit(s) * (F.col("n") - 1)
    wanted = F.array(*(F.struct(F.lit(k).alias("share"), side.alias("side"), (F.floor(at(s)) + side).alias("rank"), (at(s) - F.floor(at(s))).alias("part")) for k, s in enumerate(shares) for side in (F.lit(0), F.lit(1))))
    # the rank above the last one is the last
    ranges = settle(ends.select(*keys, "n", "lo", "hi", F.inline(wanted)).withColumns({"rank": F.least("rank", F.col("n") - 1), "below": F.lit(0).cast("long"), "within": F.col("n")}))
    of = [*keys, "share", "side"]
    for _ in range(most_rounds):
        wide = ranges.where((F.col("within") > limit) & (F.col("lo") < F.col("hi")))
        if wide.isEmpty():
            break
        place = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
        met = rows.join(wide, keys).where("v BETWEEN lo AND hi").withColumn("bin", place)
        counted = met.groupBy(*of, "bin").agg(F.count(F.lit(1)).alias("n_bin"), F.min("v").alias("bin_lo"), F.max("v").alias("bin_hi"))
        upto = F.sum("n_bin").over(Window.partitionBy(*of).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        counted = counted.withColumn("upto", upto).join(wide, of)
        inside = (F.col("rank") >= F.col("below") + F.col("upto") - F.col("n_bin")) & (F.col("rank") < F.col("below") + F.col("upto"))
        narrowed = counted.where(inside).select(*keys, "n", F.col("bin_lo").alias("lo"), F.col("bin_hi").alias("hi"), "share", "side", "rank", "part", (F.col("below") + F.col("upto") - F.col("n_bin")).alias("below"), F.col("n_bin").alias("within"))
        ranges = settle(narrowed.unionByName(ranges.where((F.col("within") <= limit) | (F.col("lo") >= F.col("hi")))))
    single = ranges.where("lo >= hi").select(*of, "part", F.col("lo").alias("v"))
    short = rows.join(ranges.where("lo < hi"), keys).where("v BETWEEN lo AND hi").groupBy(*of, "rank", "below", "part", "v").agg(F.count(F.lit(1)).alias("n_v"))
    upto = F.sum("n_v").over(Window.partitionBy(*of).orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    short = short.withColumn("upto", upto).where((F.col("rank") >= F.col("below") + F.col("upto") - F.col("n_v")) & (F.col("rank") < F.col("below") + F.col("upto")))
    found = single.unionByName(short.select(*of, "part", "v")).groupBy(*keys, "share").agg(F.max(F.when(F.col("side") == 0, F.col("v"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("v"))).alias("b"), F.first("part").alias("part"))
    line = F.col("a") + (F.col("b") - F.col("a")) * F.col("part")
    return found.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("share", line.alias("q")))), lambda x: x["q"]).alias("q"))
