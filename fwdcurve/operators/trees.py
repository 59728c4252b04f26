"""Gradient-boosted regression trees for many groups at once, grown level by level from histograms.

Each group (a cutoff, say) has an ensemble of its own over all its rows. Columns are cut into bins by their quantiles
within the group; a level of all trees of a round is one grouping of rows by (group, node, column, bin), and splits are chosen
on that table, which has at most groups x nodes x columns x bins rows. No group is gathered, whatever its size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Relative rank error of bin edges is one over this.
ACCURACY = 10_000
LEAST_GAIN = 1e-12


def binned(rows: DataFrame, keys: list[str], columns: list[str], target: str, bins: int) -> DataFrame:
    """rows with _bins: for each column the number of its group's edges below the value. Edges are values of known rows."""
    shares = F.array(*(F.lit(k / bins) for k in range(1, bins)))
    known = rows.where(F.col(target).isNotNull())
    edges = known.groupBy(*keys).agg(*(F.percentile_approx(c, shares, F.lit(ACCURACY)).alias(f"_e{j}") for j, c in enumerate(columns)))
    place = lambda j, c: F.size(F.filter(F.array_distinct(f"_e{j}"), lambda e: e < F.col(c)))
    return rows.join(edges, keys).withColumn("_bins", F.array(*(place(j, c) for j, c in enumerate(columns)))).drop(*(f"_e{j}" for j in range(len(columns))))


def best_splits(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, _node, _column, _cut): the split of each node that lowers the squared error of _g most, if any does; ties go to
    the first column and the lowest bin. Rows whose bin is above _cut go right."""
    per = rows.select(*keys, "_node", F.posexplode("_bins").alias("_column", "_bin"), "_g").groupBy(*keys, "_node", "_column", "_bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_g").alias("s"))
    of = Window.partitionBy(*keys, "_node", "_column")
    upto = of.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    cuts = per.select(*keys, "_node", "_column", "_bin", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).alias("sl"), F.sum("n").over(of).alias("n"), F.sum("s").over(of).alias("s")).where("nl < n")
    gap = F.col("sl") / F.col("nl") - (F.col("s") - F.col("sl")) / (F.col("n") - F.col("nl"))
    cuts = cuts.withColumn("gain", F.col("nl") * (F.col("n") - F.col("nl")) / F.col("n") * gap * gap).where(F.col("gain") > LEAST_GAIN)
    first = F.struct("gain", -F.col("_column"), -F.col("_bin"))
    best = cuts.groupBy(*keys, "_node").agg(F.max_by(F.struct("_column", "_bin"), first).alias("b"))
    return best.select(*keys, "_node", F.col("b._column").alias("_column"), F.col("b._bin").alias("_cut"))


def boosted(rows: DataFrame, keys: list[str], columns: list[str], target: str, settle: Callable[[DataFrame], DataFrame], rounds: int = 5, depth: int = 3, rate: float = 0.1, bins: int = 32) -> DataFrame:
    """rows with prediction, from trees fitted on the group's rows whose target is known; rows of groups without any go.

    The first tree fits the target and counts in full, later ones fit twice the error that is left and count by rate, as Spark ML's
    GBTRegressor does. settle writes a table and reads it back: rows once a round, splits once a level."""
    state = settle(binned(rows, keys, columns, target, bins).withColumn("prediction", F.lit(0.0)))
    for k in range(rounds):
        g = F.col(target) if k == 0 else 2 * (F.col(target) - F.col("prediction"))
        grown = state.withColumns({"_g": g, "_node": F.lit(0)})
        for _ in range(depth):
            splits = settle(best_splits(grown.where("_g IS NOT NULL"), keys))
            right = (F.try_element_at("_bins", F.col("_column") + 1) > F.col("_cut")).cast("int")
            grown = grown.join(splits, [*keys, "_node"], "left").withColumn("_node", F.when(F.col("_column").isNull(), F.col("_node")).otherwise(2 * F.col("_node") + 1 + right)).drop("_column", "_cut")
        leaves = settle(grown.where("_g IS NOT NULL").groupBy(*keys, "_node").agg(F.avg("_g").alias("_leaf")))
        moved = F.col("prediction") + (1.0 if k == 0 else rate) * F.col("_leaf")
        state = settle(grown.join(leaves, [*keys, "_node"]).withColumn("prediction", moved).select(state.columns))
    return state.drop("_bins")
