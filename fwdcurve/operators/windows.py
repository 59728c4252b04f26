"""Window operators on keyed series. Every window has the series' key, so series run in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST, LAST = Window.unboundedPreceding, Window.unboundedFollowing


def by(keys: list[str], order, start: int | None = None, end: int | None = None):
    w = Window.partitionBy(*keys).orderBy(*(order if isinstance(order, list) else [order]))
    return w if start is None else w.rowsBetween(start, end)


def keep_last(df: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """Per key the row that comes first in the order `newest`."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))
    return ranked.where("_rank = 1").drop("_rank")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing with the rows of new, which win where keys are equal. Within new, keys are unique."""
    rows = existing.withColumn("load_seq", F.lit(0)).unionByName(new.withColumn("load_seq", F.lit(1)))
    return keep_last(rows, keys, [F.desc("load_seq")]).drop("load_seq")


def ffill(col: str, keys: list[str], order: str) -> Column:
    return F.last(col, True).over(by(keys, order, FIRST, 0))


def bfill(col: str, keys: list[str], order: str) -> Column:
    return F.first(col, True).over(by(keys, order, 0, LAST))


def interpolated(df: DataFrame, col: str, keys: list[str], order: str, at: Column, out: str) -> DataFrame:
    """Adds out: col, where null on the line between its neighbours at the positions `at`; ends stay null."""
    known = F.col(col).isNotNull()
    df = df.withColumn("_at", at)
    df = df.withColumns({
        "_x0": F.last(F.when(known, F.col("_at")), True).over(by(keys, order, FIRST, 0)), "_y0": ffill(col, keys, order),
        "_x1": F.first(F.when(known, F.col("_at")), True).over(by(keys, order, 0, LAST)), "_y1": bfill(col, keys, order),
    })
    line = F.col("_y0") + (F.col("_y1") - F.col("_y0")) * F.try_divide(F.col("_at") - F.col("_x0"), F.col("_x1") - F.col("_x0"))
    return df.withColumn(out, F.coalesce(F.col(col), line)).drop("_at", "_x0", "_y0", "_x1", "_y1")


def normalised(col: str, keys: list[str], eps: float = 0.0) -> Column:
    """col over its mean within keys; 1 where the mean is within eps of 0."""
    mean = F.avg(col).over(Window.partitionBy(*keys))
    return F.when(F.abs(mean) > eps, F.col(col) / mean).otherwise(F.lit(1.0))


def rolling(fn, col: str, keys: list[str], order: str, start: int, end: int, least: int = 1) -> Column:
    """fn over a frame of rows; null where fewer than `least` values are in it."""
    w = by(keys, order, start, end)
    return F.when(F.count(col).over(w) >= least, fn(col).over(w))


def zscore(col: str, keys: list[str]) -> Column:
    """Distance from the mean in sample deviations; 0 where they are 0 or unknown."""
    w = Window.partitionBy(*keys)
    return F.coalesce((F.col(col) - F.avg(col).over(w)) / F.nullif(F.stddev_samp(col).over(w), F.lit(0.0)), F.lit(0.0))


def quantile_edges(df: DataFrame, col: str, keys: list[str], shares: list[float]) -> DataFrame:
    """Adds q, the array of exact quantiles of col within keys: one aggregate, joined back."""
    edges = df.groupBy(*keys).agg(F.percentile(col, F.array(*map(F.lit, shares))).alias("q"))
    return df.join(edges, keys)


def decay_weight(ts: Column, newest: Column, half_life_days: float) -> Column:
    """exp(-ln 2 * age / half-life), age in days before newest."""
    return F.exp(-F.lit(0.6931471805599453) * F.datediff(newest, ts) / half_life_days)


def asof_backward(left: DataFrame, right: DataFrame, value: str, time: str, keys: list[str]) -> DataFrame:
    """left with the latest value of right at or before its time, within keys.

    Both sides are merged by time and the value carried forward, so neither needs to fit in memory; ties go to right."""
    rows = left.withColumn("_side", F.lit(1)).unionByName(right.select(*keys, time, value).withColumn("_side", F.lit(0)), allowMissingColumns=True)
    carried = F.last(value, True).over(Window.partitionBy(*keys).orderBy(time, "_side").rowsBetween(FIRST, 0))
    return rows.withColumn(value, carried).where("_side = 1").drop("_side")


def valid_ranges(right: DataFrame, time: str, keys: list[str]) -> DataFrame:
    """right with valid_from and valid_to (the next time within keys; null for the last)."""
    return right.withColumns({"valid_from": F.col(time), "valid_to": F.lead(time).over(by(keys, time))})


def autocorrelations(rows: DataFrame, keys: list[str], order: str, value: str, most: int, block: int = 2048) -> DataFrame:
    """(*keys, lag, acf) for every lag from 1 to `most`, as far as a series has so many rows.

    A series is cut into blocks of rows; a block meets itself and as many that follow as the lags reach, and its products are
    summed by lag inside, so a task holds a few blocks and what is shuffled is each row once for every block it meets and a
    number for each block and lag."""
    reach = -(-most // block)
    mean = rows.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.count(value).alias("_n"))
    no = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    dev = rows.where(F.col(value).isNotNull()).withColumn("_i", no).join(mean, keys).select(*keys, "_n", (F.col("_i") / F.lit(block)).cast("int").alias("_block"), "_i", (F.col(value) - F.col("_mean")).alias("_e"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_i", "_e"))), lambda x: x["_e"])
    blocks = dev.groupBy(*keys, "_n", "_block").agg(ordered.alias("own"), F.sum(F.col("_e") * F.col("_e")).alias("squares"))
    w = Window.partitionBy(*keys).orderBy("_block")
    after = [F.coalesce(F.lead("own", k).over(w), F.array().cast("array<double>")) for k in range(1, reach + 1)]
    met = blocks.withColumns({"all": F.concat("own", *after), "n": F.size("own")})
    product = lambda k: F.aggregate(F.zip_with("own", F.slice("all", k + 1, F.col("n")), lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)
    lags = F.transform(F.sequence(F.lit(1), F.lit(most)), lambda k: F.struct(k.alias("lag"), product(k).alias("p")))
    sums = met.select(*keys, "_n", F.inline(lags)).groupBy(*keys, "_n", "lag").agg(F.sum("p").alias("p"))
    total = blocks.groupBy(*keys).agg(F.sum("squares").alias("squares"))
    return sums.where("lag < _n").join(total, keys).select(*keys, "lag", (F.col("p") / F.nullif(F.col("squares"), F.lit(0.0))).alias("acf"))
