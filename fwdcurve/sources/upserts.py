"""Upserts into stored, partitioned Parquet tables: only partitions in which a batch changes a row are written again.

A batch is compared with the partitions it touches (others aren't opened, by partition pruning), the changed ones are
merged, staged beside the table and swapped in by a dynamic partition overwrite. A batch that is run again finds nothing to change
and writes nothing; after a failure between stage and swap a rerun does the same work again. What reaches the driver are the
values of touched partitions, a few for each batch."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import keep_last


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _swap(rows: DataFrame, path: str, partition: str) -> None:
    rows.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def _values(rows: DataFrame, partition: str) -> list:
    return sorted((r[0] for r in rows.select(partition).distinct().collect()), key=lambda v: (v is not None, v))


def _among(partition: str, values: list) -> Column:
    known = F.col(partition).isin([v for v in values if v is not None])
    return known | F.col(partition).isNull() if None in values else known


def changed_partitions(existing: DataFrame, new: DataFrame, keys: list[str], partition: str) -> list:
    """Partitions in which a row of new is missing or differs."""
    same = F.lit(True)
    for c in new.columns:
        same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"e.{c}"))
    return _values(new.alias("n").join(existing.select(new.columns).alias("e"), same, "left_anti"), partition)


def upsert_stored(new: DataFrame, path: str, keys: list[str], partition: str, newest: list[Column] | None = None) -> list:
    """Merge new into the table at path, whose rows it replaces where keys agree; the partitions that were written.

    partition is a column that the keys determine. Of rows of new with equal keys the first in the order newest counts, else
    the one with the least hash."""
    spark = new.sparkSession
    once = keep_last(new, keys, newest or [F.xxhash64(*new.columns)])
    if not exists(spark, path):
        _swap(once, path, partition)
        return _values(once, partition)
    stored = spark.read.schema(new.select(*(c for c in new.columns if c != partition), partition).schema).parquet(path)
    touched = _values(once, partition)
    changed = changed_partitions(stored.where(_among(partition, touched)), once, keys, partition)
    if changed:
        old, fresh = stored.where(_among(partition, changed)), once.where(_among(partition, changed))
        on = [F.col(f"o.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
        kept = old.alias("o").join(fresh.select(*keys).alias("f"), on, "left_anti")
        stage = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
        kept.unionByName(fresh).write.parquet(stage)
        _swap(spark.read.schema(stored.schema).parquet(stage), path, partition)
    return changed


def derive_stored(spark: SparkSession, raw: str, derived: str, partition: str, values: list, schema: str, build) -> None:
    """Compute the derived table anew for some partitions of a raw one: build takes their rows and keeps the partition column."""
    if values:
        rows = spark.read.schema(schema).parquet(raw).where(_among(partition, values))
        _swap(build(rows), derived, partition)
