"""Sinks: exports in local time, curve tables, run history by partition overwrite."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timegrid import local_time


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; where that isn't set, a local session uses a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="fwdcurve-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def curve_csv(curve: DataFrame, path: str) -> None:
    """market;local_ts;price with four decimals."""
    curve.select("market", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("local_ts"), F.format_string("%.4f", F.round("price", 4)).alias("price")).write.csv(path, sep=";", header=True)


def fixed(value: Column, digits: int = 4) -> Column:
    """A double with so many decimals (1 or more), rounded on its binary value as C's printf does, an exact tie to the even digit; null
    stays null. format_string starts from the shortest decimal form and so differs on ties; from 2^63 on, this has that form's digits."""
    size, plain, pattern = F.abs(value), value.cast("string"), F.lit("0." + "0" * digits)
    whole = F.floor(size)
    part = F.call_function("format_number", size - whole, pattern)  # of the exact rest below 1, so that large values lose no digit
    text = F.concat((whole + part.substr(1, 1).cast("long")).cast("string"), part.substr(2, digits + 1))
    text = F.when(size < 2.0**63, text).when(size < float("inf"), F.call_function("format_number", size, pattern))
    return F.concat(F.when(plain.startswith("-"), "-").otherwise(""), text.otherwise(F.lower(size.cast("string").substr(1, 3))))


#: Doubled quotes and kept blanks and line breaks: any text comes back as it was.
LOCAL_CSV = {"sep": ";", "header": True, "escape": '"', "lineSep": "\n", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def local_csv(curve: DataFrame, path: str, zone: str = "Europe/Zurich") -> None:
    """series;local_ts;price for spreadsheet users: local time, day first, four decimals."""
    local = F.date_format(local_time(F.col("ts"), zone), "dd.MM.yyyy HH:mm")
    curve.select("series", local.alias("local_ts"), fixed(F.col("price")).alias("price")).write.csv(path, **LOCAL_CSV)


def curve_parquet(curve: DataFrame, path: str, partition: list[str]) -> None:
    curve.repartition(*partition).sortWithinPartitions("ts").write.partitionBy(*partition).option("compression", "snappy").parquet(path)


def replace_runs(rows: DataFrame, path: str) -> None:
    """Write rows by run_id; runs that are there already are replaced, others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def create_history(spark: SparkSession, name: str, path: str) -> None:
    """History table with a partition per run, which takes an index's place."""
    spark.sql(f"CREATE TABLE {name} (ts TIMESTAMP_NTZ, price DOUBLE, run_id STRING) USING parquet PARTITIONED BY (run_id) LOCATION '{path}'")


def save_model(table: DataFrame, path: str, version: str) -> None:
    table.withColumn("model_version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_version").parquet(path)
