"""Readers and payload shapers. Each declares its schema: nothing is inferred from the data."""

from __future__ import annotations

import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .writers import LOCAL_CSV


def parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scan of the declared columns alone."""
    return spark.read.schema(schema).parquet(path)


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The declared columns of the table, or an empty table of them if nothing is there; a file without a readable footer counts
    as absent. Either case warns. Footers are read by tasks, all of them."""
    declared = spark.createDataFrame([], schema)
    try:
        found = spark.read.option("mergeSchema", True).parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        warnings.warn(f"{path} can't be read in whole and counts as far as it can: {str(error).splitlines()[0]}", stacklevel=2)
        try:
            return spark.read.schema(declared.schema).option("ignoreCorruptFiles", True).parquet(path)
        except (PySparkException, Py4JJavaError):
            return declared
    return found.select(*((F.col(f.name) if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared.schema))


def curve_csv(spark: SparkSession, path: str) -> DataFrame:
    """`;`-separated market;local_ts;price; rows whose time or price doesn't parse are dropped."""
    rows = spark.read.schema("market string, local_ts string, price string").csv(path, sep=";", header=True)
    parsed = rows.select("market", F.try_to_timestamp("local_ts", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("ts"), F.col("price").try_cast("double").alias("price"))
    return parsed.dropna(subset=["ts", "price"])


def local_csv(spark: SparkSession, path: str) -> DataFrame:
    """What writers.local_csv wrote, as texts; a cell without quotes and content is null, an empty text has quotes."""
    return spark.read.schema("series string, local_ts string, price string").csv(path, multiLine=True, nullValue="\0", **LOCAL_CSV)


def price_payload(landed: DataFrame, start: str, end: str) -> DataFrame:
    """Rows (series, ts, price) of bodies with parallel arrays; of equal seconds the one with the last event_id, in
    bodies without event_id the last one; [start, end)."""
    body = F.from_json("body", "unix_seconds array<bigint>, event_id array<bigint>, price array<double>")
    rows = landed.select("series", body.alias("b")).select("series", F.posexplode(F.arrays_zip(F.col("b.unix_seconds").alias("unix_seconds"), F.coalesce("b.event_id", "b.unix_seconds").alias("event_id"), F.col("b.price").alias("price"))).alias("at", "x"))
    rows = rows.select("series", F.timestamp_seconds("x.unix_seconds").cast("timestamp_ntz").alias("ts"), F.col("x.price").alias("price"), F.struct("x.event_id", "at").alias("at")).where("price IS NOT NULL")
    rows = rows.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
    return rows.groupBy("series", "ts").agg(F.max_by("price", "at").alias("price"))


def power_payload(landed: DataFrame, names: dict[str, str]) -> DataFrame:
    """Bodies [{name, value}, …] as one column for each target name, and other for the rest."""
    rows = landed.select("ts", F.inline(F.from_json("body", "array<struct<name:string,value:double>>")))
    target = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("name")), F.lit("other"))
    return rows.withColumn("target", target).groupBy("ts").pivot("target", [*dict.fromkeys(names.values()), "other"]).agg(F.sum("value"))


def chunked(spark: SparkSession, path: str, schema: str, start: str, end: str) -> DataFrame:
    """Files in folders chunk=<first day>: only those that can overlap [start, end) are opened."""
    rows = spark.read.schema(f"{schema}, chunk date").json(path)
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    rows = rows.where((F.col("chunk") >= F.date_sub(lo, 1)) & (F.col("chunk") < hi)).withColumn("ts", F.timestamp_millis("ms").cast("timestamp_ntz"))
    return rows.where((F.col("ts") >= lo.cast("timestamp_ntz")) & (F.col("ts") < hi.cast("timestamp_ntz")) & F.col("value").isNotNull())


def reservoir_csv(spark: SparkSession, path: str) -> DataFrame:
    """(week, fill_gwh, max_capacity_gwh, fill_pct): percent of capacity, two decimals, within 0 and 100."""
    rows = spark.read.schema("Datum date, Inhalt double, Maximum double").csv(path, header=True)
    pct = F.round(100 * F.try_divide("Inhalt", "Maximum"), 2)
    return rows.select(F.col("Datum").alias("week"), F.col("Inhalt").alias("fill_gwh"), F.col("Maximum").alias("max_capacity_gwh"), F.greatest(F.lit(0.0), F.least(F.lit(100.0), pct)).alias("fill_pct"))


def wide_report(landed: DataFrame, codes: list[str]) -> DataFrame:
    """(date, code, price) of a report with a column per product code; decimal commas; positive prices."""
    long = landed.unpivot("date", codes, "code", "raw")
    price = F.replace(F.col("raw"), F.lit(","), F.lit(".")).try_cast("double")
    return long.select("date", "code", price.alias("price")).where("price > 0")


CODE = r"^([YQM])(\d{2})_(\d{4})_(BASE|PEAK)$"


def product_code(code: Column) -> Column:
    """struct(key, load) of a code like Q01_2026_BASE; null if it isn't one or is out of range."""
    kind, no, year = F.regexp_extract(code, CODE, 1), F.regexp_extract(code, CODE, 2).try_cast("int"), F.regexp_extract(code, CODE, 3)
    key = F.when((kind == "Y") & (no == 1), year).when((kind == "Q") & no.between(1, 4), F.concat(year, F.lit("-Q"), no.cast("string"))).when((kind == "M") & no.between(1, 12), F.concat(year, F.lit("-"), F.lpad(no.cast("string"), 2, "0")))
    return F.when(key.isNotNull(), F.struct(key.alias("key"), F.initcap(F.lower(F.regexp_extract(code, CODE, 4))).alias("load")))


def failover(sources: dict[str, DataFrame], keys: list[str], value: str) -> DataFrame:
    """Per key the value of the first source that has one, with the source's name."""
    rows = None
    for rank, (name, df) in enumerate(sources.items()):
        part = df.where(F.col(value).isNotNull()).select(*keys, value, F.lit(rank).alias("rank"), F.lit(name).alias("source"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(*keys).agg(F.min_by(value, "rank").alias(value), F.min_by("source", "rank").alias("source"))


def close_columns(wide: DataFrame, day: str) -> DataFrame:
    """(day, name, close) of the columns `<name>|close` that hold a value."""
    columns = [c for c in wide.columns if c.endswith("|close")]
    plain = wide.select(day, *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)))
    long = plain.unpivot(day, [f"c{k}" for k in range(len(columns))], "column", "close").where("close IS NOT NULL")
    names = F.create_map(*(F.lit(x) for k, c in enumerate(columns) for x in (f"c{k}", c.split("|")[0])))
    return long.select(day, F.element_at(names, F.col("column")).alias("name"), "close")


def load_model(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("model_version") == version).drop("model_version")


def latest_artifact(spark: SparkSession, path: str, prefix: str, schema: str) -> DataFrame:
    """Rows of the folder artifact=<prefix>_<date> with the latest date, with prefix and run_date; no rows without one. The choice
    is made on the partition column, so no other folder is opened."""
    rows = spark.read.schema(f"{schema}, artifact string").parquet(path)
    day = F.to_date(F.regexp_extract("artifact", rf"^{prefix}_(\d{{4}}-\d{{2}}-\d{{2}})$", 1))
    mine = rows.where(F.col("artifact").rlike(rf"^{prefix}_\d{{4}}-\d{{2}}-\d{{2}}$"))
    last = mine.agg(F.max("artifact")).first()[0]
    return mine.where(F.col("artifact") == F.lit(last)).withColumns({"prefix": F.lit(prefix), "run_date": day}).drop("artifact")
