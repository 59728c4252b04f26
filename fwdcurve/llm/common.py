"""Shared helpers: work folders, settled tables, word columns and files that executors write."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regex class of what separates the words of the contracts that use letters and digits only.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Java regex of a run that holds no ASCII white space.
BLANK_FREE = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under spark.checkpoint.dir, which all executors share, with its file system's scheme.

    Where the setting is absent a local session uses a local temporary folder; on a cluster that raises."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="fwdcurve-")
    return f"{qualified(spark, base).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """path with the scheme that Spark gives it, so that other readers look in the same place."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


#: Set while an operator writes its tables: Spark deletes the shuffle files of each query as it ends (its
#: result is in a table by then), and hands texts to Python a few megabytes at a time.
_FRUGAL = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _FRUGAL}
    for k, v in _FRUGAL.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def settle(df: DataFrame, path: str) -> DataFrame:
    """Write df as Parquet and read it back: later jobs start there, whatever executor is lost."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A key with more rows than this is joined under a salt.
HOT_ROWS = 2000
SALTS = 32


def hot_keys(many: DataFrame, key: str, path: str, most: int | None = None) -> DataFrame:
    """The values of key that have more than HOT_ROWS rows, settled at path."""
    most = HOT_ROWS if most is None else most
    return settle(many.groupBy(key).count().where(F.col("count") > most).select(key), path)


def join_hot(many: DataFrame, one: DataFrame, key: str, spread: str | None, hot: DataFrame, how: str = "inner") -> DataFrame:
    """many joined with one, which has each key at most once; the keys in `hot` are met under salts drawn from
    `spread`, or, for None, from the place of a row in `many`, which then has to be a settled table."""
    usual = many.join(hot, key, "left_anti").join(one, key, how)
    drawn = F.monotonically_increasing_id() if spread is None else F.xxhash64(spread)
    often = many.withColumn("join_salt", F.pmod(drawn, F.lit(SALTS)).cast("int")).join(hot, key, "left_semi")
    copies = one.join(hot, key, "left_semi").withColumn("join_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return usual.unionByName(often.join(copies, [key, "join_salt"], how).drop("join_salt"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that tell apart the rows of documents; equal rows have equal keys."""
    return F.unhex(F.md5(F.encode(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), text_of(text)), "UTF-8")))


def ascii_words(text: Column) -> Column:
    """Array of the words of a text: A-Z lower-cased, split at ASCII other than letters and digits."""
    return F.array_remove(F.split(F.translate(text, UPPER, UPPER.lower()), WORD_GAP), "")


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder of the shared storage."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri[5:]}")
    return fs.LocalFileSystem(), uri
