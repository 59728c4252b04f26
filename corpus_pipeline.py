"""A corpus pipeline of five stages; each reads the table that the one before it wrote.

Every stage takes documents (doc_id, text, lang, source, n_chars) and leaves other columns aside, whatever their
names. Null texts count as empty, an empty table gives an empty one, and long texts are read whole. What
happens to null doc_ids, repeated rows and ties stands with each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwdcurve.llm import fair_mix, nb_svm, simhash, token_files, winnowing
from fwdcurve.llm.common import settle, work_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at the threshold or above; it learns from labels of docs.

    Repeated rows, and rows that share or lack a doc_id, are scored each by its own text; without labels of both
    classes all stay (their score is 0.5)."""
    docs = docs.select(COLUMNS)
    model = nb_svm.fit(docs.where(~nb_svm.fold()), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return nb_svm.scored(docs, model, COLUMNS).where(F.col("score") >= nb_svm.THRESHOLD).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least doc_id, of each group of near-duplicates.

    Null doc_ids come last; of one doc_id's texts that with the least hash stays, of repeated rows one. Empty texts are
    near-duplicates of each other. Rows that share a doc_id but not their text are separate documents."""
    return simhash.keep_one(docs.select(COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items don't contaminate.

    Rows are judged by their own text, so null and shared doc_ids make no difference; repeated rows go or stay
    together. Without benchmark items all stay."""
    return winnowing.clean(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    Documents without words are never taken; a null source is a source of its own. Ties of the drawn order go by
    doc_id; repeated rows share what is taken of them."""
    return fair_mix.mixed_rows(docs.select(COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents; a row per document with its place in them.

    Null doc_ids come first; rows with one doc_id are ordered by a hash of the text; repeated rows are written as often
    as they occur."""
    return token_files.token_output(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the whole documents table."""
    docs, work = spark.read.parquet(f"{sf_dir}/documents.parquet"), work_dir(spark, "pipeline")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"{work}/{name}")
    return docs
