"""License scans by diagonal voting.

Every k-gram of words of a text is hashed and joined with the k-grams of the license templates. A meeting
votes for the diagonal `place in the text - place in the template`. Votes are summed by text, template and
diagonal; diagonals of one template at most `NEIGHBOURS` apart are merged, which forgives an inserted or
dropped word; and a merged diagonal is a label if its span is verified: the words of its k-grams are
compared, they cover `COVER` of the template, and the span isn't much longer than the template. Of templates of one
family, which share sentences, those count whose cover is within `NEAR_BEST` of the text's best one. A phrase is
a template that has to be met whole on one diagonal, whatever else is met. Everything is built from DataFrame functions.

Templates are a table (label, text, phrase, family; a null family is the label). `notices` gives the phrases of the contract and the notices of some
thirty public licenses, which stand in `license_notices.txt`. A template has at least `GRAM` words; a shorter
one raises.

Scale: the k-grams of the templates are counted; up to `BROADCAST_GRAMS` they are broadcast and texts never
move; beyond, the k-grams of texts are shuffled under salts. Only verified meetings and one row of sizes per
text are shuffled then.

Edge cases: null and empty texts have no words and no label; texts that repeat a license count every place;
repeated rows are judged each on its own; null doc_ids are kept; an empty table gives an empty result, and so do no
templates give no label; other columns are ignored.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_words, hot_keys, join_hot, row_key, settle, text_of, work_dir

GRAM = 3
NEIGHBOURS = 3
COVER = 0.6
LONGEST = 1.5
NEAR_BEST = 0.02
BROADCAST_GRAMS = 200_000
SALTS = 16

# Phrases and labels of the contract.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]


def notice_rows() -> list[tuple[str, str, bool, str]]:
    """(label, text, phrase, family) of the contract's phrases and of each notice of the data file."""
    text = resources.files(__package__).joinpath("license_notices.txt").read_text("utf-8")
    parts = re.split(r"^== (.+)$", text, flags=re.MULTILINE)[1:]
    heads = [[x.strip() for x in head.split("/")] for head in parts[::2]]
    return [(*p, True, p[0]) for p in PHRASES] + [(head[0], body.strip(), False, head[-1]) for head, body in zip(heads, parts[1::2], strict=True)]


def notices(spark: SparkSession) -> DataFrame:
    names = ("label", "text", "phrase", "family")
    table = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row, strict=True))) for row in notice_rows()))
    return spark.range(1).select(F.inline(table))


def template_grams(templates: DataFrame, work: str) -> DataFrame:
    """(hash, gram, template, label, family, phrase, grams, place): one row per k-gram of a template."""
    rows = templates.select("label", F.coalesce("family", "label").alias("family"), "phrase", ascii_words(text_of()).alias("words")).distinct()
    rows = rows.withColumn("template", F.md5(F.encode(F.concat_ws("|", "label", "family", F.col("phrase").cast("string"), F.array_join("words", " ")), "UTF-8")))
    rows = settle(rows, f"{work}/templates")
    short = rows.where(F.size("words") < GRAM).first()
    if short is not None:
        raise ValueError(f"a template of {short['label']} has fewer than {GRAM} words")
    n = F.size("words") - (GRAM - 1)
    at = rows.select("template", "label", "family", "phrase", "words", n.alias("grams"), F.explode(F.sequence(F.lit(0), n - 1)).alias("place"))
    words = F.slice("words", F.col("place") + 1, GRAM)
    at = at.select(F.xxhash64(*(words[j] for j in range(GRAM))).alias("hash"), F.array_join(words, " ").alias("gram"), "template", "label", "family", "phrase", "grams", "place")
    return settle(at, f"{work}/grams")


def votes(docs: DataFrame, templates: DataFrame, work: str, broadcast_grams: int = BROADCAST_GRAMS) -> tuple[DataFrame, DataFrame]:
    """(sizes, meetings): sizes is (row_key, doc_id, n_words); meetings is (row_key, template, label, family, phrase,
    grams, at, place) of each verified k-gram; row_key tells apart the rows of docs."""
    known = template_grams(templates, work)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ascii_words(text_of()).alias("words"), row_key().alias("row_key"))
    last = F.size("words") - GRAM
    grams = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(GRAM))))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("grams_of", F.array_append(grams, F.lit(None).cast("long")))
    # outer, as for an inner explode Spark tests the array's size below it, where it computes the array anew
    rows = rows.select("row_key", "doc_id", "words", F.posexplode_outer("grams_of").alias("at", "hash"))
    gram = F.array_join(F.slice("words", F.col("at") + 1, GRAM), " ")
    size = F.when(F.col("hash").isNull(), F.size("words").cast("long")).alias("n_words")
    out = ["row_key", "doc_id", "n_words", "template", "label", "family", "phrase", "grams", "at", "place"]
    if known.count() <= broadcast_grams:
        met = rows.join(F.broadcast(known), "hash", "left").where(F.col("hash").isNull() | (F.col("gram") == gram)).withColumn("n_words", size)
    else:
        slim = rows.select("row_key", "doc_id", "at", "hash", size, gram.alias("text_gram"), F.pmod(F.hash("row_key"), F.lit(SALTS)).alias("salt"))
        salted = known.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
        slim = settle(slim, f"{work}/slim")
        met = slim.where("hash IS NOT NULL").join(salted, ["hash", "salt"]).where("gram = text_gram").select(out).unionByName(slim.where("hash IS NULL").select("row_key", "doc_id", "n_words", "at"), allowMissingColumns=True)
    met = settle(met.select(out), f"{work}/met")
    return met.where("n_words IS NOT NULL").select("row_key", "doc_id", "n_words"), met.where("n_words IS NULL").drop("n_words", "doc_id").distinct()


def spans(meetings: DataFrame) -> DataFrame:
    """(row_key, label, phrase, first, cover): verified places of phrases and spans of templates."""
    key = ["row_key", "template", "label", "family", "phrase", "grams"]
    diagonals = meetings.withColumn("diagonal", F.col("at") - F.col("place")).groupBy(*key, "diagonal").agg(
        F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    whole = diagonals.where(F.col("phrase") & (F.size("places") == F.col("grams")))
    whole = whole.select("row_key", "label", "phrase", F.col("diagonal").alias("first"), F.lit(1.0).alias("cover"))
    order = Window.partitionBy("row_key", "template").orderBy("diagonal")
    gap = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > NEIGHBOURS).cast("int"), F.lit(0))
    merged = diagonals.where(~F.col("phrase")).withColumn("gap", gap).withColumn("band", F.sum("gap").over(order))
    merged = merged.groupBy(*key, "band").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("met"), F.min("first").alias("first"), F.max("last").alias("last"))
    cover = F.col("met") / F.col("grams")
    near = merged.where((cover >= COVER) & (F.col("last") - F.col("first") + 1 <= LONGEST * F.col("grams")))
    best = F.max("cover").over(Window.partitionBy("row_key", "family"))
    near = near.withColumn("cover", cover).withColumn("best", best).where(F.col("cover") >= F.col("best") - NEAR_BEST)
    return whole.unionByName(near.select("row_key", "label", "phrase", F.col("first").cast("int").alias("first"), "cover"))


def scan(docs: DataFrame, templates: DataFrame | None = None, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """Per row of docs (doc_id, text): sizes, places and labels; score is the best cover of any template."""
    work = work_dir(docs.sparkSession, "licenses")
    sizes, meetings = votes(docs, notices(docs.sparkSession) if templates is None else templates, work, broadcast_grams)
    base = F.col("phrase")
    found = spans(meetings).groupBy("row_key").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    none = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    found = settle(found, f"{work}/found")
    every = join_hot(sizes, found, "row_key", None, hot_keys(sizes, "row_key", f"{work}/hot"), "left")
    return every.na.fill(none).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def sql() -> str:
    """The same in DuckDB: k-grams as strings, the same diagonals, bands and covers."""
    words = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    rows = [f"({no}, '{label}', '{family}', {str(phrase).lower()}, string_split('{' '.join(words(text))}', ' '))" for no, (label, text, phrase, family) in enumerate(notice_rows())]
    return rf"""
WITH tw(template, label, family, phrase, w) AS (VALUES {', '.join(rows)}), t AS (
  SELECT template, label, family, phrase, len(w) - 2 AS grams, p - 1 AS place, array_to_string(w[p:p + 2], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 1)) AS p FROM tw)
), d AS (
  SELECT doc_id, row_number() OVER () AS row_key, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), m AS (
  SELECT row_key, template, label, family, phrase, grams, spot, place FROM (SELECT row_key, p - 1 AS spot, array_to_string(w[p:p + 2], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 1))) AS p FROM d)) JOIN t USING (g)
), g AS (
  SELECT row_key, template, label, family, phrase, grams, spot - place AS diagonal, list(DISTINCT place) AS places, min(spot) AS first, max(spot) AS last FROM m GROUP BY ALL
), b AS (
  SELECT *, sum(gap) OVER (PARTITION BY row_key, template ORDER BY diagonal) AS band FROM (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row_key, template ORDER BY diagonal) > {NEIGHBOURS} THEN 1 ELSE 0 END AS gap FROM g WHERE NOT phrase)
), n AS (
  SELECT row_key, template, label, family, grams, band, min(first) AS first, max(last) AS last, len(list_distinct(flatten(list(places)))) AS met FROM b GROUP BY ALL
), s AS (
  SELECT row_key, label, true AS phrase, diagonal AS first, CAST(1 AS DOUBLE) AS cover FROM g WHERE phrase AND len(places) = grams
  UNION ALL SELECT row_key, label, false, first, met / grams FROM n WHERE met / grams >= {COVER} AND last - first + 1 <= {LONGEST} * grams
    QUALIFY met / grams >= max(met / grams) OVER (PARTITION BY row_key, family) - {NEAR_BEST}
), f AS (
  SELECT row_key, count(*) FILTER (phrase) AS n_base, min(first) FILTER (phrase) AS first_word, max(first) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score FROM s GROUP BY row_key
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN f USING (row_key)
"""
