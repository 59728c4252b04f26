"""Benchmark decontamination by winnowing.

Words are hashed, k consecutive word hashes give a k-gram hash, and of every `w` neighbouring k-grams the one
with the least hash is kept (all of them on a tie). Both sides keep the same k-gram inside any shared span
of k+w-1 = `span` words, so a join of the kept fingerprints meets every shared span of that length. Each meeting
is extended to the windows of `span` words that hold the fingerprint (at most w of them), and those are joined with the
windows of items by a 128-bit digest: what comes out of that join are hits alone, however common a fingerprint
is. Everything is built from DataFrame functions.

Items shorter than `span` have one window, the whole item: for each length that occurs (fewer than `span`
lengths) all grams of that length are fingerprints, beside those of the long items.

Scale: fingerprints of long items are a fifth of the words; equal windows of many items are one row of 16 bytes. If
fingerprints and windows number at most `BROADCAST_ROWS` together (counted first) they are broadcast and texts never
move; otherwise hashes and digests alone are shuffled, under salts, and only texts that meet a fingerprint are cut into words
again. Documents that hold a very common fingerprint or window never meet in one task.

Edge cases: null texts (and items) have no words; items without words never occur; repeated documents with
one doc_id are judged as one (their words counted once per row: rows are keyed by doc_id and a digest of the text);
several items with one id count once; an empty table on either side gives no hits; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, freed_shuffles, hot_keys, join_hot, row_key, settle, text_of, work_dir

SPAN = 13
GRAM = 5
BROADCAST_ROWS = 600_000
SALTS = 16


class Shape(NamedTuple):
    """span: words of a window; k: words of a k-gram; w: k-grams of a winnowing window."""

    span: int
    k: int
    w: int


def _at(array: Column, i: Column) -> Column:
    return F.get(array, i)


def least_in_windows(grams: Column, w: int) -> Column:
    """Least hash of each window of w k-grams (one window of all, if they are fewer)."""
    if w == 1:
        return grams
    last = F.greatest(F.size(grams) - w, F.lit(0))
    starts = F.when(F.size(grams) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.least(*(_at(grams, s + j) for j in range(w))))


def shapes_for(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> list[Shape]:
    """The shape of the long items and one for each length of shorter ones; items has words."""
    lengths = [r[0] for r in items.where(F.size("words") > 0).select(F.least(F.size("words"), F.lit(span))).distinct().collect()]
    k = min(gram, span)
    return [Shape(span, k, span - k + 1) if n == span else Shape(n, n, 1) for n in sorted(lengths, reverse=True)]


def _grams(hashes: Column, shape: Shape) -> Column:
    places = F.when(F.size(hashes) >= shape.k, F.sequence(F.lit(0), F.size(hashes) - shape.k)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.lit(shape.span), *(_at(hashes, i + j) for j in range(shape.k))))


def with_fingerprints(rows: DataFrame, shapes: list[Shape]) -> DataFrame:
    """rows has words; adds, for each shape, grams_<span> (hash of the k-gram at each place) and kept (the distinct
    fingerprints of all shapes)."""
    rows = rows.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    for shape in shapes:
        rows = rows.withColumn(f"grams_{shape.span}", _grams(F.col("hashes"), shape))
    kept = [F.array_distinct(least_in_windows(F.col(f"grams_{s.span}"), s.w)) for s in shapes]
    return rows.drop("hashes").withColumn("kept", F.concat(*kept) if kept else F.array().cast("array<bigint>"))


def _by_span(span: str, shapes: list[Shape], value) -> Column:
    """value(shape) of the shape that the column `span` names."""
    chosen = F.when(F.lit(False), value(shapes[0]))
    for shape in shapes:
        chosen = chosen.when(F.col(span) == shape.span, value(shape))
    return chosen


def windows(met: DataFrame, shapes: list[Shape], keys: list[str]) -> DataFrame:
    """(*keys, span, hash, first, window): one row for each window of `span` words that holds the fingerprint `hash` of
    its shape, by its first word's place and digest. A row whose hash is null stays one row."""
    reach = _by_span("span", shapes, lambda s: F.lit(s.span - s.k))
    grams = _by_span("span", shapes, lambda s: F.col(f"grams_{s.span}"))
    # where a hash is found in another shape's grams there are no places
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(grams), F.lit(1)) - 1), lambda i: _at(grams, i) == F.col("hash"))
    around = lambda i: F.sequence(F.greatest(i - reach, F.lit(0)), F.least(i, F.size("words") - F.col("span")))
    no_places = F.array().cast("array<int>")
    starts = F.when(F.size("words") >= F.col("span"), F.array_distinct(F.flatten(F.transform(places, around)))).otherwise(no_places)
    starts = F.when(F.col("hash").isNull(), F.array(F.lit(None).cast("int"))).otherwise(starts)
    out = met.select(*keys, "words", "span", "hash", F.explode(starts).alias("first"))
    return out.select(*keys, "span", "hash", "first", F.unhex(F.md5(F.encode(F.array_join(F.slice("words", F.col("first") + 1, F.col("span")), " "), "UTF-8"))).alias("window"))


def windows_of(items: DataFrame, shapes: list[Shape], work: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prints, known, named): the fingerprints (hash, span) of items, their windows, each once, and (window, item_id)."""
    marked = with_fingerprints(items, shapes)
    mine = F.explode(F.array(*(F.struct(F.lit(s.span).alias("span"), F.array_distinct(least_in_windows(F.col(f"grams_{s.span}"), s.w)).alias("hashes")) for s in shapes)))
    marked = marked.withColumn("x", mine).where(F.col("x.span") == F.least(F.size("words"), F.lit(max(s.span for s in shapes)))).withColumn("span", F.col("x.span"))
    found = settle(windows(marked.withColumn("hash", F.explode("x.hashes")), shapes, ["item_id"]), f"{work}/item_windows")
    prints = settle(found.select("hash", "span").distinct(), f"{work}/prints")
    return prints, settle(found.select("window").distinct(), f"{work}/known"), settle(found.select("window", "item_id").distinct(), f"{work}/named")


def hits(docs: DataFrame, items: DataFrame, work: str, span: int = SPAN, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, spans, named): sizes has row_key, doc_id, n_words of each document; spans has row_key, window,
    first, last (past the end): document words that are an item's window; named has window, item_id."""
    with freed_shuffles(docs.sparkSession):
        return _hits(docs, items, work, span, broadcast_rows)


def _hits(docs: DataFrame, items: DataFrame, work: str, span: int, broadcast_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    items = settle(items.select(F.col("item_id").cast("string").alias("item_id"), ascii_words(text_of()).alias("words")), f"{work}/items")
    shapes = shapes_for(items, span)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("row_key", row_key())
    rows = texts.select("row_key", "doc_id", ascii_words(F.col("text")).alias("words"))
    sizes = rows.select("row_key", "doc_id", F.size("words").cast("long").alias("n_words"))
    if not shapes:
        spark = docs.sparkSession
        return settle(sizes, f"{work}/sizes"), spark.createDataFrame([], "row_key binary, window binary, first int, last int"), spark.createDataFrame([], "window binary, item_id string")
    prints, known, named = windows_of(items, shapes, work)
    few = prints.count() + known.count() <= broadcast_rows

    if few:
        marked = with_fingerprints(rows.withColumn("n_words", F.size("words").cast("long")), shapes)
        # outer, as for an inner explode Spark tests the array's size below it, where it computes the array anew;
        # one more entry, null, carries each document's size through the same pass
        every = marked.withColumn("hash", F.explode_outer(F.array_append("kept", F.lit(None).cast("long"))))
        met = every.join(F.broadcast(prints), "hash", "left").where(F.col("span").isNotNull() | F.col("hash").isNull())
        cut = settle(windows(met, shapes, ["row_key", "doc_id", "n_words"]), f"{work}/seeds")
        sizes, cut = cut.where(F.col("hash").isNull()).select("row_key", "doc_id", "n_words"), cut.where(F.col("hash").isNotNull())
    else:
        sizes = settle(sizes, f"{work}/sizes")
        slim = with_fingerprints(rows, shapes).select("row_key", F.explode_outer("kept").alias("hash")).where(F.col("hash").isNotNull())
        slim = slim.withColumn("salt", F.pmod(F.hash("row_key"), F.lit(SALTS)))
        salted = prints.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
        met = slim.join(salted, ["hash", "salt"]).groupBy("row_key").agg(F.collect_set(F.struct("hash", "span")).alias("found"))
        met = settle(met, f"{work}/met")
        again = texts.dropDuplicates(["row_key"]) if _repeats(sizes) else texts
        again = again.join(met, "row_key").select("row_key", ascii_words(F.col("text")).alias("words"), "found")
        again = with_fingerprints(again, shapes).withColumn("one", F.explode("found")).withColumns({"hash": F.col("one.hash"), "span": F.col("one.span")})
        cut = settle(windows(again, shapes, ["row_key"]), f"{work}/seeds")
    cut = cut.select("row_key", "window", "first", (F.col("first") + F.col("span")).alias("last"))
    found = cut.join(F.broadcast(known), "window", "left_semi") if few else join_hot(cut, known, "window", None, hot_keys(cut, "window", f"{work}/hot_windows"))
    return sizes, settle(found, f"{work}/spans"), named


def _repeats(sizes: DataFrame) -> bool:
    return sizes.count() > sizes.select("row_key").distinct().count()


def judged(sizes: DataFrame, spans: DataFrame, named: DataFrame, work: str) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    met = spans.select("row_key", "window").distinct().join(named, "window").select("row_key", "item_id").distinct()
    items = met.groupBy("row_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    widest = spans.groupBy("row_key", "first").agg(F.max("last").alias("last"))
    runs = widest.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, r: F.struct(F.greatest(acc["end"], r["last"]).alias("end"), (acc["n"] + F.greatest(r["last"] - F.greatest(acc["end"], r["first"]), F.lit(0))).alias("n"))
    covered = runs.select("row_key", F.aggregate("runs", start, step)["n"].alias("n_hit"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    verdicts = settle(covered.join(items, "row_key"), f"{work}/verdicts")
    out = join_hot(sizes, verdicts, "row_key", None, hot_keys(sizes, "row_key", f"{work}/hot"), "left")
    return out.select(
        "row_key",
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(items_of, ","), "UTF-8"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The verdict of each row of docs (doc_id, text) against items (item_id, text), with its row_key."""
    work = work_dir(docs.sparkSession, "winnow")
    with freed_shuffles(docs.sparkSession):
        return judged(*hits(docs, items, work, span, broadcast_rows), work)


def clean(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """docs without the rows that items contaminate; repeated rows go or stay together."""
    bad = decontaminate(docs, items, span).where("contaminated").select(F.col("row_key").alias("winnow_key")).distinct()
    bad = settle(bad, f"{work_dir(docs.sparkSession, 'contaminated')}/rows")
    return docs.join(bad, row_key() == F.col("winnow_key"), "left_anti")


def op5_winnowing(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontaminate(docs, items).drop("row_key")


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, m, p, array_to_string(w[p:p + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, greatest(len(w) - m + 2, 1))) AS p FROM d, (SELECT DISTINCT m FROM bw))
), met AS (
  SELECT doc_id, item_id, p, m FROM places JOIN bw USING (m, g)
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM met) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM met) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
