"""Mixing sources to target weights by weighted fair queueing.

Each source has a weight; targets share all words by weight, and a source whose target is above `MOST_TIMES`
its size is held there, the rest shared anew. The documents of a source queue in the order of a hash; a
document's virtual finish time is its source's words up to and with it, over the source's target. A source
whose target exceeds its size queues its documents again and again. All entries are put in the order of
their finish times and taken until the total budget is used up, so that at any moment each source has
given its share.

Scale: only (doc_id, source, size, hash) rows are shuffled. Running sums are made in two levels: sums per
slice of the order, a running sum over the slices, then a running sum within each slice. Slices are cut
by hash (within a source) and by finish time (over all), each of about `SLICE` rows whatever the source, so
a source with a third of all rows has many slices; slices are summed the same way in shelves of SLICE slices, so the one
task that sums shelves has a row for 16 million documents. The loop that holds targets down runs on the table of
sources and moves three numbers a round to the driver. Numbering the sources is one task with a row per source.

Edge cases: null texts have size 0 and are never taken; a null source is a source of its own, the last;
repeated rows are entries of their own (equal doc_ids are ordered by a hash of the text); sources without
words have target 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK_FREE, freed_shuffles, settle, text_of, work_dir

WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
#: Rows of a slice of a running sum, about.
SLICE = 4096
SEED = "mix-1"


def _draw(seed: str) -> Column:
    """What orders the documents of a source: a hash of doc_id and text."""
    text = F.md5(F.encode(text_of(), "UTF-8"))
    return F.md5(F.encode(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text), "UTF-8"))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, draw): draw orders the documents of a source."""
    size = F.regexp_count(text_of(), F.lit(BLANK_FREE)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), _draw(seed).alias("draw"))


def targets(rows: DataFrame, work: str, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, source_rows, largest, target) of each source of rows; weights go round by code point."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"), F.max("size").alias("largest"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    sources = settle(sources.withColumns({"weight": weight, "most": F.col("source_size") * most_times}), f"{work}/sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    held_words, held_weight, n_held = 0, 0, 0
    all_weight = sources.agg(F.sum("weight")).first()[0] or 0
    share = lambda: (F.lit(total - held_words) * F.col("weight")).cast("double") / F.lit(float(max(1, all_weight - held_weight)))
    while True:
        # a source that was held stays held, as the level only rises
        over = sources.where(share() > F.col("most")).agg(F.coalesce(F.sum("most"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0)), F.count(F.lit(1))).first()
        if over[2] == n_held:
            break
        held_words, held_weight, n_held = over
    target = F.when(share() > F.col("most"), F.col("most").cast("double")).otherwise(share())
    return sources.select("source", "source_size", "source_rows", "largest", target.alias("target"))


def _running(rows: DataFrame, group: list[str], slice_col: str, order: list, value: str, out: str) -> DataFrame:
    """Adds out, the sum of value up to and with each row in the order of (slice_col, order) within group."""
    sums = rows.groupBy(*group, slice_col).agg(F.sum(value).alias("slice_sum")).withColumn("shelf", F.floor(F.col(slice_col) / F.lit(float(SLICE))).cast("long"))
    ahead = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    shelves = sums.groupBy(*group, "shelf").agg(F.sum("slice_sum").alias("shelf_sum"))
    shelves = shelves.select(*group, "shelf", F.coalesce(F.sum("shelf_sum").over(ahead(*group).orderBy("shelf")), F.lit(0)).alias("shelf_base"))
    base = F.col("shelf_base") + F.coalesce(F.sum("slice_sum").over(ahead(*group, "shelf").orderBy(slice_col)), F.lit(0))
    sums = sums.join(shelves, [*group, "shelf"]).select(*group, slice_col, base.alias("base"))
    within = Window.partitionBy(*group, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("part", F.sum(value).over(within)).join(sums, [*group, slice_col]).select(*rows.columns, (F.col("base") + F.col("part")).alias(out))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES, seed: str = SEED) -> DataFrame:
    """(doc_id, source, draw, size, source_size, target, copies): copies is how often the mix takes a row."""
    work = work_dir(docs.sparkSession, "mix")
    with freed_shuffles(docs.sparkSession):
        return _mix(docs, work, weights, most_times, seed)


def _mix(docs: DataFrame, work: str, weights: tuple[int, ...], most_times: int, seed: str) -> DataFrame:
    rows = settle(sized(docs, seed), f"{work}/sized")
    goal = targets(rows, work, weights, most_times)
    # sources are numbered so that joins and windows have no null key
    goal = settle(goal.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")), f"{work}/targets")
    draw = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    goal = goal.withColumnRenamed("source", "source_name")
    rows = rows.join(goal, F.col("source").eqNullSafe(F.col("source_name"))).drop("source_name", "largest")
    rows = rows.withColumn("slice", F.floor(draw / F.lit(float(1 << 32)) * F.ceil(F.col("source_rows") / F.lit(float(SLICE)))).cast("long"))
    queued = _running(rows, ["source_no"], "slice", ["draw", "doc_id"], "size", "words")
    queued = settle(queued, f"{work}/queued")
    totals = goal.agg(F.sum("source_size"), F.sum("source_rows"), F.max(F.try_divide(F.col("largest"), F.col("target")))).first()
    budget, n_slices = totals[0] or 0, max(1, (totals[1] or 0) // SLICE)
    rounds = F.greatest(F.ceil(F.col("target") / F.greatest("source_size", F.lit(1))).cast("int"), F.lit(1))
    entries = queued.where("size > 0").withColumn("again", F.explode(F.sequence(F.lit(0), rounds - 1)))
    finish = F.try_divide((F.col("again") * F.col("source_size") + F.col("words")).cast("double"), F.col("target"))
    # at that time every source has had its target, so the budget is used up
    over = 1 + (totals[2] or 0.0)
    entries = entries.withColumn("finish", finish).where(F.col("finish") <= over).withColumn("slice", F.floor(F.col("finish") * n_slices).cast("long"))
    taken = _running(entries, [], "slice", ["finish", "source_no", "draw", "doc_id", "again"], "size", "used").where(F.col("used") <= budget)
    keys = ["source_no", "draw", "doc_id", "words"]
    counts = taken.groupBy(keys).agg(F.count(F.lit(1)).alias("copies")).withColumnsRenamed({k: f"taken_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"taken_{k}")) for k in keys]
    return queued.join(counts, same, "left").select("doc_id", "source", "draw", "size", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"))


def mixed_rows(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The rows of docs as often as the mix takes them.

    Rows that agree in doc_id, text and source share what the mix takes of them; if they differ in other columns, each kind
    gets its part by their number, and what doesn't divide goes to kinds by a hash. Columns have to be comparable."""
    work = work_dir(docs.sparkSession, "mixed")
    key = F.unhex(F.md5(F.encode(F.concat_ws(":", F.col("mix_draw"), F.coalesce(F.hex(F.encode("source", "UTF-8")), F.lit("null"))), "UTF-8")))
    taken = mix(docs, seed=seed).withColumnRenamed("draw", "mix_draw").select(key.alias("mix_key"), "copies")
    # all rows of a key count, taken or not
    chosen = taken.groupBy("mix_key").agg(F.sum("copies").alias("mix_copies"), F.count(F.lit(1)).alias("mix_rows")).where("mix_copies > 0")
    chosen = settle(chosen, f"{work}/chosen")
    keyed = docs.withColumn("mix_draw", _draw(seed)).withColumn("mix_key", key).drop("mix_draw")
    single = keyed.join(chosen.where("mix_rows = 1").select("mix_key", F.col("mix_copies").alias("mix_each")), "mix_key")
    # equal rows are counted before they meet, so a row repeated very often is one of few
    several = chosen.where("mix_rows > 1")
    kinds = keyed.join(several.select("mix_key"), "mix_key", "left_semi").groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("mix_n")).join(several, "mix_key")
    order = Window.partitionBy("mix_key").orderBy(F.xxhash64(*docs.columns), *docs.columns).rowsBetween(Window.unboundedPreceding, -1)
    kinds = kinds.withColumn("mix_before", F.coalesce(F.sum("mix_n").over(order), F.lit(0)))
    spare = F.greatest(F.least(F.expr("mix_copies % mix_rows") - F.col("mix_before"), F.col("mix_n")), F.lit(0))
    kinds = kinds.withColumn("mix_each", F.expr("mix_copies div mix_rows") * F.col("mix_n") + spare).where("mix_each > 0")
    rows = single.unionByName(kinds.select(*single.columns))
    # in two steps, so that no array is long
    rows = rows.withColumn("mix_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(mix_each - 1) div {SLICE}"))))
    in_lot = F.least(F.col("mix_each") - F.col("mix_lot") * SLICE, F.lit(SLICE).cast("long"))
    return rows.withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), in_lot))).select(docs.columns)


def op7_fair_mix(spark, sf_dir: str) -> DataFrame:
    chosen = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS draw
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS BIGINT) AS most,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS source_no
  FROM d GROUP BY source
), levels AS (
  SELECT 0 AS k, CAST(0 AS BIGINT) AS held, CAST(0 AS BIGINT) AS held_weight, CAST(-1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_now
  UNION ALL
  SELECT k + 1, x.held, x.held_weight, l.n_now, x.n FROM levels l, LATERAL (
    SELECT CAST(coalesce(sum(most), 0) AS BIGINT) AS held, CAST(coalesce(sum(weight), 0) AS BIGINT) AS held_weight, count(*) AS n FROM s
    WHERE CAST(((SELECT sum(source_size) FROM s) - l.held) * weight AS DOUBLE) / greatest(1, (SELECT sum(weight) FROM s) - l.held_weight) > most
  ) x WHERE l.n <> l.n_now
), level AS (SELECT * FROM levels ORDER BY k DESC LIMIT 1), t AS (
  SELECT s.*, least(CAST(most AS DOUBLE), CAST(((SELECT sum(source_size) FROM s) - held) * weight AS DOUBLE) / greatest(1, (SELECT sum(weight) FROM s) - held_weight)) AS target FROM s, level
), q AS (
  SELECT d.*, source_no, source_size, target, CAST(sum(size) OVER (PARTITION BY source_no ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS words
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT q.*, again, CAST(again * source_size + words AS DOUBLE) / target AS finish
  FROM (SELECT *, unnest(range(0, CAST(greatest(1, ceil(target / greatest(source_size, 1))) AS BIGINT))) AS again FROM q WHERE size > 0) q
), u AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source_no, draw, doc_id, again ROWS UNBOUNDED PRECEDING) AS used FROM e
), c AS (
  SELECT source_no, draw, doc_id, words, count(*) AS copies FROM u WHERE used <= (SELECT sum(source_size) FROM s) GROUP BY ALL
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(copies, 0) AS BIGINT) AS taken
FROM q LEFT JOIN c USING (source_no, draw, doc_id, words)
"""
