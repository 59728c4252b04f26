"""SimHash near-duplicates by multi-index hashing.

Each text has a 64-bit fingerprint: bit i is set if more than half of its 4-word shingles have bit i set in
their hash. Fingerprints link at `DISTANCE` or fewer differing bits. The 64 bits are cut into segments
(`segments_for`), each with a radius; radii and segments add up to distance + 1, so two fingerprints that link
lie within the radius in one segment at least. So every fingerprint is filed once under each segment's
value, and looked up under all values of the small Hamming ball around each of its segments: 23 + 22 + 1
keys at distance 4. Matches are verified over all 64 bits inside the join. Linked fingerprints form
components, found by alternating large-star and small-star rounds (Kiveris et al., 2014).

Scale: copies share a fingerprint and are one row from the start, so a group of copies has no pairs. With
three segments a key holds about distinct/2**21 fingerprints; beyond `MANY` distinct ones there are two
segments of 32 bits with wider balls (562 keys a fingerprint, 5.6e10 rows at 10**8 fingerprints). A segment's value that more
than HOT_ROWS fingerprints share is cut again: of the other bits, in distance + 1 pieces, one has to agree too. Rounds of components are written as tables, over links alone; nodes with very many
links are joined under salts, and so are fingerprints with very many documents.

Edge cases: null, empty and blank texts have fingerprint 0, which links like any other; texts of fewer
words than a shingle are one shingle; repeated rows give repeated equal results; null doc_ids are fingerprinted
and link but never name a component, so one of null doc_ids alone has a null component_id; texts that share a
doc_id stay apart; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import freed_shuffles, hot_keys, join_hot, row_key, settle, text_of, work_dir

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Distinct fingerprints up to which keys of three segments (21 bits) stay short lists.
MANY = 100_000_000

#: Beyond it the balls have many thousand keys.
MOST_DISTANCE = 8


class Segment(NamedTuple):
    """bits from bit `first` on; keys within `radius` differing bits are looked up."""

    first: int
    bits: int
    radius: int


def segments_for(distance: int, segments: int = 3) -> list[Segment]:
    """Segments for a complete search: radii and the number of segments add up to distance + 1."""
    if not 1 <= distance <= MOST_DISTANCE or segments < 2:
        raise ValueError(f"distance is from 1 to {MOST_DISTANCE}, and there are two segments at least")
    m = min(segments, distance + 1)
    ends = [-(-64 * k // m) for k in range(m + 1)]
    spare = distance + 1 - m
    return [Segment(a, b - a, spare // m + (k < spare % m)) for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]


def fingerprint(text: str | None) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - SHINGLE + 1
    if n < 2:
        hashes = [digest(line, SEED)]
    else:
        starts = [0]
        for word in words:
            starts.append(starts[-1] + len(word) + 1)
        hashes = [digest(line[a : b - 1], SEED) for a, b in zip(starts[:n], starts[SHINGLE:], strict=True)]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[at : at + (1 << 16)], "<u8")
        bits += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


_PRINTS = pa.schema([("doc_id", pa.int64()), ("tie", pa.binary()), ("fp", pa.int64())])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(values)], schema=_PRINTS)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, fp): tie is the row's key, fp the fingerprint as a signed 64-bit integer."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("tie"), text_of().alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, tie binary, fp long")


def _value(segment: Segment) -> Column:
    return F.shiftrightunsigned("fp", segment.first).bitwiseAND(F.lit((1 << segment.bits) - 1))


def _key(k: int, value: Column) -> Column:
    return F.struct(F.lit(k).alias("segment"), value.alias("value"))


def ball(bits: int, radius: int) -> list[int]:
    """All masks with at most `radius` of so many bits set."""
    masks = [0]
    for _ in range(radius):
        masks = sorted({m ^ (1 << b) for m in masks for b in range(bits)} | set(masks))
    return masks


def _asked(k: int, segment: Segment) -> Column:
    """All keys under which a fingerprint near in segment k is filed."""
    masks = F.array(*(F.lit(m).cast("long") for m in ball(segment.bits, segment.radius)))
    return F.transform(masks, lambda m: _key(k, _value(segment).bitwiseXOR(m)))


def _recut(segment: Segment, distance: int) -> Column:
    """The bits outside a segment in distance + 1 pieces, as structs (piece, piece_value): two fingerprints that link agree in
    one of them."""
    low = F.col("fp").bitwiseAND(F.lit((1 << segment.first) - 1))
    high = F.shiftleft(F.shiftrightunsigned("fp", segment.first + segment.bits), segment.first) if segment.first + segment.bits < 64 else F.lit(0).cast("long")
    rest, n = low.bitwiseOR(high), 64 - segment.bits
    ends = [n * k // (distance + 1) for k in range(distance + 2)]
    pieces = ((k, F.shiftrightunsigned(rest, a).bitwiseAND(F.lit((1 << (b - a)) - 1))) for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)))
    return F.array(*(F.struct(F.lit(k).alias("piece"), v.alias("piece_value")) for k, v in pieces))


def _by_piece(rows: DataFrame, cut: list[Segment], distance: int, fp: str) -> DataFrame:
    rows = rows.withColumn("fp", F.col(fp))
    pieces = F.when(F.col("segment") == 0, _recut(cut[0], distance))
    for k, segment in enumerate(cut[1:], 1):
        pieces = pieces.when(F.col("segment") == k, _recut(segment, distance))
    return rows.select(*rows.columns, F.inline(pieces)).drop("fp")


def links(nodes: DataFrame, distance: int = DISTANCE, segments: int = 3, work: str | None = None) -> DataFrame:
    """(a, b): the nodes (node, fp) with distinct fp whose fingerprints differ in 1 to `distance` bits."""
    cut = segments_for(distance, segments)
    work = work_dir(nodes.sparkSession, "links") if work is None else work
    filed = nodes.select("node", "fp", F.inline(F.array(*(_key(k, _value(s)) for k, s in enumerate(cut)))))
    asked = F.concat(*(_asked(k, s) for k, s in enumerate(cut)))
    queries = nodes.select(F.col("node").alias("a"), F.col("fp").alias("fp_a"), F.inline(asked))
    filed = filed.select(F.col("node").alias("b"), F.col("fp").alias("fp_b"), "segment", "value")
    near = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= distance
    key = ["segment", "value"]

    def matched(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
        return left.join(right.select("b", "fp_b", *by), by).where((F.col("fp_a") < F.col("fp_b")) & near).select("a", "b")

    # values that very many fingerprints share (those of short or alike texts) are met by a further piece of bits
    hot = settle(filed.groupBy(*key).count().where(F.col("count") > common.HOT_ROWS).select(*key), f"{work}/hot_values")
    if hot.isEmpty():
        return matched(queries, filed, key).distinct()
    usual = matched(queries.join(hot, key, "left_anti"), filed.join(hot, key, "left_anti"), key)
    pieces = [_by_piece(rows.join(hot, key, "left_semi"), cut, distance, fp) for rows, fp in ((queries, "fp_a"), (filed, "fp_b"))]
    return usual.unionByName(matched(*pieces, [*key, "piece", "piece_value"])).distinct()


def components(edges: DataFrame, work: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node of each connected component of edges (a, b)."""
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{work}/edges-0")

    def to_least(rows: DataFrame, least: DataFrame, path: str) -> DataFrame:
        """rows (a, b) with m, the least neighbour of a; least also has the number of neighbours, n."""
        least = settle(least, path)
        return join_hot(rows, least.select("a", "m"), "a", "b", least.where(F.col("n") > common.HOT_ROWS).select("a"))

    for k in range(1, max_rounds + 1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = to_least(both.where("b > a"), least, f"{work}/least-{k}").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settle(large, f"{work}/large-{k}")
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = to_least(large, least, f"{work}/smallest-{k}").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = settle(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), f"{work}/edges-{k}")
        stars = small.join(small.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty()
        edges = small
        if stars and small.groupBy("a").count().where("count > 1").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")


def _members(prints: DataFrame, distance: int, work: str) -> DataFrame:
    """(fp, component, first): of each fingerprint the least one it is linked to, and the first row of that component,
    a struct (anonymous, doc_id, tie) by doc_id, nulls last, and key of the row. Fingerprints are the nodes."""
    row = F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", "tie")
    nodes = settle(prints.groupBy("fp").agg(F.min(row).alias("first")), f"{work}/nodes")
    found = components(links(nodes.select(F.col("fp").alias("node"), "fp"), distance, 3 if nodes.count() <= MANY else 2, work), work)
    # components' own nodes are not among the nodes found
    found = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct()).distinct()
    linked = settle(nodes.join(found.withColumnRenamed("node", "fp"), "fp").select("fp", "component", "first"), f"{work}/linked")
    best = linked.groupBy("component").agg(F.min("first").alias("best"))
    moved = linked.select("fp", "component").join(best, "component")
    return nodes.join(moved, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"), F.coalesce("best", "first").alias("first"))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id reachable over links."""
    spark, work = docs.sparkSession, work_dir(docs.sparkSession, "simhash")
    with freed_shuffles(spark):
        prints = settle(fingerprints(docs), f"{work}/prints")
        named = settle(_members(prints, distance, work).select("fp", F.col("first.doc_id").alias("component_id")), f"{work}/named")
        hot = hot_keys(prints, "fp", f"{work}/hot")
    return join_hot(prints, named, "fp", None, hot).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """docs without near-duplicates: of each component the row with its least doc_id stays, nulls last, then that
    with the least key of doc_id and text; one if repeated. Texts are shuffled once, by that key."""
    spark, work = docs.sparkSession, work_dir(docs.sparkSession, "simhash")
    with freed_shuffles(spark):
        prints = settle(fingerprints(docs), f"{work}/prints")
        kept = settle(_members(prints, distance, work).select("component", "first").distinct().select(F.col("first.tie").alias("simhash_key")), f"{work}/kept")
    rows = docs.withColumn("simhash_key", row_key()).join(kept, "simhash_key", "left_semi")
    once = F.row_number().over(Window.partitionBy("simhash_key").orderBy("simhash_key"))
    return rows.withColumn("simhash_no", once).where("simhash_no = 1").select(docs.columns)


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
