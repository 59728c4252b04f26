"""Vector code compression: product codes whose codebooks come from Lloyd rounds over cover trees.

Components become the integers floor(256 * x), vectors are cut into `PARTS` equal parts, and each part position has
a codebook that starts as that part of the `ENTRIES` vectors with the least vec_id. A task cuts its vectors into
blocks of at most `BLOCK` and builds, for each block and part position, a cover tree: below a node of level l lie
points within 2**l of its centre, and the centres of its children are more than 2**(l-1) apart. Points are kept
in the order of the tree, so a subtree is a slice and its sum the difference of two cumulative sums.

A round goes down all trees of a block at once. A node whose centre's nearest entry is nearer than the second by
more than twice the node's radius gives its whole subtree to that entry (by the triangle inequality no point of it can be
nearer to another); other nodes pass the question to their children, and the points of ambiguous leaves are compared
exactly, in integers, ties to the lower index. Entries that equal an earlier one are never chosen.

Scale: trees are built once, written as a table (a row a block) and read by each round; what leaves a task
is one sum and count for each part and entry, added up by a grouping. The driver holds the codebooks alone: PARTS x
ENTRIES entries. Memory in a task is one block. Errors by label are partial sums, joined back under salts.

Edge cases: vectors that are null or hold null or non-finite components go; an empty table (or one without kept rows)
gives an empty result. Shorter vectors are filled up with zeros to the length of the longest, rounded up to a
multiple of PARTS; an empty vector is all zeros. Repeated rows are rows of their own; of several vectors under one vec_id the
least starts a codebook, once; a null vec_id comes after all others. Fewer than ENTRIES ids give smaller codebooks.
Components of more than 2**24 in size are computed in unbounded integers, and error and label_error stop at
the largest long. Null labels are one label. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed_shuffles, hot_keys, join_hot, settle, work_dir

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors of one tree at most.
BLOCK = 4096
#: A node with no more points is a leaf.
LEAF = 8
#: Components up to this size keep all sums of squares and of a block's points in 64 bits.
SMALL = 1 << 24
_LONG = (1 << 63) - 1
_NODE = np.dtype([("centre", "<i4"), ("start", "<i4"), ("end", "<i4"), ("child", "<i4"), ("children", "<i4"), ("radius", "<f8")])


class Tree(NamedTuple):
    """order lists the points; node k has points order[start:end] and nodes child .. child + children - 1 below it."""

    order: np.ndarray
    nodes: np.ndarray


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def _roots(squares: np.ndarray) -> np.ndarray:
    if squares.dtype != object:
        return np.sqrt(squares.astype(np.float64))
    # past the range of doubles all distances look alike, and their points are compared exactly
    return np.array([math.sqrt(min(x, 10**300)) for x in squares.ravel().tolist()], np.float64).reshape(squares.shape)


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b."""
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]


def _net(points: np.ndarray, members: np.ndarray, centre: int, gap: float) -> list[tuple[int, np.ndarray, float]]:
    """(centre, members, radius) of each child: centres more than gap apart, the node's own first; each member goes to the
    first centre within gap."""
    found, rest = [], members
    while len(rest):
        head = centre if not found else int(rest[0])
        away = _roots(_squares(points[rest], points[head]))
        near = away <= gap
        found.append((head, rest[near], float(away[near].max())))
        rest = rest[~near]
    return found


def build(points: np.ndarray) -> Tree:
    """The cover tree of the rows of points (one at least), whose first row is the root's centre."""
    everything = np.arange(len(points))
    reach = float(_roots(_squares(points, points[0])).max())
    level = [(0, everything, reach)]
    nodes, order = [], np.empty(len(points), np.int32)
    # children take over their node's slice, so a node's own slice is known once its place among its siblings is
    starts, made = [0], 0
    while level:
        below, below_starts = [], []
        made += len(level)
        for (centre, members, radius), start in zip(level, starts, strict=True):
            order[start : start + len(members)] = members
            child, children = 0, 0
            if len(members) > LEAF and radius > 0:
                net = _net(points, members, centre, 2.0 ** (math.ceil(math.log2(radius)) - 1))
                child, children = made + len(below), len(net)
                at = start
                for part in net:
                    below.append(part)
                    below_starts.append(at)
                    at += len(part[1])
            nodes.append((centre, start, start + len(members), child, children, radius))
        level, starts = below, below_starts
    return Tree(order, np.array(nodes, _NODE))


def _firsts(book: np.ndarray) -> np.ndarray:
    """Indexes of the entries that equal no earlier one."""
    seen: set[tuple] = set()
    return np.array([k for k, e in enumerate(map(tuple, book.tolist())) if not (e in seen or seen.add(e))])


def assign(points: np.ndarray, tree: Tree, book: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]], int]:
    """(codes, slices, compared): the entry of each point; (start, end, entry) of the subtrees given as a whole; and
    how many points were compared one by one."""
    codes, slices, compared = np.empty(len(points), np.int32), [], 0
    names = _firsts(book)
    book = book[names]
    front = np.array([0])
    while len(front):
        nodes = tree.nodes[front]
        squares = _between(points[nodes["centre"]], book)
        best = squares.argmin(axis=1)
        roots = _roots(squares)
        first = roots[np.arange(len(front)), best]
        roots[np.arange(len(front)), best] = np.inf
        margin = roots.min(axis=1) - first
        # rounding of roots and radii stays far below this
        sure = (margin > 2 * nodes["radius"] + 1e-9 * (1 + first + nodes["radius"])) | (nodes["radius"] == 0)
        for node, entry in zip(nodes[sure], names[best[sure]], strict=True):
            codes[tree.order[node["start"] : node["end"]]] = entry
            slices.append((int(node["start"]), int(node["end"]), int(entry)))
        open_ = nodes[~sure]
        leaves = open_[open_["children"] == 0]
        if len(leaves):
            places = np.concatenate([np.arange(a, b) for a, b in zip(leaves["start"], leaves["end"], strict=True)])
            some = tree.order[places]
            chosen = names[_between(points[some], book).argmin(axis=1)]
            codes[some] = chosen
            slices += [(int(p), int(p) + 1, int(e)) for p, e in zip(places, chosen, strict=True)]
            compared += len(some)
        inner = open_[open_["children"] > 0]
        front = np.concatenate([np.arange(a, a + n) for a, n in zip(inner["child"], inner["children"], strict=True)]) if len(inner) else np.array([], int)
    return codes, slices, compared


def sums_of(points: np.ndarray, tree: Tree, slices: list[tuple[int, int, int]], entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of the points of each entry, from cumulative sums along the tree's order."""
    width = points.shape[1]
    running = np.concatenate([np.zeros((1, width), points.dtype), np.cumsum(points[tree.order], axis=0)])
    sums, counts = np.zeros((entries, width), points.dtype), np.zeros(entries, np.int64)
    start, end, entry = (np.array(x, np.int64) for x in zip(*slices, strict=True))
    np.add.at(sums, entry, running[end] - running[start])
    np.add.at(counts, entry, end - start)
    return sums, counts


def integers(vector, length: int) -> list[int]:
    """floor(256 * x) of each component, zeros up to length."""
    ratios = (float(x).as_integer_ratio() for x in vector)
    return [*(SCALE * n // d for n, d in ratios), *[0] * (length - len(vector))]


def _matrix(rows: list, length: int) -> np.ndarray:
    """Integer components of vectors; Python integers where 64 bits may not hold what is computed from them."""
    lengths = {len(r) for r in rows}
    if lengths == {length}:
        scaled = np.floor(SCALE * np.array(rows, np.float64))
        if not scaled.size or np.abs(scaled).max() <= SMALL:
            return scaled.astype(np.int64)
    exact = [integers(r, length) for r in rows]
    small = all(abs(x) <= SMALL for r in exact for x in r)
    return np.array(exact, np.int64 if small else object).reshape(len(rows), length)


def _fits(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python integers if one of them is."""
    return (points, books) if points.dtype == books.dtype else (points.astype(object), books.astype(object))


def _packed(points: np.ndarray) -> bytes:
    return points.astype("<i4").tobytes() if points.dtype != object else ",".join(map(str, points.ravel().tolist())).encode()


def _unpacked(data: bytes, wide: bool, rows: int) -> np.ndarray:
    flat = np.array([int(x) for x in data.decode().split(",")], object) if wide else np.frombuffer(data, "<i4").astype(np.int64)
    return flat.reshape(rows, -1)


_FOREST = "ids array<long>, labels array<string>, wide boolean, points binary, orders array<binary>, nodes array<binary>"
_FOREST_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("wide", pa.bool_()), ("points", pa.binary()), ("orders", pa.list_(pa.binary())), ("nodes", pa.list_(pa.binary()))])


def _parts(points: np.ndarray) -> list[np.ndarray]:
    return np.split(points, PARTS, axis=1)


def forest(vectors: DataFrame, length: int, block: int = BLOCK) -> DataFrame:
    """A row for each block of vectors (vec_id, label_key, embedding): its points and the trees of all part positions."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        labels: list = []
        rows: list = []

        def grown() -> pa.RecordBatch:
            points = _matrix(rows[:block], length)
            trees = [build(p) for p in _parts(points)]
            wide = points.dtype == object
            columns = [[ids[:block]], [labels[:block]], [wide], [_packed(points)], [[t.order.astype("<i4").tobytes() for t in trees]], [[t.nodes.tobytes() for t in trees]]]
            del ids[:block], labels[:block], rows[:block]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOREST_ARROW, strict=True)], schema=_FOREST_ARROW)

        for batch in batches:
            for k in range(0, batch.num_rows, block):
                some = batch.slice(k, block)
                ids += some.column(0).to_pylist()
                labels += some.column(1).to_pylist()
                rows += some.column(2).to_pylist()
                while len(rows) >= block:
                    yield grown()
        if rows:
            yield grown()

    return vectors.select("vec_id", "label_key", "embedding").mapInArrow(plant, _FOREST)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[np.ndarray], list[Tree]]]:
    """(ids, labels, points by part, trees) of each row of a forest."""
    for batch in batches:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            points = _unpacked(r["points"], r["wide"], len(r["ids"]))
            trees = [Tree(np.frombuffer(o, "<i4"), np.frombuffer(n, _NODE)) for o, n in zip(r["orders"], r["nodes"], strict=True)]
            yield r["ids"], r["labels"], _parts(points), trees


#: Sums leave a task in digits to this base, each with the sum's sign: one, but for very large components.
_BASE = 10**18


def _digits(total: int) -> list[int]:
    sign, rest, out = (1 if total >= 0 else -1), abs(total), []
    while rest or not out:
        out.append(sign * (rest % _BASE))
        rest //= _BASE
    return out


def partial_sums(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, at, place, digit, n): for each block, part position and used entry the sum of its points by component."""
    entries = books.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, parts, grown in _blocks(batches):
            rows = []
            for p, (points, tree) in enumerate(zip(parts, grown, strict=True)):
                points, book = _fits(points, books[p])
                sums, counts = sums_of(points, tree, assign(points, tree, book)[1], entries)
                for e in np.flatnonzero(counts).tolist():
                    for k, total in enumerate(sums[e].tolist()):
                        rows += [(p, e, k, place, digit, int(counts[e])) for place, digit in enumerate(_digits(total))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["part", "entry", "at", "place", "digit", "n"])

    return trees.mapInArrow(add, "part long, entry long, at long, place long, digit long, n long")


def _round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round; unused entries stay."""
    keys = ["part", "entry", "at"]
    added = partial_sums(trees, books).groupBy(*keys, "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit"), F.sum("n").alias("n"))
    sums: dict[tuple, list[int]] = {}
    for r in added.collect():
        got = sums.setdefault(tuple(r[k] for k in keys), [0, 0])
        got[0] += int(r["digit"]) * _BASE ** r["place"]
        # every block gives place 0
        got[1] += r["n"] if r["place"] == 0 else 0
    moved = books.astype(object)
    for (p, e, k), (total, n) in sums.items():
        moved[p, e, k] = total // n
    return moved if books.dtype == object or max(map(abs, moved.ravel().tolist()), default=0) > SMALL else moved.astype(np.int64)


def _first_vectors(vectors: DataFrame, entries: int) -> list:
    """The vectors of the least vec_ids, each once, null last: at most `entries` rows reach the driver at a time."""
    ids: list[int] = []
    while len(ids) < entries:
        rest = vectors.where(F.col("vec_id") > ids[-1]) if ids else vectors.where("vec_id IS NOT NULL")
        more = rest.select("vec_id").orderBy("vec_id").limit(entries).collect()
        if not more:
            break
        ids += sorted({r[0] for r in more})[: entries - len(ids)]
    chosen = F.col("vec_id").isin(ids) | (F.lit(len(ids) < entries) & F.col("vec_id").isNull())
    return vectors.where(chosen).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy(F.col("vec_id").asc_nulls_last()).collect()


class Codebooks(NamedTuple):
    """entries[part, entry, position]: the integer components."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def coded(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label_key, code, error) of each vector."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, parts, grown in _blocks(batches):
            chosen = np.empty((len(ids), PARTS), np.uint8)
            errors = np.zeros(len(ids), object)
            for p, (points, tree) in enumerate(zip(parts, grown, strict=True)):
                points, book = _fits(points, books[p])
                codes = assign(points, tree, book)[0]
                chosen[:, p] = codes
                errors = errors + _squares(points, book[codes]).astype(object)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array([r.tobytes().hex() for r in chosen]), pa.array([min(int(e), _LONG) for e in errors], pa.int64())],
                names=["vec_id", "label_key", "code", "error"],
            )

    return trees.mapInArrow(code, "vec_id long, label_key string, code string, error long")


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label_key, embedding as doubles) of the vectors that are whole and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.concat_ws("=", F.lit("label"), F.col("label").cast("string")).alias("label_key"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("embedding").isNotNull() & F.forall("embedding", finite))


def compress(embeddings: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label_key, code, error) of every kept row of embeddings (vec_id, embedding, label), and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    spark, work = embeddings.sparkSession, work_dir(embeddings.sparkSession, "cover")
    with freed_shuffles(spark):
        vectors = kept_vectors(embeddings)
        longest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
        length = max(1, -(-longest // PARTS)) * PARTS
        trees = settle(forest(vectors, length, block), f"{work}/forest")
        first = _first_vectors(vectors, entries)
        if not first:
            return spark.createDataFrame([], "vec_id long, label_key string, code string, error long"), Codebooks(np.zeros((PARTS, 0, length // PARTS), np.int64))
        books = np.stack(_parts(_matrix([r["embedding"] for r in first], length)))
        for _ in range(rounds):
            books = _round(trees, books)
        return settle(coded(trees, books), f"{work}/codes"), Codebooks(books)


def op13_cover_tree(spark, sf_dir: str) -> DataFrame:
    codes, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    work = work_dir(spark, "cover-labels")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    by_label = settle(codes.groupBy("label_key").agg(total.alias("label_error")), f"{work}/labels")
    out = join_hot(codes, by_label, "label_key", None, hot_keys(codes, "label_key", f"{work}/hot"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def sql() -> str:
    """The same rows from DuckDB: every part against every entry, for vectors of one length."""
    assigned = """a{k} AS (
  SELECT rid, p, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (
    SELECT x.rid, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM parts x JOIN b{k} b USING (p)
  ) GROUP BY rid, p
)"""
    moved = """b{n} AS (
  SELECT p, e, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY j) AS v FROM (
      SELECT p, e, j, (s - ((s % n) + n) % n) // n AS m FROM (
        SELECT a.p, a.e, j, sum(x.v[j])::BIGINT AS s, count(*) AS n FROM a{k} a JOIN parts x USING (rid, p), range(1, (SELECT any_value(len(v)) FROM parts) + 1) t(j) GROUP BY a.p, a.e, j
      )
    ) GROUP BY p, e
  ) m USING (p, e)
)"""
    ctes = [
        """kept AS (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"parts AS (SELECT rid, vec_id, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS v FROM kept, range({PARTS}) t(p))",
        f"b0 AS (SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < {ENTRIES})",
    ]
    for k in range(ROUNDS):
        ctes += [assigned.format(k=k), moved.format(k=k, n=k + 1)]
    ctes.append(assigned.format(k=ROUNDS))
    return (
        "WITH " + ",\n".join(ctes) + f""",
book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) AS digest FROM (SELECT p, e, unnest(v) AS c, generate_subscripts(v, 1) AS j FROM b{ROUNDS})),
codes AS (SELECT rid, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256 FROM codes JOIN kept USING (rid), book"""
    )
