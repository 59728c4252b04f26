"""Media columns: content-defined chunks, a deduplicated chunk store, ordered chunk lists.

A payload is cut where a rolling gear hash of its bytes hits a mask, so that an insertion moves only the
cuts near it. `ingest` writes recipes (a row per document: ordered chunk digests), finds by an aggregation
and a join of digests alone the chunks that several distinct payloads share, and writes a store with a row
per distinct payload: the frames of chunks that are its own, and, once for each digest, those of shared
chunks that it has first. A frame holds a chunk's 8-bit samples in Zstandard, which is lossless; frames share a
dictionary trained on about `SAMPLE_TEXTS` texts of at most `SAMPLE_BYTES` bytes, chosen by a hash.
`reconstruct` reads payloads without shared chunks straight from the store; for the others it joins the
references to shared chunks with their frames by digest and puts all frames of a payload in order. Each
payload is verified by its digest.

Scale: frames are shuffled once by payload, into the store, and once more only for payloads with shared
chunks. Digests and payloads with very many references are joined under a salt. A task holds one payload at a
time, as the input does.

Edge cases: a null text is an empty payload (64 zero bytes once padded); repeated rows give repeated equal
results; an empty table gives an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import freed_shuffles, hot_keys, join_hot, partitions, settle, text_of, work_dir

PAD = 64
#: Bytes kept of the SHA-256 that names a chunk or a payload.
NAME_BYTES = 16
LEVEL = 9
SAMPLE_TEXTS = 1500
SAMPLE_BYTES = 8192
DICTIONARY_BYTES = 1 << 18


class Cutter(NamedTuple):
    """Chunk sizes in bytes: at least `least`, at most `most`, a cut at every 2**bits bytes on average."""

    least: int = 256
    bits: int = 9
    most: int = 4096


def gear_table() -> np.ndarray:
    """256 pseudo-random 32-bit numbers, one per byte value, from a rule."""
    return np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "big") for b in range(256)], np.uint32)


def rolling_gear(data: bytes, table: np.ndarray) -> np.ndarray:
    """h[i] = 2 h[i-1] + table[data[i]] modulo 2**32, which depends on the last 32 bytes; by doubling."""
    h = table[np.frombuffer(data, np.uint8)]
    for shift in (1, 2, 4, 8, 16):
        if len(h) > shift:
            wider = h.copy()
            wider[shift:] += h[:-shift] << np.uint32(shift)
            h = wider
    return h


def cuts(data: bytes, cutter: Cutter, table: np.ndarray) -> list[int]:
    """Ends of the chunks of a payload that isn't empty."""
    n = len(data)
    if n <= cutter.least:
        return [n]
    marks = np.flatnonzero(rolling_gear(data, table) >> np.uint32(32 - cutter.bits) == 0) + 1
    ends, start = [], 0
    while n - start > cutter.least:
        k = int(np.searchsorted(marks, start + cutter.least))
        end = min(int(marks[k]) if k < len(marks) else n, start + cutter.most, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def padded(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % PAD or PAD * (not raw))


def name_of(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:NAME_BYTES]


_RECIPES = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("recipe_id", pa.binary()), ("digests", pa.list_(pa.binary()))])
#: frames are the frames of a payload, one after another, of these sizes.
_SEGMENTS = pa.schema([("recipe_id", pa.binary()), ("sizes", pa.list_(pa.int32())), ("frames", pa.binary())])
_OWN = pa.struct([("seq", pa.int32()), ("frame", pa.binary())])
_SHARED = pa.struct([("digest", pa.binary()), ("frame", pa.binary())])
_STORE = pa.schema([("recipe_id", pa.binary()), ("n_chunks", pa.int32()), ("own", pa.list_(_OWN)), ("shared", pa.list_(_SHARED))])
_STORE_SQL = "recipe_id binary, n_chunks int, own array<struct<seq:int,frame:binary>>, shared array<struct<digest:binary,frame:binary>>"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema.types]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, schema.types, strict=True)], schema=schema)


def _pieces(data: bytes, cutter: Cutter, table: np.ndarray) -> list[bytes]:
    ends = cuts(data, cutter, table)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _recipes(batches: Iterator[pa.RecordBatch], cutter: Cutter) -> Iterator[pa.RecordBatch]:
    table = gear_table()
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = padded(text)
            rows.append((doc, len((text or "").encode("utf-8", "surrogatepass")), name_of(data), [name_of(c) for c in _pieces(data, cutter, table)]))
        yield _table(rows, _RECIPES)


def train_dictionary(docs: DataFrame) -> bytes:
    """Dictionary for the frames, from a bounded sample of distinct texts; empty if there is too little to train on."""
    import zstandard

    share = min(1.0, SAMPLE_TEXTS / max(1, docs.count()))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    # distinct, as all copies of a repeated row are drawn together
    sample = docs.where(draw < share).select(F.substring("text", 1, SAMPLE_BYTES).alias("head")).distinct()
    texts = sorted(r["head"].encode("utf-8", "surrogatepass")[:SAMPLE_BYTES] for r in sample.collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes() if texts else b""
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> dict:
    import zstandard

    return {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}


def _segments(batches: Iterator[pa.RecordBatch], cutter: Cutter, dictionary: bytes) -> Iterator[pa.RecordBatch]:
    """The frames of each payload that is new to the task."""
    import zstandard

    table, pack = gear_table(), zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_dict_id=False, **_dictionary(dictionary))
    seen: set[bytes] = set()
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            data = padded(text)
            name = name_of(data)
            if name not in seen:
                seen.add(name)
                frames = [pack.compress(c) for c in _pieces(data, cutter, table)]
                rows.append((name, [len(f) for f in frames], b"".join(frames)))
        yield _table(rows, _SEGMENTS)


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Store rows of segments (recipe_id, sizes, frames, marks); marks are (seq, digest, first) of shared chunks."""
    for batch in batches:
        rows = []
        for name, sizes, frames, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            marked, ends = {m["seq"]: m for m in marks or []}, np.cumsum([0, *sizes]).tolist()
            every = [{"seq": k, "frame": frames[a:b]} for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]
            shared = [{"digest": m["digest"], "frame": every[k]["frame"]} for k, m in marked.items() if m["first"]]
            rows.append((name, len(sizes), [e for e in every if e["seq"] not in marked], shared))
        yield _table(rows, _STORE)


class Media(NamedTuple):
    """What ingest wrote: recipes (doc_id, n_bytes, recipe_id, digests), the store (recipe_id, n_chunks, own, shared),
    the references to shared chunks (recipe_id, seq, digest) and the dictionary of the frames."""

    recipes: DataFrame
    store: DataFrame
    references: DataFrame
    dictionary: DataFrame
    path: str


def shared_references(recipes: DataFrame, path: str) -> DataFrame:
    """(recipe_id, seq, digest, first): the places of all chunks that have several places in distinct payloads;
    first marks one place for each digest."""
    lists = recipes.select("recipe_id", "digests").dropDuplicates(["recipe_id"])
    places = lists.select("recipe_id", F.posexplode("digests").alias("seq", "digest"))
    owners = places.groupBy("digest").agg(F.min(F.struct("recipe_id", "seq")).alias("owner"), F.count(F.lit(1)).alias("n"))
    owners = settle(owners.where("n > 1"), f"{path}/owners")
    hot = settle(owners.where(F.col("n") > common.HOT_ROWS).select("digest"), f"{path}/hot")
    met = join_hot(places, owners.drop("n"), "digest", "recipe_id", hot)
    return settle(met.select("recipe_id", "seq", "digest", (F.col("owner") == F.struct("recipe_id", "seq")).alias("first")), f"{path}/references")


def ingest(docs: DataFrame, path: str, cutter: Cutter = Cutter()) -> Media:
    """Cut the payloads of docs (doc_id, text) and write recipes and store under path."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    with freed_shuffles(spark):
        recipes = settle(docs.mapInArrow(lambda it: _recipes(it, cutter), "doc_id long, n_bytes long, recipe_id binary, digests array<binary>"), f"{path}/recipes")
        references = shared_references(recipes, path)
        trained = train_dictionary(docs)
        dictionary = settle(spark.createDataFrame([(bytearray(trained),)], "dictionary binary"), f"{path}/dictionary")
        segments = docs.select("text").mapInArrow(lambda it: _segments(it, cutter, trained), "recipe_id binary, sizes array<int>, frames binary")
        segments = segments.repartition(partitions(spark), "recipe_id").dropDuplicates(["recipe_id"])
        marks = references.groupBy("recipe_id").agg(F.collect_list(F.struct("seq", "digest", "first")).alias("marks"))
        store = settle(segments.join(marks, "recipe_id", "left").mapInArrow(_stored, _STORE_SQL), f"{path}/store")
    return Media(recipes, store, references, dictionary, path)


_FEATURES = pa.schema([("recipe_id", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
_FEATURES_SQL = "recipe_id binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class Reader:
    """Takes the frames of one payload in order and computes its features; a payload unlike its name raises."""

    def __init__(self, recipe_id: bytes, unpack):
        self.recipe_id, self.unpack = recipe_id, unpack
        self.payload, self.media, self.tail = hashlib.sha256(), hashlib.sha256(), b""
        self.n = self.stored = self.chunks = 0
        self.bins = np.zeros(8, np.int64)

    def add(self, frame: bytes) -> None:
        chunk = self.unpack.decompress(frame)
        self.payload.update(chunk)
        self.media.update(frame)
        self.n += len(chunk)
        self.stored += len(frame)
        self.chunks += 1
        self.tail = (self.tail + chunk)[-PAD:]
        self.bins += np.bincount(np.frombuffer(chunk, np.uint8) >> 5, minlength=8)

    def row(self) -> tuple:
        if self.payload.digest()[:NAME_BYTES] != self.recipe_id:
            raise ValueError("a payload read back doesn't match its digest")
        levels = ",".join(map(str, self.bins.tolist()))
        return self.recipe_id, self.n, self.payload.hexdigest(), zlib.crc32(self.tail), self.stored, self.media.hexdigest(), f"chunks={self.chunks};levels={levels}"


def _whole(batches: Iterator[pa.RecordBatch], dictionary: bytes) -> Iterator[pa.RecordBatch]:
    """Features of payloads (recipe_id, frames) that need nothing but their own row."""
    import zstandard

    unpack = zstandard.ZstdDecompressor(**_dictionary(dictionary))
    for batch in batches:
        rows = []
        for name, frames in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            reader = Reader(name, unpack)
            for frame in frames:
                reader.add(frame)
            rows.append(reader.row())
        yield _table(rows, _FEATURES)


def _joined(batches: Iterator[pa.RecordBatch], dictionary: bytes) -> Iterator[pa.RecordBatch]:
    """Features of payloads whose frames come as rows (recipe_id, seq, frame), sorted."""
    import zstandard

    unpack, reader = zstandard.ZstdDecompressor(**_dictionary(dictionary)), None
    for batch in batches:
        done = []
        for name, frame in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if reader is None or name != reader.recipe_id:
                if reader is not None:
                    done.append(reader.row())
                reader = Reader(name, unpack)
            reader.add(frame)
        yield _table(done, _FEATURES)
    if reader is not None:
        yield _table([reader.row()], _FEATURES)


def ordered_frames(media: Media) -> DataFrame:
    """(recipe_id, seq, frame) of the payloads with shared chunks."""
    frame = lambda name: F.explode(name).alias("x")
    own = media.store.where(F.size("own") < F.col("n_chunks")).select("recipe_id", frame("own")).select("recipe_id", "x.seq", "x.frame")
    shared = media.store.select(frame("shared")).select("x.digest", "x.frame")
    hot = hot_keys(media.references, "digest", f"{media.path}/hot_digests")
    met = join_hot(media.references.select("recipe_id", "seq", "digest"), shared, "digest", "recipe_id", hot)
    return own.unionByName(met.select("recipe_id", "seq", "frame"))


def reconstruct(media: Media) -> DataFrame:
    """Per document: sizes, digests and features computed from the payload as read back from the store."""
    spark = media.recipes.sparkSession
    trained = bytes(media.dictionary.first()[0])
    with freed_shuffles(spark):
        plain = media.store.where(F.size("own") == F.col("n_chunks")).select("recipe_id", F.col("own.frame").alias("frames"))
        plain = settle(plain.mapInArrow(lambda it: _whole(it, trained), _FEATURES_SQL), f"{media.path}/plain")
        ordered = ordered_frames(media).repartition(partitions(spark), "recipe_id").sortWithinPartitions("recipe_id", "seq")
        mixed = settle(ordered.mapInArrow(lambda it: _joined(it, trained), _FEATURES_SQL), f"{media.path}/mixed")
        hot = hot_keys(media.recipes, "recipe_id", f"{media.path}/hot_recipes")
    return join_hot(media.recipes.select("doc_id", "n_bytes", "recipe_id"), plain.unionByName(mixed), "recipe_id", None, hot).drop("recipe_id")


def op1_media_chunks(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    media = ingest(docs, work_dir(spark, "media"))
    return reconstruct(media).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
