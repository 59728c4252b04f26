"""Token-ID output: Arrow files of fixed-size-list batches, read by memory map at any row without copying.

Documents are range-sorted by doc_id, encoded in that order and packed: the ids of a file run through rows
of exactly `length` ids; the last row is filled up, and a mask (a byte for each id) marks the ids that count.
All rows but a file's last have the same mask, so masks are a dictionary of two fixed-size lists: a row
stores its number in it. Every batch but the last has the same number of rows, so `TokenFile` finds row r,
which holds ids r*length to (r+1)*length, by arithmetic, and gives views of the mapped file. Beside each
file lies its index (doc_id, place of the first id, number of ids).

Scale: one range shuffle of the texts; each task writes one file as it streams, under a name of its own
attempt. The manifest, which Spark commits, names the files that count, so a lost or repeated task leaves
no trace. Reading back streams batch by batch. Only per-file totals are gathered (a window over as many
rows as there are files).

Edge cases: null text is empty and has its end id alone; repeated rows are written as often as they occur,
ordered by doc_id and then by a hash of the text; a null doc_id sorts first; an empty table gives no file;
other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filesystem, freed_shuffles, partitions, settle, text_of, work_dir

LENGTH = 2048
#: Rows of one record batch.
BATCH_ROWS = 128
END_ID = 1
#: Pieces a worker remembers in the newer of two generations.
PIECES = 150_000
#: Texts encoded at a time.
TEXTS = 2000
_ENCODERS: dict = {}

# Normalizer and pre-tokenizer for which the ids of a text are those of its pieces in order.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PRE_TOKENIZERS = ["Split", "ByteLevel"]
#: The pattern for lower-case printable ASCII, where the byte-level alphabet is the identity.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Pieces of Latin letters with accents: normal as they are, and lower-cased letter by letter but for the dotted capital I.
_LATIN = re.compile("[!-~\u00a1-\u012f\u0131-\u017f]+")
_LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[^a-z0-9\u00aa\u00b2\u00b3\u00b5\u00b9\u00ba\u00bc-\u00be\u00df-\u00f6\u00f8-\u017f]+")
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The byte-level alphabet: printable bytes stand for themselves, the others for the letters from U+0100 on.
_ALPHABET = {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


class Memo(dict):
    """Values of a function, those of the latest `most` keys at least; older ones go by generations."""

    def __init__(self, of: Callable[[str], bytes], most: int):
        super().__init__()
        self.of, self.most, self.older = of, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.of(key)
        self[key] = value
        return value

    def tidy(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Ids of whole texts by the tokenizers library, which encodes each distinct word once.

    A tokenizer as WORD_PATTERN describes drops white space, and no merge, normal form or added token spans
    it: pieces between white space are looked up, a new one is lower-cased and split at the pattern, and
    the words are looked up again; a new word goes to the library's model. Texts of other tokenizers are
    encoded whole."""

    def __init__(self, tokenizer_path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        spec = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.apart = [*"\x1c\x1d\x1e\x1f", *self.added]
        self.by_piece = self._splits_at_blanks(spec)
        self.model, self.normalizer, self.pre = self.tokenizer.model, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.words, self.pieces = Memo(self._word, PIECES), Memo(self._piece, PIECES)

    def _splits_at_blanks(self, spec: dict) -> bool:
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (
            [s["type"] for s in steps] == NORMALIZERS
            and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": "\\s+"}, " ")
            and [c["type"] for c in cuts] == PRE_TOKENIZERS
            and (cuts[0]["pattern"], cuts[0]["invert"], cuts[0]["behavior"]) == ({"Regex": WORD_PATTERN}, True, "Removed")
            and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
            and spec["model"]["type"] == "BPE"
            and not spec["model"]["dropout"]
            and not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"])
            and not spec["post_processor"]
        )

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        return array(self.dtype.char, [t.id for t in self.model.tokenize(word)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            words = _ASCII.findall(piece.lower())
        elif _LATIN.fullmatch(piece):
            words = [w if w.isascii() else w.encode().decode("latin-1").translate(_ALPHABET) for w in _LATIN_WORDS.findall(piece.lower())]
        else:
            words = [w for w, _ in self.pre.pre_tokenize_str(self.normalizer.normalize_str(piece))]
        return b"".join(map(self.words.__getitem__, words))

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids and the end id, as little-endian bytes of self.dtype."""
        get, done = self.pieces.__getitem__, []
        for text in texts:
            # four control characters separate in Python but not for the tokenizer: such texts, and those that spell out an
            # added token, are encoded whole
            if text and (not self.by_piece or any(c in text for c in self.apart)):
                done.append(self._whole(text) + self.end)
            else:
                done.append(b"".join(map(get, (text or "").split())) + self.end)
        self.pieces.tidy()
        self.words.tidy()
        return done


def encoder_of(tokenizer_path: str) -> Encoder:
    """The worker's encoder of a tokenizer: workers live on between tasks, and so do their pieces."""
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = Encoder(tokenizer_path)
    return _ENCODERS[tokenizer_path]


def file_schema(length: int, dtype: np.dtype) -> pa.Schema:
    lists = lambda t: pa.list_(pa.field("item", t, nullable=False), length)
    return pa.schema([("input_ids", lists(pa.from_numpy_dtype(dtype))), ("mask", pa.dictionary(pa.int32(), lists(pa.uint8())))])


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer_path: str, length: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, encoder, fs_path = TaskContext.get().partitionId(), None, filesystem(folder)
    fs, root = fs_path
    name = f"{root}/tokens-{part:05d}-{uuid.uuid4().hex}"
    rest, docs, n_docs, total = b"", ([], [], []), 0, 0
    sink = index = None
    for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
        if encoder is None:
            encoder = encoder_of(tokenizer_path)
            fs.create_dir(root, recursive=True)
            schema = file_schema(length, encoder.dtype)
            sink = pa.ipc.new_file(fs.open_output_stream(f"{name}.arrow"), schema, options=pa.ipc.IpcWriteOptions(emit_dictionary_deltas=True))
            index = pa.ipc.new_file(fs.open_output_stream(f"{name}.docs.arrow"), _INDEX)
            row = length * encoder.dtype.itemsize
        parts = encoder.texts(batch.column(1).to_pylist())
        counts = [len(p) // encoder.dtype.itemsize for p in parts]
        starts = (total + np.cumsum([0, *counts[:-1]])).tolist()
        index.write_batch(pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=_INDEX))
        total += sum(counts)
        n_docs += len(counts)
        rest += b"".join(parts)
        whole = len(rest) // (row * BATCH_ROWS) * (row * BATCH_ROWS)
        for at in range(0, whole, row * BATCH_ROWS):
            sink.write_batch(_rows(rest[at : at + row * BATCH_ROWS], length, encoder.dtype))
        rest = rest[whole:]
    if sink is not None:
        if rest:
            sink.write_batch(_rows(rest, length, encoder.dtype))
        sink.close()
        index.close()
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, os.path.basename(name), n_docs, total), _MANIFEST.types, strict=True)], schema=_MANIFEST)


def _rows(data: bytes, length: int, dtype: np.dtype) -> pa.RecordBatch:
    """A batch of whole rows, or the file's last one, whose last row is filled up with zeros."""
    ids, (id_type, mask_type) = np.frombuffer(data, dtype), file_schema(length, dtype).types
    n, used = -(-len(ids) // length), len(ids) % length
    full, which = np.zeros(n * length, dtype), np.zeros(n, np.int32)
    full[: len(ids)] = ids
    masks = np.ones((2 if used else 1, length), np.uint8)
    if used:
        masks[1, used:], which[-1] = 0, 1
    lists = lambda x, t: pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), type=t)
    masks = pa.DictionaryArray.from_arrays(pa.array(which), lists(masks, mask_type.value_type))
    return pa.RecordBatch.from_arrays([lists(full, id_type), masks], schema=file_schema(length, dtype))


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """Write docs (doc_id, text) as token files in ascending doc_id order; returns the manifest
    (part, file, n_docs, n_tokens, base: ids of all files before)."""
    spark = docs.sparkSession
    # the row's place in the input lets rows that are repeated very often spread over several tasks
    keys = {"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumns(keys)
    rows = rows.repartitionByRange(partitions(spark), "doc_id", *keys).sortWithinPartitions("doc_id", *keys).select("doc_id", "text")
    with freed_shuffles(spark):
        manifest = settle(rows.mapInArrow(lambda it: _write(it, folder, tokenizer_path, length), "part int, file string, n_docs long, n_tokens long"), f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class TokenFile:
    """One token file, open. From a local path the file is mapped, and what `sequence` returns are views of it."""

    def __init__(self, source: str | pa.NativeFile):
        self.source = pa.memory_map(source) if isinstance(source, str) else source
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("input_ids").type.list_size
        self.n_batches = self.reader.num_record_batches
        self.batch_rows = self.reader.get_batch(0).num_rows
        self.n_rows = (self.n_batches - 1) * self.batch_rows + self.reader.get_batch(self.n_batches - 1).num_rows

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *_) -> None:
        self.source.close()

    def batch(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, one row each; masks; number of each row's mask) of batch k."""
        ids, masks = self.reader.get_batch(k).columns
        rows = lambda x: x.values.to_numpy(zero_copy_only=True).reshape(-1, self.length)
        return rows(ids), rows(masks.dictionary), masks.indices.to_numpy(zero_copy_only=True)

    def sequence(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of row r."""
        if not 0 <= r < self.n_rows:
            raise IndexError(r)
        ids, masks, which = self.batch(r // self.batch_rows)
        at = r % self.batch_rows
        return ids[at], masks[which[at]]

    def counted(self) -> Iterator[np.ndarray]:
        """The ids that the masks let through, batch by batch."""
        for k in range(self.n_batches):
            ids, masks, which = self.batch(k)
            yield ids.reshape(-1) if masks[which].all() else ids[masks[which].astype(bool)]


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _checksums(ids: Iterator[np.ndarray]) -> Callable[[int], int]:
    """A function that takes the next n ids of a stream and gives the crc32 of them as 32-bit integers."""
    have = np.zeros(0, "<u4")

    def take(n: int) -> int:
        nonlocal have
        crc = 0
        while n:
            if not len(have):
                have = next(ids).astype("<u4")
            crc, n, have = zlib.crc32(have[:n], crc), n - len(have[:n]), have[n:]
        return crc

    return take


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, root = filesystem(folder)
    for batch in batches:
        for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with fs.open_input_file(f"{root}/{name}.docs.arrow") as f, TokenFile(fs.open_input_file(f"{root}/{name}.arrow")) as tokens:
                index, crc = pa.ipc.open_file(f), _checksums(tokens.counted())
                for k in range(index.num_record_batches):
                    doc_ids, starts, counts = index.get_batch(k).columns
                    sums = pa.array([crc(n) for n in counts.to_pylist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([doc_ids, pa.array(starts.to_numpy() + base), counts, sums], schema=_READ)


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files of a manifest."""
    spark = manifest.sparkSession
    files = manifest.select("file", "base").repartition(partitions(spark))
    return files.mapInArrow(lambda it: _read(it, folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_output(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH) -> DataFrame:
    folder = work_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer_path or tokenizer_file(), length), folder)


def op2_token_files(spark, sf_dir: str) -> DataFrame:
    return token_output(spark.read.parquet(f"{sf_dir}/documents.parquet"))
