"""Quality classifier: naive Bayes support vectors.

A text is a set of n-gram indicators, n = 1, 2, in two blocks. The first is of words (between white space, A-Z
lower-cased): "this n-gram stands here". The second is of word shapes: the cases of the letters, whether
there are digits, and the marks around them; a word that repeats the one before it has a shape of its own; its
indicators are "this n-gram stands here" and "it makes up more than 2, 10 and 40 percent of the places". Each
block is hashed into buckets of its own (`WORD_BUCKETS`, `BUCKETS`). As a text has as many word indicators as it has
words, those are weighed by one over the root of their number. The model scales each indicator by
its class log-count ratio and fits a linear hinge-loss model (squared hinge, L2) on the scaled indicators by
dual coordinate descent; a logistic curve fitted on rows kept aside turns margins into scores.

Training takes a bounded sample: about `SAMPLE` labelled rows of each class, chosen by a hash of doc_id, one
document for each id; a row's indicators, not its text, reach the driver. Scoring reads every whole text in tasks
that need the weights alone (4 bytes a bucket).

Edge cases: null and empty texts have the constant indicator alone and get its score; labels that are null
or have no document teach nothing; of several labels of one document the least counts, of several documents of
one id that with the least hash of its text; without labels of both classes every score is 0.5; repeated rows
give repeated equal results; a null doc_id counts as the empty text in the fold's checksum; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
WORD_BUCKETS = 1 << 19
SAMPLE = 3000
SHARES = (0.02, 0.1, 0.4)
THRESHOLD = 0.3
#: Words whose codes a worker remembers at most, and their most characters; longer ones are coded anew.
KNOWN = 200_000
KNOWN_LENGTH = 64
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_REPEAT = 1


class Model(NamedTuple):
    weights: np.ndarray
    slope: float
    offset: float


def shape(word: str) -> str:
    """Letters by case (x, Xx, X), digits 9, other characters as they are, runs of one shortened to two."""
    if word.isalpha():
        return "x" if word.islower() else "Xx" if word[1:].islower() else "X"
    letters = lambda m: "x" if (w := m[0]).islower() else "Xx" if w[1:].islower() else "X"
    marks = _DIGITS.sub("9", _LETTERS.sub(letters, word))
    return re.sub(r"(.)\1\1+", r"\1\1", marks)


def _code(data: bytes) -> int:
    return 2 + zlib.crc32(data) % ((1 << 31) - 2)


class Codes(dict):
    """Code of a word, A-Z lower-cased, and 32 bits lower that of its shape."""

    def __missing__(self, word: str) -> int:
        codes = _code(word.encode("utf-8", "surrogatepass").lower()) << 32 | _code(shape(word).encode("utf-8", "surrogatepass"))
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= KNOWN:
                self.clear()
            self[word] = codes
        return codes


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)).astype(np.int64) % buckets


class Indicators:
    """Buckets of a text's indicators: 0 is the constant, then come shapes (below BUCKETS), then words."""

    def __init__(self) -> None:
        self.codes = Codes()

    def __call__(self, text: str | None) -> np.ndarray:
        """Distinct buckets, sorted."""
        words = (text or "").split()
        if not words:
            return np.zeros(1, np.int64)
        both = np.array(list(map(self.codes.__getitem__, words)), np.int64)
        named, shapes = both >> 32, both & 0xFFFFFFFF
        shapes[1:][both[1:] == both[:-1]] = _REPEAT
        found = [named, named[:-1] * 1_000_003 + named[1:] * 7 + 3]
        in_words = np.unique(_bucket(np.concatenate(found), WORD_BUCKETS)) + BUCKETS
        found = []
        for grams in (shapes, shapes[:-1] * 1_000_003 + shapes[1:] * 7 + 3):
            if not len(grams):
                continue
            values, counts = np.unique(grams, return_counts=True)
            found += [values[counts > s * len(grams)] * 4 + k for k, s in enumerate((0, *SHARES))]
        return np.concatenate([np.unique(np.concatenate([[0], 1 + _bucket(np.concatenate(found), BUCKETS - 1)])), in_words])


def values_of(row: np.ndarray) -> np.ndarray:
    """The value of each indicator of a row: 1, for words one over the root of their number."""
    n = np.searchsorted(row, BUCKETS)
    out = np.ones(len(row))
    out[n:] = 1 / math.sqrt(max(1, len(row) - n))
    return out


def margin(row: np.ndarray, weights: np.ndarray) -> float:
    return float(weights[row] @ values_of(row))


def log_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """log of (share of indicator among good / among bad), counts one up."""
    counts = [1 + np.bincount(np.concatenate([r for r, g in zip(rows, good, strict=True) if g == c]), minlength=BUCKETS + WORD_BUCKETS).astype(np.float64) for c in (1, 0)]
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    ratio[0] = 1.0
    return ratio


def dual_descent(rows: list[np.ndarray], sign: np.ndarray, scale: np.ndarray, cost: float = 0.1, rounds: int = 20, seed: int = 5) -> np.ndarray:
    """Weights on scaled indicators: dual coordinate descent for the squared hinge (Hsieh et al., 2008)."""
    rng = np.random.default_rng(seed)
    w, alpha, shrink = np.zeros(BUCKETS + WORD_BUCKETS), np.zeros(len(rows)), 1 / (2 * cost)
    values = [scale[r] * values_of(r) for r in rows]
    norms = [float(v @ v) + shrink for v in values]
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            g = sign[i] * float(w[rows[i]] @ values[i]) - 1 + shrink * alpha[i]
            new = max(alpha[i] - g / norms[i], 0.0)
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * sign[i] * values[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w * scale


def logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps, with smoothed targets (Platt, 1999)."""
    n1, n0 = good.sum(), len(good) - good.sum()
    t = np.where(good == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, math.log((n1 + 1) / (n0 + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - t) * margins).sum() + 1e-3 * a, (p - t).sum()])
        q = p * (1 - p) + 1e-9
        h = np.array([[(q * margins**2).sum() + 1e-3, (q * margins).sum()], [(q * margins).sum(), q.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(h, g)
    return float(max(a, 0.0)), float(b)


def fit_rows(rows: list[np.ndarray], good: np.ndarray) -> Model:
    if not len(rows) or good.min() == good.max():
        return Model(np.zeros(BUCKETS + WORD_BUCKETS, np.float32), 0.0, 0.0)
    aside = np.arange(len(rows)) % 5 == 0
    if len(set(good[aside])) < 2 or len(set(good[~aside])) < 2:
        aside[:] = False
    part = [r for r, x in zip(rows, aside, strict=True) if not x]
    learn = lambda r, g: dual_descent(r, np.where(g == 1, 1.0, -1.0), log_ratios(r, g))
    w = learn(part, good[~aside])
    check = [r for r, x in zip(rows, aside, strict=True) if x] or rows
    slope, offset = logistic(np.array([margin(r, w) for r in check]), good[aside] if aside.any() else good)
    return Model((learn(rows, good) if aside.any() else w).astype(np.float32), slope, offset)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, seed: int = 13) -> Model:
    """Learn labels (doc_id, quality) from the documents they name."""
    marks = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    counts = {r["quality"]: r["count"] for r in marks.groupBy("quality").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    bound = F.when(F.col("quality") == 1, min(1.0, per_class / max(1, counts.get(1, 0)))).otherwise(min(1.0, per_class / max(1, counts.get(0, 0))))
    # at most 2 * per_class ids, so texts needn't move
    chosen = F.broadcast(marks.where(draw < bound))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")
    # one row for each id, so that repeats of one can't reach the driver
    sample = sample.groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Indicators()
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "rows": [of(t).astype("<i4").tobytes() for t in pdf["text"]]})

    got = sample.mapInPandas(extract, "doc_id long, quality int, rows binary").toPandas().sort_values(["doc_id", "rows"])
    return fit_rows([np.frombuffer(r, "<i4").astype(np.int64) for r in got["rows"]], got["quality"].to_numpy(np.int64))


def scored(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """columns of docs with score (0 to 1, higher: label 1 likelier) of its text."""
    rows = docs.select(*columns, *(["text"] if "text" not in columns else []))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)

    def score(batches) -> Iterator:
        import pyarrow as pa

        of = Indicators()
        for batch in batches:
            margins = np.array([margin(of(t), model.weights) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(model.slope * margins + model.offset, -30, 30)))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p, pa.float64())], names=[*columns, "score"])

    return rows.mapInArrow(score, f"{schema}, score double")


def fold(doc_id="doc_id"):
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def op9_nb_svm(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", fold())
    model = fit(docs.where(~F.col("held_out")), labels)
    return scored(docs, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
