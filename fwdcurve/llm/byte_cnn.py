"""Language identification by a byte convolutional network, trained and applied with numpy.

Texts are cut into windows of `WINDOW` bytes (the last one filled with zeros). For each width the network
adds, at every place of a window, one learned vector per byte and offset: a convolution over one-hot bytes.
Filters are max-pooled over the window, rectified, and a softmax gives the language of the window. A text
gets the mean of its windows' probabilities, weighted by their bytes.

Training takes a bounded sample: about `SAMPLE` rows of each language, chosen by a hash of doc_id and text in one
pass that knows the language counts, equal texts once, and at most `SAMPLE_WINDOWS` windows of each, at hashed places of its
text; every language is learned, in `EPOCHS` passes over the sample. The sample grows with the languages (0.8 MB each).
Only those windows reach the driver. Every window of every text is scored, in blocks of fixed size, by
tasks that need the model alone (about 150 kB).

Edge cases: null texts and texts without a letter are `und` with score 0; rows with null lang teach nothing;
a null doc_id counts as the empty text in the fold's checksum; without any row to learn from every text is
`und`; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE = 1500
SAMPLE_WINDOWS = 2
#: Passes of the training over the sample.
EPOCHS = 12
BLOCK = 256
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


class Model(NamedTuple):
    """tables[w][j]: vectors of each byte at offset j of the filters of width w; out: pooled filters to languages."""

    languages: list[str]
    tables: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def windows_of(raw: bytes) -> np.ndarray:
    """All bytes of a text as rows of WINDOW bytes."""
    data = np.frombuffer(raw, np.uint8)
    rows = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.uint8)
    rows.reshape(-1)[: len(data)] = data
    return rows


def _maps(windows: np.ndarray, model: Model) -> Iterator[tuple[int, np.ndarray]]:
    for w in WIDTHS:
        n = WINDOW - w + 1
        yield w, sum(model.tables[w][j][windows[:, j : j + n]] for j in range(w))


def _pairs(model: Model) -> dict[int, list[tuple[int, np.ndarray]]]:
    """The same sums with one table for two neighbouring bytes: (offset, vectors) for each width."""
    out: dict[int, list[tuple[int, np.ndarray]]] = {}
    for w in WIDTHS:
        out[w] = [(j, (model.tables[w][j][None, :, :] + model.tables[w][j + 1][:, None, :]).reshape(1 << 16, FILTERS)) for j in range(0, w - 1, 2)]
        if w % 2:
            out[w].append((w - 1, model.tables[w][w - 1]))
    return out


def probabilities(windows: np.ndarray, model: Model, pairs: dict) -> np.ndarray:
    """Softmax of each window, block by block."""
    done = []
    for at in range(0, len(windows), BLOCK):
        block = windows[at : at + BLOCK]
        both = block[:, :-1].astype(np.int64) | block[:, 1:].astype(np.int64) << 8
        pooled = []
        for w in WIDTHS:
            n, total = WINDOW - w + 1, None
            for j, table in pairs[w]:
                part = table.take((both if len(table) > 256 else block)[:, j : j + n].reshape(-1), axis=0)
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(total.reshape(len(block), n, FILTERS).max(axis=1))
        z = np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.out + model.out_bias
        e = np.exp(z - z.max(axis=1, keepdims=True))
        done.append(e / e.sum(axis=1, keepdims=True))
    return np.concatenate(done)


Values = dict[tuple | str, np.ndarray]


def _model(values: Values, languages: list[str]) -> Model:
    return Model(languages, {w: values["t", w] for w in WIDTHS}, values["b"], values["o"], values["c"])


def loss_and_gradient(x: np.ndarray, target: np.ndarray, values: Values) -> tuple[float, Values]:
    """Mean cross-entropy of windows x, and its gradient by each of values: ("t", w) tables, "b" bias, "o" and "c" output
    weights and bias. The gradient of a pooled filter goes to the place of its maximum."""
    m, lanes, places, pooled = _model(values, []), np.arange(FILTERS), {}, []
    for w, total in _maps(x, m):
        places[w] = total.argmax(axis=1)
        pooled.append(np.take_along_axis(total, places[w][:, None, :], axis=1)[:, 0])
    a = np.concatenate(pooled, axis=1) + m.bias
    h = np.maximum(a, 0)
    z = h @ m.out + m.out_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    rows = np.arange(len(x))
    loss = float(-np.log(np.maximum(p[rows, target], 1e-30)).mean())
    p[rows, target] -= 1
    p /= len(x)
    d = (p @ m.out.T) * (a > 0)
    grads: Values = {"o": h.T @ p, "c": p.sum(axis=0), "b": d.sum(axis=0)}
    for k, w in enumerate(WIDTHS):
        g, part = np.zeros_like(values["t", w]), d[:, k * FILTERS : (k + 1) * FILTERS]
        for j in range(w):
            np.add.at(g[j], (np.take_along_axis(x, places[w] + j, axis=1), lanes[None, :]), part)
        grads["t", w] = g
    return loss, grads


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], steps: int | None = None, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Model:
    """Adam on the cross-entropy, EPOCHS passes or so many steps."""
    steps = EPOCHS * -(-len(windows) // batch) if steps is None else steps
    rng = np.random.default_rng(seed)
    n_out = len(WIDTHS) * FILTERS
    values: Values = {("t", w): rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    values |= {"b": np.zeros(n_out, np.float32), "o": rng.normal(0, 0.2, (n_out, len(languages))).astype(np.float32), "c": np.zeros(len(languages), np.float32)}
    first, second = ({k: np.zeros_like(v) for k, v in values.items()} for _ in range(2))
    step = 0
    while len(windows) and step < steps:
        order = rng.permutation(len(windows))
        for at in range(0, min(len(order), batch * (steps - step)), batch):
            pick = order[at : at + batch]
            _, grads = loss_and_gradient(windows[pick], target[pick], values)
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                values[k] = values[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return _model(values, languages)


def sampled_places(text: str, n: int) -> list[int]:
    """At most SAMPLE_WINDOWS distinct ones of n windows, drawn by a hash of the text."""
    rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
    return rng.choice(n, min(n, SAMPLE_WINDOWS), replace=False).tolist()


def sample_windows(labelled: DataFrame, per_language: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows, targets and languages of a bounded sample of labelled rows (doc_id, text, lang)."""
    counts = labelled.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), []
    shares = labelled.sparkSession.createDataFrame([(r["lang"], min(1.0, per_language / r["count"])) for r in counts], "lang string, share double")
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple[str, bytes]] = []
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                every = windows_of(text.encode("utf-8", "replace"))
                rows += [(lang, every[k].tobytes()) for k in sampled_places(text, len(every))]
            yield pd.DataFrame(rows, columns=["lang", "bytes"])

    chosen = labelled.join(F.broadcast(shares), "lang").where(draw < F.col("share")).select("lang", "text").distinct()
    got = chosen.mapInPandas(spread, "lang string, bytes binary").toPandas().sort_values(["lang", "bytes"])
    if not len(got):
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), languages
    return np.frombuffer(b"".join(got["bytes"]), np.uint8).reshape(-1, WINDOW), got["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(np.int64), languages


def fit(labelled: DataFrame, per_language: int = SAMPLE) -> Model:
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    windows, target, languages = sample_windows(rows, per_language)
    return train(windows, target, languages)


def predict_texts(texts: list[str | None], model: Model, pairs: dict) -> tuple[list[str], list[float]]:
    """Language and score of each text; all windows of the texts go through the network together."""
    known = [bool(t and model.languages and _LETTER.search(t)) for t in texts]
    raw = [t.encode("utf-8", "replace") for t, k in zip(texts, known, strict=True) if k]
    if not raw:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    parts = [windows_of(r) for r in raw]
    ends = np.cumsum([0, *map(len, parts)])
    weights = np.full(ends[-1], WINDOW, np.float64)
    weights[ends[1:] - 1] = [max(1, len(r) - WINDOW * (len(p) - 1)) for r, p in zip(raw, parts, strict=True)]
    p = probabilities(np.concatenate(parts), model, pairs) * weights[:, None]
    mean = np.add.reduceat(p, ends[:-1], axis=0) / np.add.reduceat(weights, ends[:-1])[:, None]
    best = iter(zip(mean.argmax(axis=1).tolist(), mean.max(axis=1).tolist(), strict=True))
    rows = [(model.languages[b[0]], min(1.0, b[1])) if k and (b := next(best)) else (UNKNOWN, 0.0) for k in known]
    return [r[0] for r in rows], [r[1] for r in rows]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred and score to docs (doc_id, text), and drops text."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = _pairs(model)
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                some = pdf.iloc[at : at + 500]
                lang, p = predict_texts(some["text"].tolist(), model, pairs)
                yield pd.DataFrame({"doc_id": some["doc_id"].to_numpy(), "held_out": some["held_out"].to_numpy(), "lang_pred": lang, "score": p})

    return docs.select("doc_id", "held_out", "text").mapInPandas(score, "doc_id long, held_out boolean, lang_pred string, score double")


def op4_byte_cnn(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    fold = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 4 == 2
    docs = docs.withColumn("held_out", fold)
    return predict(docs, fit(docs.where(~F.col("held_out"))))
