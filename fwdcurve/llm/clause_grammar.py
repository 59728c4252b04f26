"""Toxicity by a weighted finite-state grammar of clauses.

Two tapes are read. A word's letters pass a folding transducer (look-alike signs become letters, at a cost) composed
with a lexicon, a trie of words and word beginnings whose end weighs what labels say of it; what comes out is the word's
class: insult, threat, target, negation, report, or other. A sentence's classes then pass a machine composed of four
transducers, each of which rewrites what the one before it wrote:

    reported    insults and threats after a verb of saying are reported, until the sentence ends
    negated     what stands within three words after a negation, in its clause, is negated
    targeted    an insult beside a person addressed, in its clause, is aimed
    threatened  a threat counts if a target follows in its clause

The composed machine is built once, from classes and states that can occur. It writes a kind (insult, aimed,
threat, reported, negated) for each match; a match adds its word's weight to its kind. A document's score is a logistic
function of the kinds' sums (`MOST` at most each), the number of matches by 100 words and a constant. How much
a kind counts is learned, from a prior by which reported and negated matches count little (`PRIOR`) and which holds
where labels show no such matches.

Learning takes a bounded sample of labelled rows: about `SAMPLE` toxic and `CLEAN_TIMES` as many clean ones, by a hash of
doc_id, one document an id, near copies once. Two thirds give the lexicon: for words and word beginnings of
`SHORTEST` to `LONGEST` letters that at least `SEEN` toxic documents have, the log ratio of their shares among toxic and
clean documents, less `SURE` standard errors, where that is `LEAST` or more and the ratio itself `RATIO`. The others give the kinds' weights. Beginnings are tried because
languages inflect. Counting and matching run on Spark; the entries that weigh anything and a few numbers a sampled
document reach the driver. Scoring reads every whole text in tasks that hold the lexicon alone.

Edge cases: null and empty texts have no match and get the constant's score; null labels and labels without a
document teach nothing; of several labels of one document the greatest counts, of several documents of one id that with the
least hash of its text; without labels of both classes the seed words and the prior are used alone; repeated rows give
repeated equal results; a null doc_id counts as the empty text in the fold's checksum; an empty table gives an empty
result; other columns are ignored. Texts without spaces are one word a sentence, of which the beginning alone is seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 3000
CLEAN_TIMES = 4
SHORTEST, LONGEST = 3, 8
SEEN = 5
SURE = 3.0
LEAST = 0.3
#: How many times more frequent among toxic documents an entry has to be, as a logarithm: topic and length alone give less.
RATIO = 1.3
THRESHOLD = 0.3
#: A kind's sum and the number of matches by 100 words stop here.
MOST = 12.0
#: Words whose reading a worker remembers at most.
KNOWN = 200_000
KNOWN_LENGTH = 64
#: Letters of a word that are read at most for a class: no entry is longer.
WORD_LETTERS = 40

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK = "oihtnrb"
CLASSES = OTHER + INSULT + THREAT + TARGET + NEGATION + REPORT + BREAK
KINDS = ("insult", "aimed", "threat", "reported", "negated")
#: Constant, what each kind counts, and what matches by 100 words count, before labels are seen.
PRIOR = (-4.0, 1.0, 1.5, 1.5, 0.25, 0.25, 0.1)

#: Words of the grammar, of English, German, French and Spanish; an asterisk stands for any ending.
SEEDS = {
    INSULT: "idiot* moron* stupid scum loser* worthless pathetic disgusting trash clown* imbecile* dumbass* depp* trottel* arschloch dumm* connard* abruti* imbécile* salaud* gilipollas imbécil* estúpid*",
    THREAT: "kill hurt destroy beat shoot stab töten umbringen tuer frapper matar",
    TARGET: "you your yours ya u he she him her they them du dich dir euch sie tu toi vous tú usted ustedes él",
    NEGATION: "not never no nobody isn aren wasn don doesn didn won nicht nie kein* ne jamais nunca jamás",
    REPORT: "said says say called calls wrote writes claimed claims sagte sagt nannte dit disait écrit dijo dice escribió",
}
#: What a seed word weighs before labels are seen.
SEED_WEIGHT = 4.0
#: Signs that stand for letters, and what reading one so costs.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
LOOKALIKE_COST = 0.5

_WORD = re.compile(r"[^\W_]+")
_MASKED = re.compile(r"[^\W_](?:[^\W_]|[@$!])*[^\W_]")
_SENTENCE = re.compile(r"[.!?;][\"'”»)\]]*$")
_CLAUSE = re.compile(r"[,:–—][\"'”»)\]]*$")


class Transducer(NamedTuple):
    """arcs[state, symbol] = (next state, written symbol, weight); state 0 is the first. Symbols without an arc pass
    unchanged and leave the state as it is."""

    arcs: dict

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))


def compose(first: Transducer, second: Transducer, alphabet: str) -> Transducer:
    """The transducer that passes its input through first, and what that writes through second; the states that can be
    reached are numbered."""
    numbers, arcs, new = {(0, 0): 0}, {}, [(0, 0)]
    while new:
        a, b = new.pop()
        for symbol in alphabet:
            to_a, middle, w1 = first.step(a, symbol)
            to_b, written, w2 = second.step(b, middle)
            if (to_a, to_b) not in numbers:
                numbers[to_a, to_b] = len(numbers)
                new.append((to_a, to_b))
            arcs[numbers[a, b], symbol] = (numbers[to_a, to_b], written, w1 + w2)
    return Transducer(arcs)


#: Written symbols: I, H reported insult and threat; N negated match; A aimed insult; P a target beside the insult before
#: it, which becomes aimed; T threat with its target; lower case as read.
def reported() -> Transducer:
    return Transducer({(0, REPORT): (1, REPORT, 0.0), (1, INSULT): (1, "I", 0.0), (1, THREAT): (1, "H", 0.0)})


def negated(reach: int = 3) -> Transducer:
    arcs = {(0, NEGATION): (reach, NEGATION, 0.0)}
    for left in range(1, reach + 1):
        for symbol in OTHER + TARGET + REPORT:
            arcs[left, symbol] = (left - 1, symbol, 0.0)
        arcs |= {(left, INSULT): (left, "N", 0.0), (left, THREAT): (left, "N", 0.0), (left, NEGATION): (reach, NEGATION, 0.0), (left, BREAK): (0, BREAK, 0.0)}
    return Transducer(arcs)


def targeted() -> Transducer:
    """States: 0 nothing, 1 a target was read, 2 an insult that no target stands before."""
    return Transducer({
        (0, TARGET): (1, TARGET, 0.0), (1, INSULT): (1, "A", 0.0), (1, BREAK): (0, BREAK, 0.0),
        (0, INSULT): (2, INSULT, 0.0), (2, TARGET): (1, "P", 0.0), (2, BREAK): (0, BREAK, 0.0),
    })


def threatened() -> Transducer:
    """A threat is a match once its target comes; P is a target too."""
    return Transducer({(0, THREAT): (1, THREAT, 0.0), (1, TARGET): (0, "T", 0.0), (1, "P"): (0, "T", 0.0), (1, BREAK): (0, BREAK, 0.0)})


def clause_machine() -> Transducer:
    machine = reported()
    for part in (negated(), targeted(), threatened()):
        machine = compose(machine, part, CLASSES)
    return machine


class Reading(NamedTuple):
    symbol: str
    weight: float


class Lexicon:
    """Trie over letters; an entry ends a word or, with an asterisk, its beginning. Reading composes it with the
    folding transducer: each sign may also be read as the letter it looks like, at a cost."""

    def __init__(self, entries: dict[str, Reading]) -> None:
        self.root: dict = {}
        for entry, reading in entries.items():
            node = self.root
            for letter in entry.rstrip("*"):
                node = node.setdefault(letter, {})
            # "" ends a word here, "*" any word from here on
            node["*" if entry.endswith("*") else ""] = reading

    def read(self, word: str) -> Reading:
        """The heaviest reading; among equal ones the first class of CLASSES."""
        best = Reading(OTHER, 0.0)

        def take(found: Reading | None, cost: float) -> None:
            nonlocal best
            if found and (found.weight - cost, -CLASSES.index(found.symbol)) > (best.weight, -CLASSES.index(best.symbol)):
                best = Reading(found.symbol, found.weight - cost)

        ways = [(self.root, 0.0)]
        for letter in word[:WORD_LETTERS]:
            after = []
            for node, cost in ways:
                take(node.get("*"), cost)
                if letter in node and letter != "*":
                    after.append((node[letter], cost))
                if letter in LOOKALIKE and LOOKALIKE[letter] in node:
                    after.append((node[LOOKALIKE[letter]], cost + LOOKALIKE_COST))
            ways = after
            if not ways:
                return best
        for node, cost in ways:
            take(node.get("*"), cost)
            if len(word) <= WORD_LETTERS:
                take(node.get(""), cost)
        return best


def seed_entries() -> dict[str, Reading]:
    return {w: Reading(symbol, SEED_WEIGHT if symbol in (INSULT, THREAT) else 1.0) for symbol, words in SEEDS.items() for w in words.split()}


class Words(dict):
    """Reading of a token between white space: (class, weight, whether a clause, whether a sentence ends after it)."""

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str) -> tuple:
        lower = token.lower()
        parts = _WORD.findall(lower)
        masked = _MASKED.search(lower)
        if masked and masked[0] not in parts:
            parts.append(masked[0])
        best = max((self.lexicon.read(p) for p in parts), key=lambda r: (r.weight * (r.symbol in (INSULT, THREAT)), r.weight), default=Reading(OTHER, 0.0))
        sentence = bool(_SENTENCE.search(token))
        got = (best.symbol, best.weight, sentence or bool(_CLAUSE.search(token)), sentence)
        if len(token) <= KNOWN_LENGTH:
            if len(self) >= KNOWN:
                self.clear()
            self[token] = got
        return got


class Grammar:
    """features(text): the sums of the kinds and the matches by 100 words."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.words = Words(lexicon)
        self.machine = clause_machine()

    def features(self, text: str | None) -> np.ndarray:
        sums, matches, count = dict.fromkeys(KINDS, 0.0), 0, 0
        for line in (text or "").splitlines():
            read = list(map(self.words.__getitem__, line.split()))
            count += len(read)
            start = 0
            for end in [*(k + 1 for k, r in enumerate(read) if r[3]), len(read)]:
                matches += self._sentence(read[start:end], sums)
                start = end
        out = [min(sums[k], MOST) for k in KINDS]
        return np.array([*out, min(MOST, 100.0 * matches / max(count, 1))])

    def _sentence(self, read: list[tuple], sums: dict[str, float]) -> int:
        if not any(r[0] in "ih" for r in read):
            return 0
        state, matches, insult, threat = 0, 0, 0.0, 0.0
        for symbol, weight, clause, _ in read:
            if symbol == THREAT:
                threat = weight
            state, written, _ = self.machine.step(state, symbol)
            kind = {"i": "insult", "A": "aimed", "I": "reported", "H": "reported", "N": "negated", "T": "threat"}.get(written)
            if kind:
                sums[kind] += threat if written == "T" else weight
                matches += 1
                insult = weight
            elif written == "P":
                sums["insult"] -= insult
                sums["aimed"] += insult
            if clause:
                state, _, _ = self.machine.step(state, BREAK)
        return matches


class Model(NamedTuple):
    entries: dict[str, Reading]
    weights: np.ndarray


def candidates(text: str | None) -> set[str]:
    """Words of a text ("word") and their beginnings ("beg*")."""
    words = set(_WORD.findall((text or "").lower()))
    return {w for w in words if SHORTEST <= len(w) <= WORD_LETTERS} | {w[:k] + "*" for w in words for k in range(SHORTEST, min(LONGEST, len(w)) + 1)}


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log ratio of the shares of toxic and clean documents, less SURE standard errors; 0 where the ratio is below RATIO."""
    ratio = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return np.where(ratio < RATIO, 0.0, ratio - SURE * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)))


def _counts(sample: DataFrame, wanted: frozenset | None = None) -> DataFrame:
    """(entry, n): how many texts have each candidate; added up in each task first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter = Counter()
            for text in pdf["text"]:
                seen.update(candidates(text) if wanted is None else candidates(text) & wanted)
            yield pd.DataFrame({"entry": list(seen), "n": list(seen.values())}).astype({"entry": object, "n": "int64"})

    return sample.select("text").mapInPandas(count, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def learned_entries(sample: DataFrame) -> dict[str, Reading]:
    """Insults by the labels of sample (text, toxic)."""
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return {}
    toxic = {r["entry"]: r["n"] for r in _counts(sample.where("toxic = 1")).where(F.col("n") >= SEEN).collect()}
    # a candidate whose weight is nothing even if no clean text has it needs no counting
    names = sorted(toxic)
    hope = evidence(np.array([toxic[e] for e in names], float), np.zeros(len(names)), sizes[1], sizes[0])
    names = [e for e, h in zip(names, hope, strict=True) if h >= LEAST]
    clean = {r["entry"]: r["n"] for r in _counts(sample.where("toxic = 0"), frozenset(names)).collect()}
    weights = evidence(np.array([toxic[e] for e in names], float), np.array([clean.get(e, 0) for e in names], float), sizes[1], sizes[0])
    return {e: Reading(INSULT, w) for e, w in most_telling({e: float(w) for e, w in zip(names, weights, strict=True) if w >= LEAST}).items()}


def most_telling(weights: dict[str, float]) -> dict[str, float]:
    """Without beginnings that something longer explains (another entry that begins so weighs as much or more: "los*"
    beside "loser"), then without entries that a beginning at least as heavy reads as well."""
    heaviest: dict[str, float] = {}
    for entry, weight in weights.items():
        bare = entry.rstrip("*")
        for k in range(1, len(bare) + (not entry.endswith("*"))):
            heaviest[bare[:k]] = max(heaviest.get(bare[:k], 0.0), weight)
    kept = {e: w for e, w in weights.items() if not e.endswith("*") or heaviest.get(e[:-1], 0.0) < w}
    return {e: w for e, w in kept.items() if all(kept.get(e[:k] + "*", 0.0) < w for k in range(1, len(e.rstrip("*")) + (not e.endswith("*"))))}


def kind_weights(features: np.ndarray, toxic: np.ndarray, pull: float = 2.0, steps: int = 60) -> np.ndarray:
    """Constant and weights of a logistic function, drawn to PRIOR, none of the weights negative; each class counts by its
    own rows."""
    prior = np.array(PRIOR)
    w = prior.copy()
    if not len(features):
        return w
    x = np.column_stack([np.ones(len(features)), features])
    hold = np.array([0.01, *[pull] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - toxic) + hold * (w - prior)
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(hold)
        new = w - np.linalg.solve(h, g)
        new[1:] = np.maximum(new[1:], 0.0)
        if np.abs(new - w).max() < 1e-6:
            break
        w = w + np.clip(new - w, -1.0, 1.0)
    return w


def _draw(seed: int):
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, seed: int = 29) -> DataFrame:
    """(doc_id, toxic, text) of about per_class toxic and CLEAN_TIMES * per_class clean documents."""
    marks = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    share = {1: min(1.0, per_class / max(1, counts.get(1, 0))), 0: min(1.0, CLEAN_TIMES * per_class / max(1, counts.get(0, 0)))}
    # at most (1 + CLEAN_TIMES) * per_class ids, about, so texts needn't move
    chosen = F.broadcast(marks.where(_draw(seed) < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    # texts that share the least hash of their three-word shingles, as near copies mostly do, teach once
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    shingles = F.zip_with(F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.xxhash64(a, b)), F.slice(words, 3, 1 << 30), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    same = F.coalesce(F.array_min(shingles), F.xxhash64("text"))
    first = F.min_by(F.struct("doc_id", "text"), F.struct(F.xxhash64("doc_id"), "doc_id", "text"))
    return sample.groupBy(same.alias("same"), "toxic").agg(first.alias("first")).select("first.doc_id", "toxic", "first.text")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Model:
    """Learn labels (doc_id, toxic) from the documents they name."""
    from .common import settle, work_dir

    sample = settle(labelled_sample(docs, labels, per_class), f"{work_dir(docs.sparkSession, 'toxic')}/sample")
    aside = _draw(31) < 1 / 3
    entries = seed_entries()
    for entry, reading in learned_entries(sample.where(~aside)).items():
        # a word of the grammar other than an insult keeps its part; an insult weighs what labels say, if they say anything
        if entry not in entries or entries[entry].symbol == INSULT:
            entries[entry] = reading
    grammar_of = lambda: Grammar(Lexicon(entries))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammar = grammar_of()
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "features": [grammar.features(t).tolist() for t in pdf["text"]]})

    got = sample.where(aside).select("toxic", "text").mapInPandas(extract, "toxic int, features array<double>").toPandas()
    toxic = got["toxic"].to_numpy(float)
    if len(set(toxic)) < 2:
        return Model(entries, np.array(PRIOR))
    # sorted, as the order in which rows arrive must not show in the last digit
    rows = np.array(sorted([*map(float, f), t] for f, t in zip(got["features"], toxic, strict=True)))
    return Model(entries, kind_weights(rows[:, :-1], rows[:, -1]))


def scored(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """columns of docs with score (0 to 1, higher: toxic likelier) of its text."""
    rows = docs.select(*columns, *(["text"] if "text" not in columns else []))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)

    def score(batches) -> Iterator:
        import pyarrow as pa

        grammar = Grammar(Lexicon(model.entries))
        for batch in batches:
            margins = np.array([model.weights[0] + grammar.features(t) @ model.weights[1:] for t in batch.column(batch.schema.get_field_index("text")).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p, pa.float64())], names=[*columns, "score"])

    return rows.mapInArrow(score, f"{schema}, score double")


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def op11_clause_grammar(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", fold())
    model = fit(docs.where(~F.col("held_out")), labels)
    return scored(docs, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
