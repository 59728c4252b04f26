r"""Conversation structure repair as a lightest derivation, found by Knuth's agenda.

The rows of a conversation are edited until their role initials read `(s?(ua)+)?`. The search is weighted deduction:
an item (i, q) says that the rows from i on can be edited to lead state q of that pattern's automaton to its
end; edits are axioms of their own, and a deduction joins an edit with the item of what follows it. A weight is (cost,
rows consumed, audit), where audit lists the edits' initials, and weights of a deduction's tails are added and
strung together. All derivations of an item consume the same rows, so it is (cost, audit) that decides; the rows between
make every deduction superior (no lighter than its tails) although keeping a row costs nothing. So the agenda (Knuth,
1977) pops items in the order of their final weights, each once, and ends when the goal item is popped.
An edit stands in front of what follows it, which keeps deductions monotone: the same letter in front of two audits
doesn't change their order.

Long conversations go in blocks of `BLOCK` rows. For each pair of states before and after a block the agenda gives its lightest
derivation; no insertion ends a block, so of two audits of a block none begins the other, and the lightest way up to
a state stays the lightest whatever follows. Up to four ways (cost, audit, running digest) go along.

Scale: faults that need other rows (texts seen earlier) come from a grouping by digest, whose groups with several rows
alone are joined back, salted if hot. Then rows are shuffled once by conversation, sorted (which spills) and
streamed: a task holds a block of texts and one byte a row of audit. A conversation's digest is that of one
string, so one task has to read a conversation in order, however long; nothing else is done there.

Edge cases: null texts and roles are one space, and so are a null conv_id and turn in the checksum; null
conv_ids are one conversation; null turns come first and leave gaps unchanged; rows with one turn go by role, then text.
Repeated rows are duplicates. Roles of other initials are kept nowhere, an empty role has no initial. A conversation all of whose
rows are dropped has zeros, an empty audit and the empty string's digest. Texts are read whole. An empty table gives an empty
result; other columns are ignored. Gaps stop at the largest long.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import freed_shuffles, join_hot, settle, work_dir

#: Rows, and characters, of a block at most (one text may be longer).
BLOCK = 1024
BLOCK_CHARS = 8 << 20
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (BEGIN, ASSISTANT)
_STEP = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"
_LONG = (1 << 63) - 1
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

Weight = tuple[int, int, str]


class Deduction(NamedTuple):
    head: object
    tails: tuple


def joined(weights: Iterable[Weight]) -> Weight:
    """Costs and consumed rows add up, audits are strung together."""
    cost, rows, audit = 0, 0, ""
    for c, r, a in weights:
        cost, rows, audit = cost + c, rows + r, audit + a
    return cost, rows, audit


def lightest(axioms: dict, deductions: list[Deduction], goals: set, combine: Callable[[Iterable[Weight]], Weight] = joined) -> dict:
    """Final weights of the items popped until all goals are final (or none is left). combine has to be monotone and
    superior in each weight."""
    uses: dict = {}
    for d in deductions:
        left = [len(d.tails), d]
        for tail in d.tails:
            uses.setdefault(tail, []).append(left)
    agenda, final, open_goals = [(w, item) for item, w in axioms.items()], {}, set(goals)
    heapq.heapify(agenda)
    while agenda and open_goals:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        open_goals.discard(item)
        for left in uses.get(item, ()):
            left[0] -= 1
            if not left[0] and left[1].head not in final:
                heapq.heappush(agenda, (combine([final[t] for t in left[1].tails]), left[1].head))
    return final


class Row(NamedTuple):
    role: str
    text: str
    fault: str

    @property
    def initial(self) -> str:
        return self.role[:1]


def fault_of(text: str, seen: bool) -> str:
    """b(lank), d(uplicate), t(runcated) or none."""
    bare = text.strip(_BLANKS)
    return "b" if not bare else "d" if seen else "t" if bare[-1] not in ".!?" else ""


def _expected(state: int) -> str:
    return "a" if state == USER else "u"


def _item(i: int, state: int) -> tuple:
    return ("rest", i, state)


def block_system(rows: list[Row], ends: Iterable[int], last: bool) -> tuple[dict, list[Deduction]]:
    """Axioms and deductions of a block that leads to one of the states `ends`; insertions may end the last one."""
    axioms: dict = {_item(len(rows), q): (0, 0, "") for q in ends}
    axioms |= {("edit", -1, "I", c): (INSERT, 0, "I") for c in "ua"}
    deductions = []
    for i in range(len(rows) + 1):
        if i < len(rows) or last:
            for q in range(4):
                c = _expected(q)
                deductions.append(Deduction(_item(i, q), (("edit", -1, "I", c), _item(i, _STEP[q, c]))))
        if i == len(rows):
            break
        row = rows[i]
        axioms["edit", i, "D", ""] = (DELETE, 1, "D")
        deductions += [Deduction(_item(i, q), (("edit", i, "D", ""), _item(i + 1, q))) for q in range(4)]
        if row.fault in ("b", "d"):
            continue
        extra = TRUNCATED * (row.fault == "t")
        edits = [("K", row.initial, KEEP)] + [("R", c, REROLE) for c in "ua"]
        for letter, c, cost in edits:
            axioms["edit", i, letter, c] = (cost + extra, 1, letter)
            deductions += [Deduction(_item(i, q), (("edit", i, letter, c), _item(i + 1, _STEP[q, c]))) for q in range(4) if (q, c) in _STEP]
    return axioms, deductions


class Way(NamedTuple):
    cost: int
    audit: str
    digest: object
    empty: bool


def follow(way: Way, state: int, rows: list[Row], cost: int, audit: str) -> Way:
    """The way after the edits of audit, with the repaired rows in its digest."""
    digest, empty, i = way.digest.copy(), way.empty, 0
    for letter in audit:
        if letter != "D":
            row = rows[i] if letter != "I" else None
            initial = row.initial if letter == "K" else _expected(state)
            role = row.role if letter == "K" else {"u": "user", "a": "assistant"}[initial]
            digest.update(("" if empty else "\n").encode() + f"{role}:{row.text if row else ''}".encode("utf-8", "surrogatepass"))
            state, empty = _STEP[state, initial], False
        i += letter != "I"
    return Way(way.cost + cost, way.audit + audit, digest, empty)


class Repair:
    """Takes the rows of a conversation in order; what is held is a block and a way for each state."""

    def __init__(self) -> None:
        self.rows: list[Row] = []
        self.chars = 0
        self.ways = {BEGIN: Way(0, "", hashlib.sha256(), True)}
        self.counts = {"b": 0, "d": 0, "t": 0, "": 0}
        self.illegal, self.turns, self.least, self.turn, self.before = 0, 0, None, None, None

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        row = Row(role, text, fault_of(text, seen))
        self.counts[row.fault] += 1
        if self.before is not None:
            self.illegal += self.before + row.initial not in _LEGAL
        self.before = row.initial
        if turn is not None:
            self.turns += self.turn != turn
            self.least = turn if self.least is None else self.least
            self.turn = turn
        if len(self.rows) >= BLOCK or self.chars + len(text) > BLOCK_CHARS:
            self._pass()
        self.rows.append(row)
        self.chars += len(text)

    def _pass(self) -> None:
        """The lightest way to each state after the block."""
        ways = {}
        for end in range(4):
            best = self._best([end], last=False)
            if best is not None:
                ways[end] = best
        self.ways, self.rows, self.chars = ways, [], 0

    def _best(self, ends, last: bool) -> Way | None:
        axioms, deductions = block_system(self.rows, ends, last)
        goals = {_item(0, q) for q in self.ways}
        final = lightest(axioms, deductions, goals)
        found = [(w.cost + final[g][0], w.audit + final[g][2], q) for q, w in self.ways.items() if (g := _item(0, q)) in final]
        if not found:
            return None
        _, _, q = min(found)
        return follow(self.ways[q], q, self.rows, final[_item(0, q)][0], final[_item(0, q)][2])

    def result(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)"""
        way = self._best(ACCEPTING, last=True)
        gaps = 0 if self.turn is None else min(self.turn - self.least + 1 - self.turns, _LONG)
        return gaps, self.counts["b"], self.counts["d"], self.counts["t"], self.illegal, way.cost, way.audit, way.digest.hexdigest()


_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, role, text, digest, later), sorted by conversation and place; a null digest is no row."""
    now, repair, before, done = None, None, None, []

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        done.clear()
        types = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in _OUT.split(", ")])

    for batch in batches:
        for conv, turn, role, text, digest, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if repair is None or conv != now:
                if repair is not None:
                    done.append((now, *repair.result()))
                now, repair, before = conv, Repair(), None
            if digest is not None:
                # equal rows of one turn stand side by side
                repair.add(turn, role, text, later or (digest, turn) == before)
                before = (digest, turn)
        if done:
            yield flushed()
    if repair is not None:
        done.append((now, *repair.result()))
        yield flushed()


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, kind) after damage; dropped rows stay, with a null text, as traces of their conversation."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(name("conv_id"), F.lit(":"), name("turn")), "UTF-8")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), name("role").alias("role"), name("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 0, F.lit(None)).when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))})
    return rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("copy", "kind")


def _digest() -> Column:
    """128 bits that equal rows of a conversation share; null where there is no row."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.encode(F.concat(conv, F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text"), "UTF-8")))


def repaired(rows: DataFrame) -> DataFrame:
    """The repair of each conversation of rows (conv_id, turn, role, text); rows with a null text are traces alone."""
    spark, work = rows.sparkSession, work_dir(rows.sparkSession, "repair")
    with freed_shuffles(spark):
        rows = rows.withColumn("digest", _digest())
        place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
        # of texts that stand once in their conversation nothing has to be known
        often = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        often = settle(often, f"{work}/repeated")
        hot = settle(often.where(F.col("n") > common.HOT_ROWS).select("digest"), f"{work}/hot")
        marked = join_hot(rows, often.select("digest", "first"), "digest", "turn", hot, "left")
        later = F.coalesce(F.col("first").isNotNull() & (place != F.col("first")), F.lit(False))
        marked = marked.select("conv_id", "turn", "role", "text", "digest", later.alias("later"))
        in_order = marked.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
        return settle(in_order.mapInArrow(_repairs, _OUT), f"{work}/repaired")


def op12_derivation(spark, sf_dir: str) -> DataFrame:
    return repaired(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


SQL = r"""
WITH RECURSIVE h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]), lambda x, k: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))) % 20 AS kind
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM h WHERE kind <> 0)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS c FROM d
), e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM n
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair
  FROM e
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM f GROUP BY conv_id
), inserts(p, m, ins, ic) AS (
  VALUES ('B', 'B', '', 0), ('B', 'U', 'I', 2), ('B', 'A', 'II', 4), ('S', 'S', '', 0), ('S', 'U', 'I', 2), ('S', 'A', 'II', 4), ('U', 'U', '', 0), ('U', 'A', 'I', 2), ('A', 'A', '', 0), ('A', 'U', 'I', 2)
), edits(m, letter, c, q, ec) AS (
  VALUES ('B', 'K', 's', 'S', 0), ('B', 'K', 'u', 'U', 0), ('S', 'K', 'u', 'U', 0), ('U', 'K', 'a', 'A', 0), ('A', 'K', 'u', 'U', 0), ('B', 'R', '*', 'U', 2), ('S', 'R', '*', 'U', 2), ('U', 'R', '*', 'A', 2), ('A', 'R', '*', 'U', 2),
    ('B', 'D', '*', 'B', 3), ('S', 'D', '*', 'S', 3), ('U', 'D', '*', 'U', 3), ('A', 'D', '*', 'A', 3)
), moves AS (
  SELECT p, letter, c, q, ic + ec AS mc, ins || letter AS step FROM inserts JOIN edits USING (m)
), v AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 'B' AS q, {'cost': CAST(0 AS BIGINT), 'audit': ''} AS w FROM facts
  UNION ALL
  SELECT v.conv_id, v.i + 1, m.q, min({'cost': CAST(v.w.cost + mc + CASE WHEN fault = 't' AND letter <> 'D' THEN 1 ELSE 0 END AS BIGINT), 'audit': v.w.audit || step})
  FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i + 1 JOIN moves m ON m.p = v.q AND (m.c = '*' OR m.c = f.c)
  WHERE letter = 'D' OR fault NOT IN ('b', 'd') GROUP BY v.conv_id, v.i, m.q
), best AS (
  SELECT v.conv_id, min({'cost': CAST(w.cost + cc AS BIGINT), 'audit': w.audit || close}) AS w
  FROM v JOIN facts ON facts.conv_id IS NOT DISTINCT FROM v.conv_id AND v.i = n JOIN (VALUES ('B', '', 0), ('A', '', 0), ('U', 'I', 2), ('S', 'II', 4)) t(q, close, cc) ON t.q = v.q GROUP BY v.conv_id
), letters AS (
  SELECT conv_id, letter, pos, sum(CAST(letter <> 'I' AS INT)) OVER w AS i, sum(CAST(letter <> 'D' AS INT)) OVER w AS j
  FROM (SELECT conv_id, unnest(string_split(w.audit, '')) AS letter, generate_subscripts(string_split(w.audit, ''), 1) AS pos FROM best WHERE w.audit <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
), lines AS (
  SELECT l.*, f.role, CASE WHEN letter <> 'I' THEN f.text ELSE '' END AS text, max(CASE WHEN j = 1 AND letter = 'K' AND f.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS s
  FROM letters l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i WHERE letter <> 'D'
), told AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos)) AS digest FROM lines GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(w.cost, 0) AS cost, coalesce(w.audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM o.conv_id
"""
