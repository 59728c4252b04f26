"""Chat formatting of reply trees: root-to-leaf paths by iterative self-joins, ranked, one conversation each.

A message table (conv_id, msg_id, parent_id, role, text, score) is a forest per conversation. `paths`
doubles jump pointers: in round k each path holds the ancestors within 2**k steps, so a depth of d takes
log2(d) rounds of joins of id columns, and no more rounds are run than the largest conversation can need; the
texts join once, at the end. `format_paths` writes each chosen path as one string, with the spans that carry loss, and `parse` reads such strings back. All of it is
DataFrame functions.

Template, per turn: `### role: text </turn>` and a line feed. In role and text a backslash becomes \\s,
`</turn>` \\e and `###` \\h (in a role, a colon also \\c), so no control string is left inside, and a
backslash in formatted text always starts one of these codes; reading back replaces \\c, \\h, \\e, then \\s.

Edge cases: null role or text is empty; a null conv_id is a conversation of its own; a null msg_id is answered by none; a parent that doesn't exist (or is null) makes a root; messages on a
cycle or below one have no root and give no path; of several rows with one (conv_id, msg_id) `conversations` takes
the least by (parent_id, role, text, score); repeated rows of a query's table become turns of their own, in the
order (turn, role, text); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import freed_shuffles, settle, work_dir

CLOSE = " </turn>\n"
LOSS_ROLE = "assistant"
KEY = ["conv_id", "msg_id"]


def escape(text: Column) -> Column:
    for plain, code in (("\\", "\\s"), ("</turn>", "\\e"), ("###", "\\h")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in ((":", "\\c"), ("###", "\\h"), ("</turn>", "\\e"), ("\\", "\\s")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def distinct_messages(messages: DataFrame) -> DataFrame:
    """One row for each (conv_id, msg_id): the least by (parent_id, role, text, score)."""
    rest = ["parent_id", "role", "text", "score"]
    return messages.groupBy(*KEY).agg(F.min(F.struct(*rest)).alias("least")).select(*KEY, *(f"least.{c}" for c in rest))


def paths(messages: DataFrame, work: str) -> DataFrame:
    """(conv_id, leaf, msg_id, up): each message of each root-to-leaf path; up counts steps from the leaf.

    messages has each (conv_id, msg_id) once; a message whose ancestors don't end in a root is left out."""
    with freed_shuffles(messages.sparkSession):
        return _paths(messages, work)


def _paths(messages: DataFrame, work: str) -> DataFrame:
    nodes = messages.select(*KEY, "parent_id")
    known = nodes.select("conv_id", F.col("msg_id").alias("parent_id"))
    jump = settle(nodes.join(known, ["conv_id", "parent_id"]).select(*KEY, F.col("parent_id").alias("to")), f"{work}/jump-0")
    leaves = nodes.select(*KEY).join(jump.select("conv_id", F.col("to").alias("msg_id")).distinct(), KEY, "left_anti")
    reach = leaves.select("conv_id", F.col("msg_id").alias("leaf"), "msg_id", F.lit(0).cast("long").alias("up"))
    # so many rounds lead beyond every root, so whatever still has an ancestor then is on a cycle or below one
    largest = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 1
    for k in range((largest - 1).bit_length() + 1):
        more = reach.join(jump, KEY).select("conv_id", "leaf", F.col("to").alias("msg_id"), (F.col("up") + (1 << k)).alias("up"))
        reach = settle(reach.unionByName(more), f"{work}/reach-{k}")
        second = jump.select("conv_id", F.col("msg_id").alias("to"), F.col("to").alias("further"))
        jump = settle(jump.join(second, ["conv_id", "to"]).select(*KEY, F.col("further").alias("to")), f"{work}/jump-{k + 1}")
        if jump.isEmpty():
            return reach
    return reach.join(jump.select("conv_id", F.col("msg_id").alias("leaf")), ["conv_id", "leaf"], "left_anti")


def rank_branches(reach: DataFrame, messages: DataFrame, keep: int | None) -> DataFrame:
    """(conv_id, leaf, score, branch): the paths of a conversation by descending mean score, null scores as 0,
    then by leaf; all of them, or the first `keep`."""
    scores = reach.join(messages.select(*KEY, "score"), KEY).groupBy("conv_id", "leaf").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("score"))
    ranked = scores.withColumn("branch", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "leaf")))
    return ranked if keep is None else ranked.where(F.col("branch") <= keep)


def format_paths(reach: DataFrame, ranked: DataFrame, messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, branch, score, text, loss_spans): loss_spans are (start, length) in code points of text."""
    rows = reach.join(ranked, ["conv_id", "leaf"]).join(messages.select(*KEY, "role", "text"), KEY)
    empty = F.lit("")
    role, text = F.coalesce("role", empty), escape(F.coalesce("text", empty))
    rows = rows.select("conv_id", "branch", "score", (-F.col("up")).alias("at"), F.concat(F.lit("### "), F.replace(escape(role), F.lit(":"), F.lit("\\c")), F.lit(": ")).alias("head"), text.alias("body"), (role == loss_role).alias("loss"))
    turns = rows.groupBy("conv_id", "branch").agg(F.first("score").alias("score"), F.sort_array(F.collect_list(F.struct("at", "head", "body", "loss"))).alias("turns"))
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    step = lambda acc, t: F.struct(
        (acc["at"] + size(t)).alias("at"),
        F.when(t["loss"], F.array_append(acc["spans"], F.struct((acc["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length")))).otherwise(acc["spans"]).alias("spans"),
    )
    return turns.select("conv_id", "branch", "score", F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("text"), F.aggregate("turns", start, step)["spans"].alias("loss_spans"))


def conversations(messages: DataFrame, work: str, keep: int | None = None, loss_role: str = LOSS_ROLE) -> DataFrame:
    """The formatted paths of messages, of each conversation all or the `keep` best ones, written at work."""
    # ids as structs, which are equal if both hold null
    parent = F.when(F.col("parent_id").isNotNull(), F.struct(F.col("parent_id").alias("msg_id")))
    keyed = distinct_messages(messages).withColumns({"conv_id": F.struct("conv_id"), "msg_id": F.struct("msg_id"), "parent_id": parent})
    messages = settle(keyed, f"{work}/messages")
    reach = paths(messages, work)
    formatted = format_paths(reach, rank_branches(reach, messages, keep), messages, loss_role)
    return settle(formatted.withColumn("conv_id", F.col("conv_id.conv_id")), f"{work}/formatted")


def parse(formatted: DataFrame) -> DataFrame:
    """Adds turns (role, text), read back from text, and loss, the unescaped text under the loss spans."""
    pieces = F.split("text", r" </turn>\n")
    body = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    turn = lambda t: F.struct(unescape(F.substring_index(F.substr(t, F.lit(5)), ": ", 1)).alias("role"), unescape(F.substr(t, F.locate(": ", t) + 2)).alias("text"))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["length"]))), "")
    return formatted.withColumns({"turns": F.transform(body, turn), "loss": loss})


def linear_messages(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees without branches: each row answers the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("msg_id"))
    return numbered.select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(1.0).alias("score"))


#: Text of both rows of the conversation that the contract adds.
PROBE = "\\### Assistant: </turn> ok"


def op3_reply_trees(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    read = parse(conversations(linear_messages(table.unionByName(probe)), work_dir(spark, "trees")))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(whole, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode(F.col("loss"), "UTF-8"), 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


_SAFE = "replace(replace(replace(coalesce({0}, ''), chr(92), chr(92) || 's'), '</turn>', chr(92) || 'e'), '###', chr(92) || 'h')"
SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(replace({_SAFE.format('role')}, ':', chr(92) || 'c')) + 2 + length({_SAFE.format('text')}) + 9) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
