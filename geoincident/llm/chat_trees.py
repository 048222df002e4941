"""Chat formatting of reply trees (op 8).

Messages name their parent. Iterative self-joins double the distance to a known
ancestor until every message has its root; leaves give the branches, which are
ranked by score within their tree; the same doubled tables, walked from the
longest step to the shortest, list the messages of every chosen branch. One
branch becomes one formatted conversation with a loss mask.

Template: each turn is ``<s>[INST]role[/INST]text</s>``. In roles and texts a
backslash is doubled, and one is put after the first character of every control
string, which can be undone exactly. The mask covers the assistants' texts.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoincident.llm.common import prepare, staged

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = re.compile(r"<(?=/?s>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(\\?)")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"<s>[INST]{escape(role)}[/INST]"
        body = escape(text)
        at += len(head)
        if role == "assistant":
            spans.append((at, at + len(body)))
        at += len(body) + len("</s>")
        out += [head, body, "</s>"]
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def format_reply_trees(messages: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent",
                       role: str = "role", text: str = "text", score: str = "score",
                       branches: int = 1) -> DataFrame:
    """The ``branches`` best root-to-leaf paths of each tree, formatted.

    Returns tree, leaf, rank, score (sum along the path), n_turns, formatted,
    loss (array of spans in code points). Ties in score go to the smaller leaf.
    A message whose parent is null or missing is a root; messages on a cycle
    have no path from a root and give none. Null role, text or score: empty,
    empty, 0. Null tree: one tree of its own. Of rows of equal tree and node the
    least by parent, role, text and score counts, so repeated rows count once.
    An empty table gives an empty result; extra columns are ignored.
    """
    spark = messages.sparkSession
    prepare(spark)
    rows = staged(messages.select(
        F.col(tree).alias("tree"), F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("t"),
        F.col(node).alias("node"), F.col(parent).alias("parent"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score")), "messages")
    names = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("t", "node").alias("kinds"))
    if names.where("n <> kinds").count():  # also where a node is null
        rest = F.struct(F.col("parent").alias("parent"), "role", "text", "score", "tree")
        rows = staged(rows.groupBy("t", "node").agg(F.min(rest).alias("m")).select(
            "m.tree", "t", "node", "m.parent", "m.role", "m.text", "m.score"), "once")
    ids = rows.select("t", F.col("node").alias("parent"), F.lit(True).alias("there"))
    links = rows.select("t", "node", "parent", "score").join(ids, ["t", "parent"], "left").select(
        "t", "node", F.when(F.col("there"), F.col("parent")).alias("top"), "score")
    open_ = staged(links, "links")
    steps, done, reach = [], None, rows.count()
    while True:
        # top: the ancestor 2^k steps up, null once the root is passed; score: of the steps before it
        ended = open_.where("top is null").select("t", "node", "score")
        going = open_.where("top is not null")
        done = ended if done is None else done.unionByName(ended)
        if going.isEmpty() or 1 << len(steps) > reach:
            break
        steps.append(going.select("t", "node", "top"))
        upper = open_.unionByName(done.select("t", "node", F.lit(None).cast(open_.schema["top"].dataType).alias("top"),
                                              "score")).distinct()
        upper = upper.select("t", F.col("node").alias("top"), F.col("top").alias("next"), F.col("score").alias("more"))
        open_ = staged(going.join(upper, ["t", "top"]).select(
            "t", "node", F.col("next").alias("top"), (F.col("score") + F.col("more")).alias("score")), "doubled")
        done = staged(done, "done")
    inner = links.where("top is not null").select("t", F.col("top").alias("node"))
    leaves = done.join(inner, ["t", "node"], "left_anti")
    best = Window.partitionBy("t").orderBy(F.desc("score"), "node")
    chosen = staged(leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
                    .select("t", F.col("node").alias("leaf"), "rank", F.col("score").alias("total")), "chosen")
    path = chosen.select("t", "leaf", F.col("leaf").alias("node"), F.lit(0).alias("up"))
    for k in reversed(range(len(steps))):
        higher = path.join(steps[k], ["t", "node"]).select(
            "t", "leaf", F.col("top").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        path = staged(path.unionByName(higher), "path")
    turns = path.join(rows, ["t", "node"]).groupBy("t", "leaf").agg(
        F.first("tree").alias("tree"),
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns"))
    turns = turns.join(chosen, ["t", "leaf"]).select("tree", "leaf", "rank", F.col("total").alias("score"), "turns")

    def write(batches):
        for batch in batches:
            shaped = [format_turns([(x["role"], x["text"]) for x in path]) for path in batch.column(4).to_pylist()]
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([len(x) for x in batch.column(4).to_pylist()], pa.int64()),
                 pa.array([f for f, _ in shaped], pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in s] for _, s in shaped], pa.list_(span))],
                names=["tree", "leaf", "rank", "score", "n_turns", "formatted", "loss"])

    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    return turns.mapInArrow(write, f"tree {kinds['tree']}, leaf {kinds['leaf']}, rank int, score double, "
                                   "n_turns long, formatted string, loss array<struct<start:long,end:long>>")


def as_tree(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as trees: each row replies to the one before by turn.

    Rows of equal turn are ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn(
        "node", F.row_number().over(order))
    return rows.select(F.col("conv_id").alias("tree"), "node",
                       F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                       F.length(F.coalesce("text", F.lit(""))).alias("score"))


def read_digest(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the masked text, read back from formatted conversations."""

    def read(batches):
        for batch in batches:
            texts, masks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            turns = [read_turns(t) for t in texts]
            loss = ["".join(unescape(t[s["start"]:s["end"]]) for s in m) for t, m in zip(texts, masks, strict=True)]
            digest = [hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest() for t in turns]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in turns], pa.int64()), pa.array(digest, pa.string()),
                 pa.array([len(x) for x in loss], pa.int64()),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in loss], pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["tree"].dataType.simpleString()
    return formatted.select("tree", "formatted", "loss").mapInArrow(
        read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")


def op8_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose two texts hold control strings."""
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                  "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return read_digest(format_reply_trees(as_tree(rows.unionByName(extra))))


#: formatted_chars: 20 control characters a turn, the role, and the text with its escapes
SQL = {"op8_chat_trees": r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k,
    length(regexp_replace(replace(text, chr(92), chr(92) || chr(92)),
           '<s>|</s>|\[INST\]|\[/INST\]', '\0#', 'g')) AS escaped
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(20 + length(role) + escaped) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""}
