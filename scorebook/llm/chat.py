"""Conversations from reply trees.

Messages point to the message they answer. Iterative self-joins double the reach of these pointers, so that a thread of
depth d takes log2(d) joins, and add up scores on the way. Branches are ranked within their tree by the sum of their scores;
from the chosen leaves the pointers enumerate the path to the root, and each path becomes one conversation of marked turns,
with the spans a language model is trained on. Only numbers travel while paths are built; texts join the chosen paths once.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from scorebook.llm.common import Scratch, digest, small_batches, whole

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"

_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_OPEN, _OPENED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """Text without any control string: each ``<``, backslashes, ``|`` gets one more backslash."""
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _OPENED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line: backslashes doubled, then line ends written as ``\\n``, then as a text."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points, end exclusive) of the texts of ``TRAINED`` turns."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        at += len(head)
        if role == TRAINED:
            spans.append((at, at + len(body)))
        at += len(body) + len(END) + 1
        out += [head, body, END, "\n"]
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; raises ``ValueError`` if it is not one."""
    turns, at = [], 0
    for match in _TURN.finditer(formatted):
        if match.start() != at:
            break
        turns.append((unescape_role(match[1]), unescape(match[2])))
        at = match.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at {at}")
    return turns


_RENDERED = StructType().add("text", StringType()).add("starts", ArrayType(LongType())).add("ends", ArrayType(LongType()))
_SUMMARY = (
    StructType().add("n_turns", LongType()).add("turns_sha256", StringType()).add("loss_chars", LongType()).add("loss_sha256", StringType())
)


@F.pandas_udf(_RENDERED)
def _render(turns: pd.Series) -> pd.DataFrame:
    rows = []
    for listed in turns:
        text, spans = render([(t["role"], t["text"]) for t in listed])
        rows.append((text, [s for s, _ in spans], [e for _, e in spans]))
    return pd.DataFrame(rows, columns=["text", "starts", "ends"])


@F.pandas_udf(_SUMMARY)
def _summary(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    rows = []
    for text, opened, closed in zip(texts, starts, ends, strict=True):
        turns = read_back(text)
        loss = "".join(unescape(text[s:e]) for s, e in zip(opened, closed, strict=True))
        said = "".join(f"{role}\n{body}\n" for role, body in turns)
        rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])


def climb(nodes: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """Doubled pointers, and ``node``, ``total`` (sum of scores from it to its root) of every node that has a root.

    ``nodes`` has one row per ``node`` with its ``parent`` (null: a root, as is one that is not a node or is the node itself)
    and ``score``. Pointer table k has ``node`` and its ancestor ``to`` 2^k steps above, where there is one. The sum up to that
    ancestor grows with the pointer; a node whose pointer reaches a root has its total. Nodes that run into a cycle have none.
    """
    known = nodes.select(F.col("node").alias("parent"))
    real = nodes.filter("parent != node").join(known, "parent", "left_semi")
    steps = scratch.keep(real.select("node", F.col("parent").alias("to"), F.col("score").alias("sum")), "steps")
    totals = scratch.keep(nodes.join(steps.select("node"), "node", "left_anti").select("node", F.col("score").alias("total")), "roots")
    count, pointers = nodes.count(), []
    while not steps.isEmpty():
        pointers.append(steps)
        done = totals.select(F.col("node").alias("to"), F.col("total").alias("beyond"))
        reached = steps.join(done, "to").select("node", (F.col("sum") + F.col("beyond")).alias("total"))
        totals_next = scratch.keep(totals.unionByName(reached), "totals")
        if 1 << len(pointers) > 2 * count:  # longer than any path: what is left runs into a cycle
            totals = totals_next
            break
        further = steps.select(F.col("node").alias("to"), F.col("to").alias("over"), F.col("sum").alias("more"))
        steps = scratch.keep(steps.join(further, "to").select("node", F.col("over").alias("to"), (F.col("sum") + F.col("more")).alias("sum")), "steps")
        scratch.drop(totals)
        totals = totals_next
    return pointers, totals


def ancestors(chosen: DataFrame, pointers: list[DataFrame], scratch: Scratch) -> DataFrame:
    """``leaf``, ``node``, ``up`` (steps above the leaf) for every node from each ``leaf`` of ``chosen`` to its root."""
    reached = chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up"))
    for power in reversed(range(len(pointers))):
        over = reached.join(pointers[power], "node").select("leaf", F.col("to").alias("node"), (F.col("up") + (1 << power)).alias("up"))
        wider = scratch.keep(reached.unionByName(over), "reached")
        if hasattr(reached, "_scratch_path"):
            scratch.drop(reached)
        reached = wider
    return reached


def conversations(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """Formatted branches: ``tree``, ``branch``, ``score``, ``text``, ``loss_starts``, ``loss_ends``.

    ``messages`` has ``tree``, ``msg``, ``parent`` (a ``msg`` of the tree), ``role``, ``text``, ``score``; further columns are
    not read. The ``per_tree`` branches of a tree with the largest sum of scores are formatted, ties by the leaf's ``msg``.
    A null text or role is empty, a null score 0; a null ``tree`` is a tree of its own. Of rows that repeat a message id the
    first by parent, score, role and hash of the text counts. Branches with a cycle are left out. No messages give no rows.

    Branches are ranked before they are enumerated, so a thread with an answer at each of its d steps costs d log d small
    rows, and only the chosen branches meet their texts. A conversation is one value: its texts together have to fit into a
    task, as must any row; there is no limit below that, and nothing is cut.
    """
    scratch = Scratch(messages.sparkSession, "chat")
    small_batches(messages)
    key = lambda name: F.unhex(digest("tree", name))
    given = messages.select(
        key("msg").alias("key"), F.when(F.col("parent").isNotNull(), key("parent")).alias("above"), "tree", "msg",
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), whole("role").alias("role"), whole("text").alias("text"),
    )
    # Rows get a number in a written table; from here on it stands for the message.
    rows = scratch.keep(given.withColumn("node", F.monotonically_increasing_id()), "messages")
    first = F.min(F.struct("above", "score", "role", F.xxhash64("text").alias("mark"), "node", "tree", "msg")).alias("m")
    kept = rows.groupBy("key").agg(first).select("key", "m.above", "m.score", "m.node", "m.tree", "m.msg")
    kept = scratch.keep(kept, "kept")
    parents = kept.select(F.col("key").alias("above"), F.col("node").alias("parent"))
    nodes = scratch.keep(kept.join(parents, "above", "left").select("node", "parent", "score"), "nodes")
    pointers, totals = climb(nodes, scratch)
    answered = nodes.filter("parent != node").select(F.col("parent").alias("node")).distinct()
    leaves = totals.join(answered, "node", "left_anti")
    ranked = leaves.join(kept.select("node", "tree", "msg"), "node")
    place = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "msg"))
    best = ranked.withColumn("branch", place).filter(F.col("branch") <= per_tree)
    chosen = scratch.keep(best.select(F.col("node").alias("leaf"), "tree", "branch", F.col("total").alias("score")), "chosen")
    scratch.drop(kept, nodes, totals)
    found = ancestors(chosen, pointers, scratch)
    if pointers:
        scratch.drop(*pointers)
    turns = rows.select("node", "role", "text").join(found.hint("shuffle_hash"), "node")
    parts = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text")))
    listed = turns.groupBy("leaf").agg(parts.alias("turns")).join(chosen, "leaf")
    rendered = listed.select("tree", "branch", "score", _render("turns").alias("r"))
    return rendered.select("tree", "branch", "score", "r.text", F.col("r.starts").alias("loss_starts"), F.col("r.ends").alias("loss_ends"))


def chain(rows: DataFrame) -> DataFrame:
    """Messages of linear conversations (``conv_id``, ``turn``, ``role``, ``text``): each answers the one before.

    Turns go by ``turn`` (null first), equal turns by role and text, so repeated rows are repeated turns.
    """
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    numbered = rows.select("conv_id", "turn", "role", "text").withColumn("msg", nth)
    parent = F.when(F.col("msg") > 1, F.col("msg") - 1)
    return numbered.select(F.col("conv_id").alias("tree"), "msg", parent.alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def summary(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted text finds: ``conv_id``, turns and trained text as counts and digests."""
    read = formatted.select("tree", F.length("text").cast("long").alias("formatted_chars"), _summary("text", "loss_starts", "loss_ends").alias("s"))
    return read.select(F.col("tree").alias("conv_id"), "s.n_turns", "s.turns_sha256", "s.loss_chars", "s.loss_sha256", "formatted_chars")
