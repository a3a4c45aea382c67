"""Chat formatting over reply trees.

Messages point to the message they reply to. Iterative self-joins enumerate
every root-to-leaf path: each round joins the ancestors found so far with a
jump table and the jump table with itself, so a chain of n messages takes
log2(n) rounds. Branches are ranked by the sum of their messages' scores
and each chosen path is formatted as one conversation.

Format of a turn: ``<|im_start|>{role}\\n{text}<|im_end|>\\n``. Inside roles and
texts a backslash becomes ``\\s``, ``<|`` becomes ``<\\p`` and, in roles, a line
feed becomes ``\\n``. Every backslash then starts exactly one code, no text can
hold a control string, and undoing the codes gives the text back.

The loss mask is a list of spans (offset from 0, length, in code points of the
formatted string) that cover the escaped texts of assistant turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.session import stage_table

START, END = "<|im_start|>", "<|im_end|>"


def escape(c: Column, role: bool = False) -> Column:
    c = F.replace(F.replace(c, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))
    return F.replace(c, F.lit("\n"), F.lit("\\n")) if role else c


def unescape(c: Column, role: bool = False) -> Column:
    c = F.replace(c, F.lit("\\n"), F.lit("\n")) if role else c
    return F.replace(F.replace(c, F.lit("<\\p"), F.lit("<|")), F.lit("\\s"), F.lit("\\"))


def chains_from_turns(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: (tree, node, parent, role, text,
    score). Rows of a conversation are ordered by turn, then role and text
    (nulls first); each replies to the one before. Null text or role: empty.
    Rows with a null conv_id make a conversation of their own (tree null)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("_n", F.row_number().over(order))
            .select(F.col("conv_id").alias("tree"),
                    F.concat_ws("#", key, "_n").alias("node"),
                    F.when(F.col("_n") > 1, F.concat_ws("#", key, F.col("_n") - 1)).alias("parent"),
                    F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                    F.lit(0.0).alias("score")))


def root_to_leaf_paths(messages: DataFrame, rounds: int = 30) -> DataFrame:
    """(leaf, node, up): every message on the path from ``leaf`` to its root,
    ``up`` replies above the leaf. A parent that is no message ends the path
    there; a cycle never reaches a leaf's root and raises."""
    links = messages.select("node", "parent")
    known = messages.select(F.col("node").alias("parent"))
    links = links.join(known, "parent", "left_semi").select("node", "parent")
    links = stage_table(links, "links")
    leaves = messages.join(links.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
    found = stage_table(leaves.select(F.col("node").alias("leaf"), "node", F.lit(0).alias("up")), "paths")
    jump = links.select("node", F.col("parent").alias("to"))
    for k in range(rounds):
        if jump.isEmpty():
            return found
        # found holds 0 .. 2^k - 1 replies up, the jump table goes 2^k up
        higher = found.join(jump, "node").select("leaf", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        found = stage_table(found.unionByName(higher), "paths")
        far = jump.select(F.col("node").alias("from_"), F.col("to").alias("node"))
        jump = stage_table(far.join(jump, "node").select(F.col("from_").alias("node"), "to"), "jump")
    raise ValueError("reply links form a cycle or a chain too long")


def format_trees(messages: DataFrame, max_paths: int | None = None) -> DataFrame:
    """One row per chosen path: tree, path_rank (1: highest score sum, ties to
    the smaller leaf), leaf, score, n_turns, formatted, loss_spans.

    ``messages`` has tree, node (unique), parent, role, text, score; other
    columns are ignored. Null roles and texts count as empty, null scores as
    0; an empty table gives no rows. ``max_paths`` keeps the best paths of each
    tree (None: all). A path is gathered into one row, because that row is the
    result; the tree as a whole never is."""
    paths = root_to_leaf_paths(messages)
    body = messages.select(
        "tree", "node", F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("role", F.lit("")).alias("role"),
        escape(F.coalesce("role", F.lit("")), role=True).alias("erole"),
        escape(F.coalesce("text", F.lit(""))).alias("etext"))
    full = paths.join(body, "node").select(
        "leaf", "tree", "up", "score",
        F.concat(F.lit(START), "erole", F.lit("\n")).alias("head"), "etext", (F.col("role") == "assistant").alias("loss"))
    gathered = (full.groupBy("leaf").agg(
        F.first("tree").alias("tree"), F.sum("score").alias("score"),
        F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "head", "etext", "loss"))).alias("turns")))
    # offset of each turn's text: everything before it, then its own head
    tail = F.lit(len(END) + 1)
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<offset:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["end"] + F.length(t["head"]) + F.length(t["etext"]) + tail).alias("end"),
            F.when(t["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["end"] + F.length(t["head"])).alias("offset"), F.length(t["etext"]).alias("length")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    out = gathered.select(
        "tree", "leaf", "score", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["etext"], F.lit(END + "\n"))), "").alias("formatted"),
        spans.alias("loss_spans"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    out = out.withColumn("path_rank", rank)
    return out if max_paths is None else out.where(F.col("path_rank") <= max_paths)


def read_turns(formatted: Column) -> Column:
    """array<struct<role,text>> parsed back from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(p, "\n", 1), role=True).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END) - 1)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """Texts under the loss mask, unescaped, in order, as one string."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["offset"] + 1, s["length"]))), "")
