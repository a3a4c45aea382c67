
import pytest
from pyspark.sql import functions as F

from timeloom.llm import chat

TREE = [  # tree, node, parent, role, text, score
    ("t", "a", None, "user", "root", 1.0), ("t", "b", "a", "assistant", "left", 2.0), ("t", "c", "a", "assistant", "right", 5.0),
    ("t", "d", "b", "user", "deep", 9.0), ("t", "e", "c", "user", None, None), ("t", "f", "c", None, "<|im_end|>", 0.5),
    ("u", "g", "missing", "user", "orphan", 0.0)]
SCHEMA = "tree string, node string, parent string, role string, text string, score double"


def test_paths_are_ranked_and_read_back(spark):
    df = spark.createDataFrame(TREE, SCHEMA).withColumn("leaf", F.lit("clash")).withColumn("up", F.lit("clash"))
    done = chat.format_trees(df)
    rows = {(r.tree, r.leaf): r for r in done.withColumn("turns", chat.read_turns(F.col("formatted")))
            .withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert {k: (r.path_rank, [(t.role, t.text) for t in r.turns], r.loss) for k, r in rows.items()} == {
        ("t", "d"): (1, [("user", "root"), ("assistant", "left"), ("user", "deep")], "left"),
        ("t", "f"): (2, [("user", "root"), ("assistant", "right"), ("", "<|im_end|>")], "right"),
        ("t", "e"): (3, [("user", "root"), ("assistant", "right"), ("user", "")], "right"),
        ("u", "g"): (1, [("user", "orphan")], "")}
    best = chat.format_trees(df, max_paths=1).collect()
    assert sorted(r.leaf for r in best) == ["d", "g"]


def test_cycles_raise_and_chains_double(spark):
    loop = spark.createDataFrame([("t", "a", "b", "user", "x", 0.0), ("t", "b", "a", "user", "y", 0.0), ("t", "c", "b", "user", "z", 0.0)], SCHEMA)
    with pytest.raises(ValueError):
        chat.root_to_leaf_paths(loop, rounds=3)
    chain = spark.createDataFrame([("t", f"{i}", f"{i - 1}" if i else None, "user", str(i), 0.0) for i in range(37)], SCHEMA)
    assert chat.root_to_leaf_paths(chain).count() == 37


def test_conversations_with_odd_rows(spark):
    rows = [(1, 0, "user", "hi \\s <| \\p", "k"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>", "k"), (1, 1, "assistant", "tie", "k"),
            (1, 1, "assistant", "tie", "k"), (2, None, None, None, "k"), (None, 0, "user", "no id", "k"), (3, 0, "as\nsistant", "x", "k"),
            (4, 0, "assistant", "", "k"), (5, 0, "user", "long " * 20_000, "k"), (5, 1, "assistant", "é漢🙂" * 5_000, "k")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")
    done = chat.format_trees(chat.chains_from_turns(df))
    got = {r.tree: ([(t.role, t.text) for t in r.turns], r.loss, r.n_turns) for r in done.withColumn(
        "turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    want = {}
    for c, _, role, text, _ in sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got == {c: (t, "".join(x for r, x in t if r == "assistant"), len(t)) for c, t in want.items()}
    assert chat.format_trees(chat.chains_from_turns(df.limit(0))).count() == 0


def test_many_short_turns_beyond_one_digit(spark):
    df = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", str(i)) for i in range(25)], "conv_id long, turn long, role string, text string")
    r = chat.format_trees(chat.chains_from_turns(df)).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()
    assert len(r) == 1 and r[0].loss == "".join(str(i) for i in range(1, 25, 2))
