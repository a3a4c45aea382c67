"""Sources, sinks and the user hooks (pytest-only ids)."""

import pytest
from pyspark.sql import functions as F

from timeloom.functions import scalar as S
from timeloom.operators import federate as fd
from timeloom.operators.collate import Entry, Reference, collate
from timeloom.operators.relational import CardinalityError, checked_join, join_guard, round_shard
from timeloom.sources import io

from conftest import SF


def test_scan_glob_optional_and_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("site", F.when(F.col("id") < 4, "A").otherwise("B"))
    io.sink_parquet(df, str(tmp_path / "t"), partition_by="site")
    back = io.scan_glob(spark, str(tmp_path / "t" / "site=*"))
    assert back.count() == 10
    got = io.scan_optional(spark, {"have": str(tmp_path / "t"), "missing": str(tmp_path / "nope")})
    assert set(got) == {"have"}
    io.sink_csv(df.groupBy("site").count(), str(tmp_path / "c"))
    grid = io.scan_csv_grid(spark, str(tmp_path / "c"), "site string, count long")
    assert {r.site: r["count"] for r in grid.collect()} == {"A": 4, "B": 6}


def test_schema_discover_drop_cast(spark):
    df = spark.createDataFrame([(1, True, False, 0.5)], "subject_id int, `X//a_past` boolean, `X//a_future` boolean, s_past double")
    assert io.schema_discover(df) == ["X//a"]
    assert io.drop_optional(df, "nope", "s_past").columns == ["subject_id", "X//a_past", "X//a_future"]
    assert dict(io.cast_key(df, "subject_id").dtypes)["subject_id"] == "string"


def test_load_vocab_yaml(spark, tmp_path):
    p = tmp_path / "tokenizer.yaml"
    p.write_text("lookup:\n  UNK: 0\n  BOS: 1\n  LABEL//x: 2\n")
    v = io.load_vocab(spark, str(p))
    assert [(r.token, r.token_id) for r in v.collect()] == [("UNK", 0), ("BOS", 1), ("LABEL//x", 2)]


def test_join_guard(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "z")], "k int, w string")
    with pytest.raises(CardinalityError):
        join_guard(a, "k")
    assert checked_join(a, b, "k", "inner", "m:1").count() == 2
    with pytest.raises(CardinalityError):
        checked_join(a, b, "k", "inner", "1:1")


def test_expr_hook_entries(spark):
    """filter_expr / with_col_expr / agg_expr are Spark SQL text."""
    ev = spark.createDataFrame([("A", 1, 10, "lab", 7.5, 1), ("A", 1, 10, "lab", 2.0, 2), ("A", 1, 10, "vit", 3.0, 3)],
                               "site string, subject_id int, group_id int, cat string, v double, t int") \
        .withColumn("ts", F.timestamp_seconds("t"))
    ref = spark.createDataFrame([("A", 1, 10)], "site string, subject_id int, group_id int")
    R = Reference("ref", "subject_id", "group_id", "ts", "ts")
    es = [Entry("ev", "LAB", code="cat", time="ts", numeric_value="v", filter_expr=["cat = 'lab'", "v >= 6.5"]),
          Entry("ev", "LABEL", code="code", time="ts", filter_expr="v >= 2", with_col_expr={"code": "'hi_init'"},
                agg_expr="first"),
          Entry("ev", "MAX", code="code", time="ts", numeric_value="mv", with_col_expr={"code": "'max'"},
                agg_expr=["max(v) AS mv", "min(ts) AS ts", "min(code) AS code"])]
    out = {r.prefix: r for r in collate({"ev": ev}, ref, R, es).collect()}
    assert out["LAB"].numeric_value == 7.5
    assert out["LABEL"].code == "hi_init" and out["LABEL"].time.second == 1
    assert out["MAX"].numeric_value == 7.5


def test_shards_disjoint_complete(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    parts = [set(r.k for r in round_shard(df, "k", r, 4).collect()) for r in range(1, 5)]
    assert sum(len(p) for p in parts) == 500 and len(set().union(*parts)) == 500


def test_splits_never_cut_a_group(spark):
    from timeloom.operators.collate import subject_split
    df = spark.range(2000).select((F.col("id") % 97).alias("g"), F.col("id").alias("s"))
    sp = subject_split(df, "g")
    assert sp.groupBy("g").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    shares = {r.split: r["count"] / 2000 for r in sp.groupBy("split").count().collect()}
    assert set(shares) <= {"train", "tuning", "held_out"}


def test_strategies_train_differently_and_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.normal(size=(90, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=90) > 0).astype(int)
    df = spark.createDataFrame([(i, i % 3, x[i].tolist(), int(y[i])) for i in range(90)], "id int, client int, f array<double>, y int")
    shard = {r.id: r.s for r in df.select("id", (F.floor(S.hash_unit("id", 0) * 2) + 1).alias("s")).collect()}
    s = np.array([shard[i] for i in range(90)])
    x1 = np.concatenate([x, np.ones((90, 1))], axis=1)

    def reference(strategy):
        w, m, v = np.zeros(4), np.zeros(4), np.zeros(4)
        for r in (1, 2):
            lr, total, n_all = 0.5 * 0.5 * (1 + np.cos(np.pi * (r - 1) / 2)), np.zeros(4), 0
            for c in range(3):
                rows = (s == r) & (np.arange(90) % 3 == c)
                local = w.copy()
                for _ in range(2):
                    local -= lr * x1[rows].T @ (1 / (1 + np.exp(-x1[rows] @ local)) - y[rows]) / rows.sum()
                total, n_all = total + local * rows.sum(), n_all + rows.sum()
            a = total / n_all
            if strategy == "fedavg":
                w = a
            elif strategy == "fedavgm":
                m = 0.5 * m + (w - a)
                w = w - m
            else:
                m, v = 0.9 * m + 0.1 * (a - w), 0.99 * v + 0.01 * (a - w) ** 2
                w = w + 0.1 * m / (np.sqrt(v) + 1e-9)
        p = 1 / (1 + np.exp(-x1 @ w))
        return w, -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    seen = []
    for strategy in fd.STRATEGIES:
        weights, rounds = fd.fed_train(df, "client", "f", "y", dim=3, n_rounds=2, local_steps=2, strategy=strategy)
        got = np.array([r.value for r in weights.orderBy("pos").collect()])
        want, loss = reference(strategy)
        assert np.allclose(got, want) and abs(rounds.where("round = 2").first().loss - loss) < 1e-9
        seen.append(tuple(got))
    assert len(set(seen)) == 3
    with pytest.raises(ValueError):
        fd.fed_train(df, "client", "f", "y", dim=3, strategy="other")


def test_strategy_hook_and_fold(spark):
    assert set(fd.STRATEGIES) == {"fedavg", "fedavgm", "fedadam"}
    targets = [1.0, 0.5, 2.0]
    avg = spark.createDataFrame([(0, r, a) for r, a in zip((3, 1, 2), [targets[2], targets[0], targets[1]])],
                                "pos int, round int, a double")
    x, v = 0.0, 0.0
    for t, a in enumerate(targets):
        g = x - a
        v = g if t == 0 else 0.5 * v + g
        x = x - 1.0 * v
    assert abs(fd.fed_avg_momentum(avg).first().value - x) < 1e-12
    x, m, v = 0.0, 0.0, 0.0
    for a in targets:
        dlt = a - x
        m = 0.9 * m + 0.1 * dlt
        v = 0.99 * v + 0.01 * dlt * dlt
        x = x + 0.1 * m / (v ** 0.5 + 1e-9)
    assert abs(fd.fed_adam(avg).first().value - x) < 1e-12


def test_replicate_hook_rows(spark):
    from timeloom.operators.bootstrap import replicate
    df = spark.createDataFrame([(1, "o"), (2, "o")], "subject_id int, outcome string")
    r = replicate(df, 10, 0, ["outcome", "subject_id"])
    assert set(r.columns) >= {"rep", "w"} and r.filter("w < 1").count() == 0


def test_distance_hook_uses_builtin(spark):
    """The distance runs as built-in window expressions (no Python UDF)."""
    from timeloom.operators.describe import site_divergence
    st = spark.createDataFrame([("A", "g_Q0", 1.0), ("B", "g_Q1", 1.0)], "site string, token string, frequency double")
    df = site_divergence(st)
    assert "PythonUDF" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.first().w1 == 1.0


def test_incremental_sink(spark, tmp_path):
    from timeloom.streaming import sink_parquet_incremental
    src = tmp_path / "in"
    df = spark.range(6).withColumn("site", F.lit("A"))
    df.write.parquet(str(src / "a"))
    import uuid
    sink_parquet_incremental(spark, str(src / "a"), df.schema, str(tmp_path / "out"), f"t{uuid.uuid4().hex}",
                             transform=lambda s: s.filter("id % 2 = 0"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
