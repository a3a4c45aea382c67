"""Paths used at scale that the oracle queries do not take."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from timeloom.operators import harmonize, sizing, tokenize as tkz


def test_quantile_fit_approx_close_to_exact(spark):
    ev = spark.range(5000).select(F.lit("VAL").alias("prefix"), F.lit("x").alias("code"),
                                  (F.col("id") * 1.0).alias("numeric_value"))
    ex = tkz.quantile_fit(ev).first().breaks
    ap = tkz.quantile_fit(ev, exact=False).first().breaks
    assert len(ex) == len(ap) == 9
    assert all(abs(a - b) <= 2.0 for a, b in zip(ex, ap))


def test_fitted_broadcast_only_under_bound(spark, monkeypatch):
    small = spark.createDataFrame([("a", 1)], "token string, token_id int")
    big = spark.range(100).select(F.lit("a").alias("token"))
    f = sizing.Fitted(small, 1)
    plan = f.join_to(big, "token")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    monkeypatch.setattr(sizing, "BROADCAST_MAX_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = f.join_to(big, "token")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_encounter_blocks_gap_rule(spark):
    t = dt.datetime(2024, 1, 1)
    h = lambda x: t + dt.timedelta(hours=x)
    stays = spark.createDataFrame([
        ("p", 1, h(0), h(10)), ("p", 2, h(12), h(20)),     # starts 2 h after the end: same block
        ("p", 3, h(40), h(41)),                              # 20 h gap: new block
        ("q", 4, h(0), h(1))], "patient string, stay_id int, s timestamp, e timestamp")
    b = {r.stay_id: r.encounter_block for r in harmonize.encounter_block(stays, "patient", "s", "e", 6).collect()}
    assert b == {1: 1, 2: 1, 3: 2, 4: 1}


def test_decode_unfolds_no_list_with_a_small_vocabulary(spark, monkeypatch):
    """Lists are decoded as a whole, those of one key merged by position; a large vocabulary's join gives the same."""
    lines = spark.createDataFrame([("a", 1, [2, 0, 2, None]), ("a", 2, []), ("b", 3, None), (None, 4, [1]), ("a", None, [0, 1]), ("a", None, [2, 0, 2]), ("a", None, None)], "site string, subject_id long, tokens array<int>")
    vocab = spark.createDataFrame([(0, "UNK"), (1, "x"), (2, "y")], "token_id int, token string")
    small = tkz.timeline_decode(lines, vocab)
    assert "Generate" not in small._jdf.queryExecution().executedPlan().toString()
    rows = {r.subject_id: r.tokens for r in small.collect()}
    assert rows == {1: ["y", "UNK", "y", None], 2: [], 3: [], 4: ["x"], None: ["UNK", "y", "UNK", "x", "y"]}
    monkeypatch.setattr(tkz, "LITERAL_ROWS", 0)
    assert {r.subject_id: r.tokens for r in tkz.timeline_decode(lines, vocab).collect()} == rows


def test_decode_raises_on_an_unknown_id(spark):
    lines = spark.createDataFrame([("a", 1, [7])], "site string, subject_id long, tokens array<int>")
    vocab = spark.createDataFrame([(0, "UNK")], "token_id int, token string")
    with pytest.raises(Exception, match="unknown token id 7"):
        tkz.timeline_decode(lines, vocab).collect()
