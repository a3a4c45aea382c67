"""Hand-made fixtures for the semantic rules S1–S28 (FIXTURES.md part 3)."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.functions import scalar as S
from timeloom.operators import cohort, describe, harmonize, relational as R, tokenize as tkz, winnow

T0 = dt.datetime(2024, 1, 1)


def d(days=0, hours=0, minutes=0):
    return T0 + dt.timedelta(days=days, hours=hours, minutes=minutes)


def test_first_stay_rules(spark):
    """S1 short first stay drops the patient; S2 null start wins then fails;
    S3 tie goes to the smaller stay key."""
    stays = spark.createDataFrame([
        ("p1", "s1", d(0), d(0, 5)), ("p1", "s2", d(3), d(9)),
        ("p2", "s3", None, d(4)), ("p2", "s4", d(1), d(5)),
        ("p3", "s6", d(2), d(6)), ("p3", "s5", d(2), d(7)),
    ], "patient_id string, stay_id string, start_time timestamp, end_time timestamp")
    units = spark.createDataFrame([(s, "ICU", d(0)) for s in ["s1", "s2", "s3", "s4", "s5", "s6"]],
                                  "stay_id string, location string, in_time timestamp")
    first = {r.patient_id: r.stay_id for r in cohort.first_stays(stays).collect()}
    assert first == {"p1": "s1", "p2": "s3", "p3": "s5"}
    out = cohort.cohort_select(stays, units, unit_within_days=10).collect()
    assert [(r.patient_id, r.stay_id) for r in out] == [("p3", "s5")]


def test_status_complement_drops_null(spark):
    """== and ~(==) both drop null."""
    df = spark.createDataFrame([("success",), ("failed",), (None,)], "st string")
    ok = F.col("st") == "success"
    assert df.filter(ok).count() == 1 and df.filter(~ok).count() == 1


def test_finite(spark):
    """Null, NaN and inf are all dropped."""
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),)], "v double")
    assert [r.v for r in df.filter(S.finite("v")).collect()] == [1.0]


def test_kleene_or_and_mean_skips_null(spark):
    """S6, S7."""
    vals = [True, False, None]
    df = spark.createDataFrame([(a, b) for a in vals for b in vals], "a boolean, b boolean")
    got = {(r.a, r.b): r.o for r in df.select("a", "b", (F.col("a") | F.col("b")).alias("o")).collect()}
    assert got[(True, None)] is True and got[(False, None)] is None and got[(None, None)] is None
    m = spark.createDataFrame([(True,), (False,), (None,)], "x boolean").agg(F.avg(F.col("x").cast("int"))).first()[0]
    assert m == 0.5


def test_timeline_edge_cases(spark):
    """S8/S9 empty list counts one null token in the denominator; S11 ends of
    an empty list are null; S12 length of null is null; S10 unknown id raises."""
    tl = spark.createDataFrame([("A", 1, [1, 2]), ("A", 2, []), ("A", 3, None)],
                               "site string, subject_id int, tokens array<int>")
    ex = describe.explode_timelines(tl)
    assert ex.count() == 4 and ex.filter("token IS NULL").count() == 2
    st = describe.token_stats(ex.withColumn("token", F.col("token").cast("string")),
                              n_timelines=tl.groupBy("site").agg(F.count(F.lit(1)).alias("n_timelines")))
    freq = {r.token: r.frequency for r in st.collect()}
    assert math.isclose(freq["1"], 0.25)
    ends = tl.select(S.list_first("tokens").alias("f"), S.list_len("tokens").alias("n")).collect()
    assert ends[1].f is None and ends[2].n is None
    vocab = spark.createDataFrame([("a", 1)], "token string, token_id int")
    with pytest.raises(Exception, match="unknown token id"):
        tkz.timeline_decode(tl.filter("subject_id = 1"), vocab).collect()


def test_pivot_duplicates_raise(spark):
    """A duplicate (token, site) cell is an error."""
    df = spark.createDataFrame([("t", "A", 1.0), ("t", "A", 2.0), ("u", "B", 3.0)], "token string, site string, f double")
    with pytest.raises(Exception, match="duplicate"):
        R.pivot_checked(df, "token", "site", "f", ["A", "B"]).collect()
    ok = R.pivot_checked(df.filter("f > 1"), "token", "site", "f", ["A", "B"]).collect()
    assert len(ok) == 2


def test_bin_regex(spark):
    """One-digit bins only, and no match before a final newline."""
    df = spark.createDataFrame([("a_Q1",), ("a_Q10",), ("a_Q1\n",)], "token string")
    assert [r.token for r in df.filter(F.col("token").rlike(describe.BIN_TOKEN)).collect()] == ["a_Q1"]


def test_whole_days_truncate(spark):
    """1 d 23 h and 2 d 1 h → whole days 1 and 2 → mean 1.5."""
    tl = spark.createDataFrame([("A", [1, 2], [d(0), d(1, 23)]), ("A", [1, 2], [d(0), d(2, 1)])],
                               "site string, tokens array<int>, times array<timestamp>")
    assert describe.training_volume(tl).first().avg_days == 1.5


def test_round_even_matches_numpy(spark):
    """0.00015 rounds like numpy (binary value), not like decimal HALF_EVEN."""
    xs = [0.00015, 0.00025, 0.12345, 0.5, 1.23456789, -0.00015]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.r for r in df.select(S.round_even("x", 4).alias("r")).collect()]
    assert got == [float(np.round(x, 4)) for x in xs]


def test_fill_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (float("inf"),), (2.0,)], "x double")
    got = [r.y for r in df.select(S.fill_nan("x").alias("y")).collect()]
    assert got == [0.0, 0.0, 1.7976931348623157e308, 2.0]


def test_glob_and_lower_codes(spark):
    """Codes are lower-cased in tokens, patterns match the tokens."""
    ev = spark.createDataFrame([("LABEL", "hyperK_init")], "prefix string, code string")
    tok = tkz.token_build(ev).first().token
    assert tok == "LABEL//hyperk_init"
    df = spark.createDataFrame([(tok,), ("LABEL",), ("RESP//imv",)], "token string")
    m = df.filter(S.matches_any_glob("token", ["LABEL//hyperk_init", "LABEL//*"])).collect()
    assert [r.token for r in m] == [tok]
    for pat, text in [("a[!b]c", "axc"), ("a?c", "abc"), ("*_Q?", "x_Q1"), ("a[b]c", "abc")]:
        assert S._fnmatch_check(text, [pat])
        assert spark.range(1).select(F.lit(text).rlike(S.glob_to_regex(pat))).first()[0]


def test_block_summary_last_non_null(spark):
    """The last id is the latest non-null one."""
    df = spark.createDataFrame([("b", d(0), "x1"), ("b", d(1), "x2"), ("b", d(2), None)],
                               "blk string, t timestamp, ident string")
    r = harmonize.block_summary(df, ["blk"], "t", "ident").first()
    assert r.max_time == d(2) and r.last_ident == "x2"


def test_winnow_boundary(spark):
    """At the cut → past; past + future = all."""
    tok = spark.createDataFrame([
        ("A", 1, d(0), "BOS"), ("A", 1, d(0, 23), "x"), ("A", 1, d(1), "y"), ("A", 1, d(1, 1), "z")],
        "site string, subject_id int, time timestamp, token string")
    w = winnow.winnow_duration(tok, 86400).orderBy("time").collect()
    assert [r.past for r in w] == [True, True, True, False]
    subjects = tok.select("site", "subject_id").distinct()
    fl = {r.outcome: (r.past, r.future) for r in winnow.outcome_flags(
        winnow.winnow_duration(tok, 86400), subjects, ["y", "z", "q"]).collect()}
    assert fl == {"y": (True, False), "z": (False, True), "q": (False, False)}


def test_fed_avg_by_hand(spark):
    from timeloom.operators import federate as fd
    w = spark.createDataFrame([("a", 0, 1.0, 1), ("b", 0, 3.0, 1), ("c", 0, 5.0, 2)],
                              "client string, pos int, value double, n long")
    assert fd.fed_avg(w).first().value == (1 + 3 + 10) / 4
    same = w.withColumn("value", F.lit(7.0))
    assert fd.fed_avg(same).first().value == 7.0


def test_grid_keeps_missing(spark):
    """A missing (model, site) cell is null in the grid."""
    facts = spark.createDataFrame([("m1", "A", 0.7), ("m1", "B", 0.6), ("m2", "A", 0.8)],
                                  "model string, site string, auc double")
    g = R.grid_complete(spark, {"model": ["m1", "m2"], "site": ["A", "B"]}, facts)
    cells = {(r.model, r.site): r.auc for r in g.collect()}
    assert len(cells) == 4 and cells[("m2", "B")] is None


def test_forward_fill_buckets_equal_plain(spark):
    """The bucketed (skew-safe) fill equals the plain window fill."""
    rows = [(1, i, d(i // 3, i % 3), (float(i) if i % 4 == 0 else None)) for i in range(20)]
    rows += [(2, 100 + i, d(i), None if i else 5.0) for i in range(5)]
    df = spark.createDataFrame(rows, "u int, id int, t timestamp, v double")
    a = harmonize.forward_fill(df, ["u"], "t", ["v"]).select("id", "v").orderBy("id").collect()
    b = harmonize.forward_fill(df, ["u"], "t", ["v"], bucket=F.to_date("t")).select("id", "v").orderBy("id").collect()
    assert a == b
