"""Rows with null keys, null times and every unit × preferred case stay, and
the bucketed paths give what the plain ones give."""

import pytest
from pyspark.sql import functions as F

from timeloom.functions.scalar import ci_format
from timeloom.operators import bootstrap as bs
from timeloom.operators.harmonize import convert_dose_units
from timeloom.operators.metrics import auc_table, pr_auc, roc_auc
from timeloom.operators.scans import forward_fill, running_sums
from timeloom.sources.io import subset_tables

ROWS = [("a", 1, 1.0), ("a", 2, None), ("a", 30, 3.0), ("a", 31, None), (None, 1, 5.0), (None, 40, None), ("b", None, 7.0), ("b", 3, None), ("b", 50, None)]


def same(x, y):
    return sorted(map(repr, x.collect())) == sorted(map(repr, y.collect()))


def test_forward_fill_keeps_null_keys_and_times(spark):
    df = spark.createDataFrame(ROWS, "k string, t int, v double")
    plain = forward_fill(df, ["k"], "t", ["v"])
    split = forward_fill(df, ["k"], "t", ["v"], bucket=F.floor(F.col("t") / 10))
    assert plain.count() == len(ROWS) and same(plain, split)
    assert {(r.k, r.t): r.v for r in split.collect()}["b", 50] == 7.0


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_keep_null_keys_and_orders(spark, descending):
    df = spark.createDataFrame([(k, t, 1.0 if v is None else v) for k, t, v in ROWS], "k string, t int, v double")
    one = running_sums(df, ["k"], "t", ["v"], descending=descending, n_buckets=1)
    many = running_sums(df, ["k"], "t", ["v"], descending=descending, n_buckets=8)
    assert one.count() == len(ROWS) and same(one, many)


def test_areas_of_a_null_key(spark):
    rows = [(k, float(i % 7), i % 3 == 0) for k in ("x", None) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, score double, future boolean")
    for fn in (roc_auc, pr_auc):
        one, many = fn(df, ["k"], n_buckets=1), fn(df, ["k"], n_buckets=64)
        assert {r[0]: round(r[1], 9) for r in one.collect()} == {r[0]: round(r[1], 9) for r in many.collect()} and one.count() == 2
    assert auc_table(df, ["k"]).count() == 2


def test_every_unit_and_preferred_case_stays_once(spark):
    doses = spark.createDataFrame([(1, "c1", 2.0, "mg"), (2, "c1", 2.0, "g"), (3, "c2", 2.0, "mg"), (4, "c2", 2.0, "g"), (5, "c3", 2.0, "mg"),
                                   (6, "c1", None, "mg"), (7, "c1", 2.0, "cup"), (8, None, 2.0, "mg"), (9, "c1", 2.0, None)],
                                  "id int, cat string, dose double, unit string")
    factors = spark.createDataFrame([("mg", "g", 0.001), ("mg", "mg", 1.0), ("g", "mg", 1000.0)], "from_unit string, to_unit string, factor double")
    preferred = spark.createDataFrame([("c1", "mg"), ("c2", "g")], "cat string, to_unit string")
    out = convert_dose_units(doses, factors, "cat", "dose", "unit", preferred)
    assert {r.id: (r._convert_status, r.dose_converted) for r in out.collect()} == {
        1: ("success", 2.0), 2: ("success", 2000.0), 3: ("success", 0.002), 4: ("no factor", None), 5: ("no preferred unit", None),
        6: ("missing dose", None), 7: ("unknown unit", None), 8: ("no preferred unit", None), 9: ("unknown unit", None)}
    assert out.count() == 9


def test_text_keys_are_compared_as_text(spark):
    table = spark.createDataFrame([(7, "x"), (8, "y")], "pid long, v string")
    cohort = spark.createDataFrame([("007",), ("8",), ("abc",)], "pid string")
    assert [r.v for r in subset_tables({"t": table}, cohort, "pid", "none")["t"].collect()] == ["y"]


def test_interval_text(spark):
    df = spark.createDataFrame([(0.4, 0.6), (0.6, 0.4), (0.0005, 0.0005), (None, 1.0), (float("nan"), 1.0), (-0.2, 0.1)], "lo double, hi double")
    assert [r[0] for r in df.select(ci_format("lo", "hi")).collect()] == [
        "0.500 (±0.100)", "0.500 (±0.100)", "0.001 (±0.000)", None, None, "-0.050 (±0.150)"]


def test_one_class_outcome_voids_the_replicate(spark):
    rows = [("s", "o1", i, float(i % 50), i % 50 > 20) for i in range(500)]
    void = spark.createDataFrame(rows + [("s", "o2", i, float(i), True) for i in range(4)] + [("t", "o1", *r[2:]) for r in rows],
                                 "site string, outcome string, subject_id int, score double, future boolean")
    got = bs.replicate_stats(void, ["site"], 5, 1, ["outcome", "subject_id"]).collect()
    assert {r.stat for r in got if r.site == "s" and r.metric == "roc_auc"} == {None}
    assert {r.stat for r in got if r.site == "t" and r.metric == "roc_auc"} == {1.0} and len(got) == 20


def test_unpaired_test_checks_labels_and_alternatives(spark):
    rows = [("s", m, "o", i, i % 2 == 0, i * (1.0 if m == "a" else -1.0)) for m in ("a", "b") for i in range(20)]
    df = spark.createDataFrame(rows, "site string, model string, outcome string, subject_id int, future boolean, score double")
    p = {alt: bs.bootstrap_pvalue(df, "a", "b", n_rep=20, alternative=alt).where("metric = 'roc_auc'").first().p_value for alt in ("two-sided", "greater", "less")}
    assert p["two-sided"] == min(1.0, 2 * min(p["greater"], p["less"]))
    with pytest.raises(ValueError):
        bs.bootstrap_pvalue(df, "a", "b", alternative="other")
    odd = df.withColumn("future", F.when((F.col("model") == "b") & (F.col("subject_id") == 3), True).otherwise(F.col("future")))
    with pytest.raises(ValueError):
        bs.bootstrap_pvalue(odd, "a", "b", n_rep=5)
