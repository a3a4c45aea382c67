"""Exact quantiles against numpy, sketches against ranks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.operators import order_stats as os_

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def frame(spark):
    """A group with one hot value, one of wide exponents, one of few values, small ones, and null and NaN."""
    rng = np.random.default_rng(2)
    rows = [("hot", 7.0 if rng.random() < 0.4 else float(rng.normal())) for _ in range(3000)]
    rows += [("wide", float(10.0 ** rng.uniform(-300, 300)) * (1 if i % 3 else -1)) for i in range(3000)]
    rows += [("few", float(i % 4)) for i in range(3000)]
    rows += [("one", 5.0), ("two", 1.0), ("two", 4.0), (None, 2.0), (None, 3.0), ("void", None), ("nan", float("nan")), ("two", float("nan"))]
    rows += [("inf", math.inf), ("inf", math.inf), ("inf", 1.0)]
    return spark.createDataFrame(rows, "g string, v double").repartition(4), rows


@pytest.mark.parametrize("few", [100_000, 40])
def test_quantiles_are_exact(spark, few):
    """Few distinct values allowed: several rounds of narrowing."""
    df, rows = frame(spark)
    got = {r.g: (r.n, r.breaks) for r in os_.exact_quantiles(df, ["g"], "v", PROBS, few=few).collect()}
    want = {}
    for g, v in rows:
        if v is not None and not math.isnan(v):
            want.setdefault(g, []).append(v)
    assert got.keys() == want.keys()
    for g, v in want.items():
        assert got[g][0] == len(v)
        if g != "inf":
            assert got[g][1] == pytest.approx(np.quantile(np.array(v), PROBS).tolist(), rel=1e-12, abs=1e-300)
    assert got["inf"][1][0] == 1.0 and got["inf"][1][3:] == [math.inf] * 3


def test_same_as_percentile(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.rand(5).alias("v"))
    probs = F.array(*[F.lit(p) for p in PROBS])
    want = {r.g: r.b for r in df.groupBy("g").agg(F.percentile("v", probs).alias("b")).collect()}
    got = {r.g: r.breaks for r in os_.exact_quantiles(df, ["g"], "v", PROBS, few=100).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12)


def test_no_value_map_in_the_plan(spark):
    df, _ = frame(spark)
    plan = os_.exact_quantiles(df, ["g"], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "median" not in plan


def test_sketches_merge(spark):
    """Sketches per (site, code), merged over sites, stay within their rank error."""
    df = spark.range(40_000).select((F.col("id") % 4).alias("site"), (F.col("id") % 2).alias("code"), F.exp(F.randn(3) * 3).alias("v"))
    table = os_.sketch_table(df, ["site", "code"], "v")
    merged = {r.code: (r.n, r.breaks) for r in os_.sketch_quantiles(os_.merge_sketches(table, ["code"]), [0.1, 0.5, 0.9]).collect()}
    for code, (n, breaks) in merged.items():
        v = np.sort([r.v for r in df.where(F.col("code") == code).collect()])
        assert n == len(v)
        for p, b in zip([0.1, 0.5, 0.9], breaks):
            assert abs(np.searchsorted(v, b) / n - p) < 0.006


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert os_.exact_quantiles(df, ["g"], "v", [0.5]).collect() == []
    assert os_.sketch_table(df, ["g"], "v").collect() == []
