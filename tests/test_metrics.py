"""AUCs against brute force, properties, bootstrap pairing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.operators import bootstrap as bs, metrics as mt
from timeloom.operators import describe
from timeloom.operators.scans import running_sums


def brute_roc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        return None
    return float(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)))


def brute_pr(y, s):
    """Trapezoid over (recall, precision) at thresholds = distinct rounded
    scores, from (0, 1)."""
    r = np.rint(s * 1e4) / 1e4
    P = y.sum()
    if P == 0:
        return None
    pts = [(0.0, 1.0)]
    for t in sorted(set(r), reverse=True):
        tp = ((r >= t) & (y == 1)).sum()
        fp = ((r >= t) & (y == 0)).sum()
        pts.append((tp / P, tp / (tp + fp)))
    return float(sum((pts[i][0] - pts[i - 1][0]) * (pts[i][1] + pts[i - 1][1]) / 2 for i in range(1, len(pts))))


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in ["a", "b", "c"]:
        n = {"a": 60, "b": 35, "c": 20}[k]
        y = rng.integers(0, 2, n)
        s = np.round(rng.random(n) * 0.6 + 0.3 * y, 2)        # many ties
        if k == "c":
            y[:] = 1                                            # one class
        rows += [(k, i, bool(yy), float(ss)) for i, (yy, ss) in enumerate(zip(y, s))]
    return spark.createDataFrame(rows, "k string, subject_id int, future boolean, score double")


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_auc_vs_brute(spark, scores, buckets):
    pdf = scores.toPandas()
    roc = {r.k: r.roc_auc for r in mt.roc_auc(scores, ["k"], n_buckets=buckets).collect()}
    pr = {r.k: r.pr_auc for r in mt.pr_auc(scores, ["k"], n_buckets=buckets).collect()}
    for k, g in pdf.groupby("k"):
        y, s = g.future.astype(int).to_numpy(), g.score.to_numpy()
        b = brute_roc(y, s)
        assert (roc[k] is None) if b is None else abs(roc[k] - b) < 1e-12
        assert abs(pr[k] - brute_pr(y, s)) < 1e-12


def test_auc_monotone_invariant(spark, scores):
    a = {r.k: r.roc_auc for r in mt.roc_auc(scores, ["k"]).collect()}
    b = {r.k: r.roc_auc for r in mt.roc_auc(scores.withColumn("score", F.exp(F.col("score") * 3) + 1), ["k"]).collect()}
    assert a == b


def test_qualify_drops_past_and_null(spark):
    df = spark.createDataFrame([(1, False, True, float("nan")), (2, True, True, 0.2), (3, None, False, 0.3)],
                               "subject_id int, past boolean, future boolean, score double")
    q = mt.qualify(df).collect()
    assert [(r.subject_id, r.score) for r in q] == [(1, 0.0)]


def test_running_sums_bucketed_equal_plain(spark):
    rows = [("k1" if i % 3 else "k2", float(i % 17), float(i % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, s double, v double").groupBy("k", "s").agg(F.sum("v").alias("v"))
    for desc in (False, True):
        for inc in (False, True):
            a = running_sums(df, ["k"], "s", ["v"], desc, inc, n_buckets=1).orderBy("k", "s").collect()
            b = running_sums(df, ["k"], "s", ["v"], desc, inc, n_buckets=5).orderBy("k", "s").collect()
            assert [(r.k, r.s, r.cum_v) for r in a] == [(r.k, r.s, r.cum_v) for r in b]


def test_poisson_weights_mean_one(spark):
    df = spark.range(200).withColumn("outcome", F.lit("o")).withColumnRenamed("id", "subject_id")
    r = bs.replicate(df, 50, 1, ["outcome", "subject_id"])
    tot = r.agg(F.sum("w")).first()[0]
    assert abs(tot / (200 * 50) - 1) < 0.03


def test_paired_draws_shared_and_labels_checked(spark):
    """Two models share draws; the draw is stateless; a changed label raises."""
    base = spark.createDataFrame([(i, "o", i % 2 == 0, i / 10) for i in range(10)],
                                 "subject_id int, outcome string, future boolean, score double")
    two = base.withColumn("model", F.lit("m0")).unionByName(base.withColumn("model", F.lit("m1")))
    r = bs.replicate(two, 5, 9, ["outcome", "subject_id"])
    w = r.groupBy("rep", "subject_id").agg(F.countDistinct("w").alias("k"))
    assert w.filter("k > 1").count() == 0
    again = bs.replicate(two, 5, 9, ["outcome", "subject_id"])
    assert sorted(r.collect()) == sorted(again.collect())
    changed = base.withColumn("future", F.when(F.col("subject_id") == 3, ~F.col("future")).otherwise(F.col("future")))
    with pytest.raises(ValueError):
        bs.check_paired(base, changed, ["subject_id", "outcome"])


def _w1_brute(freqs):
    from itertools import combinations
    out = {}
    for g, per_site in freqs.items():
        bins = sorted({b for s in per_site.values() for b in s})
        p = {}
        for site, f in per_site.items():
            v = np.array([f.get(b, 0.0) for b in bins])
            p[site] = v / v.sum()
        out[g] = float(np.mean([np.abs(np.cumsum(p[a]) - np.cumsum(p[b])).sum() for a, b in combinations(sorted(p), 2)]))
    return out


def test_site_divergence_vs_brute(spark):
    """S22 bins from data (site A lacks bin 1); S23 group 'g2' absent at C is skipped."""
    rows = [("A", "g1_Q0", 0.2), ("A", "g1_Q9", 0.1), ("B", "g1_Q0", 0.1), ("B", "g1_Q1", 0.3), ("B", "g1_Q9", 0.05),
            ("C", "g1_Q0", 0.3), ("C", "g1_Q1", 0.1), ("C", "g1_Q9", 0.3),
            ("A", "g2_Q0", 0.5), ("B", "g2_Q0", 0.5), ("A", "other", 0.2), ("C", "x_Q10", 1.0)]
    st = spark.createDataFrame(rows, "site string, token string, frequency double")
    got = {r.grp: r.w1 for r in describe.site_divergence(st).collect()}
    exp = _w1_brute({"g1": {s: {t: f for ss, t, f in rows if ss == s and t.startswith("g1")} for s in "ABC"}})
    assert set(got) == {"g1"} and abs(got["g1"] - exp["g1"]) < 1e-12


def test_w1_symmetric_and_zero(spark):
    rows = [(s, f"g_Q{b}", v) for s in ["A", "B"] for b, v in enumerate([0.1, 0.2, 0.3])]
    st = spark.createDataFrame(rows, "site string, token string, frequency double")
    assert abs(describe.site_divergence(st).first().w1) < 1e-15


def test_single_pass_roc_pr_vs_brute(spark, scores):
    """The one-sort form used by the bootstrap equals brute force."""
    c = mt.score_counts(scores, ["k"])
    got = {(r.k, r.metric): r.v for r in mt.roc_pr_from_counts(c, ["k"]).collect()}
    pdf = scores.toPandas()
    for k, g in pdf.groupby("k"):
        y, s = g.future.astype(int).to_numpy(), g.score.to_numpy()
        b = brute_roc(y, s)
        assert (got[(k, "roc_auc")] is None) if b is None else abs(got[(k, "roc_auc")] - b) < 1e-12
        assert abs(got[(k, "pr_auc")] - brute_pr(y, s)) < 1e-12


def test_check_paired_all(spark):
    base = spark.createDataFrame([(i, "o", i % 2 == 0) for i in range(6)], "subject_id int, outcome string, future boolean")
    two = base.withColumn("model", F.lit("a")).unionByName(base.withColumn("model", F.lit("b")))
    bs.check_paired_all(two, ["subject_id", "outcome"], 2)
    with pytest.raises(ValueError):
        bs.check_paired_all(two.filter("NOT (model = 'b' AND subject_id = 2)"), ["subject_id", "outcome"], 2)
    flipped = two.withColumn("future", F.when((F.col("model") == "b") & (F.col("subject_id") == 1), F.lit(True))
                             .otherwise(F.col("future")))
    with pytest.raises(ValueError):
        bs.check_paired_all(flipped, ["subject_id", "outcome"], 2)
