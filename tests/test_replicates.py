"""Replicate vectors against row-by-row replicates, and exact draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.operators import bootstrap as bs
from timeloom.operators import replicates as rp
from timeloom.operators.numbering import equal_parts, number_rows


def rows_of(spark, n=300, hot=0.4):
    """Two models, scores with a value that holds ``hot`` of the rows, many
    raw scores in one rounded score, ties and a null label."""
    rng = np.random.default_rng(4)
    out = []
    for i in range(n):
        s = 0.0 if rng.random() < hot else float(rng.choice([rng.random() * 4e-5, round(rng.random(), 1), rng.random()]))
        y = None if i == 5 else bool(rng.random() < 0.3 + 0.3 * s)
        out += [("A" if i % 3 else None, "m1", "o", i, s, y), ("A" if i % 3 else None, "m2", "o", i, round(1 - s, 2), y)]
    return spark.createDataFrame(out, "site string, model string, outcome string, subject_id int, score double, future boolean")


def areas(scores, labels, weights):
    """Weighted tie-aware ROC area and trapezoid PR area, by definition."""
    pos, neg = weights * labels, weights * ~labels
    if not pos.sum() or not neg.sum():
        return None
    roc = sum(pos[i] * (neg[scores < scores[i]].sum() + 0.5 * neg[scores == scores[i]].sum()) for i in range(len(scores))) / pos.sum() / neg.sum()
    r, pr, before = np.round(scores, 4), 0.0, (0.0, 1.0)
    for s in sorted(set(r), reverse=True):
        tp, fp = pos[r >= s].sum(), neg[r >= s].sum()
        now = (tp / pos.sum(), tp / (tp + fp) if tp + fp else 1.0)
        pr += (now[0] - before[0]) * (now[1] + before[1]) / 2
        before = now
    return roc, pr


@pytest.mark.parametrize("parts,run_scores", [("2", 128), ("13", 2)])
def test_vectors_give_the_areas_of_row_replicates(spark, parts, run_scores, monkeypatch):
    """Also with a rounded score that spreads over partitions and runs."""
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = rows_of(spark)
        keys, n_rep = ["site", "model", "outcome"], 12
        schema = T.StructType([rows.schema[k] for k in keys])
        cells = rp.poisson_cells(rows.repartition(5), keys, n_rep, 7, ["outcome", "subject_id"])
        monkeypatch.setattr(rp, "RUN_SCORES", run_scores)
        runs = rp.cell_runs
        monkeypatch.setattr(rp, "cell_runs", lambda c, n, p: runs(c, n, p, run_scores))
        got = {(r.site, r.model, r.rep): (r.roc_auc, r.pr_auc) for r in rp.replicate_areas(cells, schema, n_rep).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    each = {}
    for r in bs.replicate(rows.where("future is not null"), n_rep, 7, ["outcome", "subject_id"]).collect():
        each.setdefault((r.site, r.model, r.rep), []).append((r.score, r.future, r.w))
    assert got.keys() == each.keys() and len(got) == 48
    for k, v in each.items():
        s, y, w = (np.array(x) for x in zip(*v))
        assert got[k] == pytest.approx(areas(s, y.astype(bool), w.astype(float)), abs=1e-12)


def test_weights_follow_poisson():
    w = rp.poisson_weights(np.random.default_rng(1).integers(0, 1 << 63, 2000, dtype=np.uint64), 500)
    share = np.bincount(w.ravel(), minlength=5)[:5] / w.size
    assert share == pytest.approx([0.36788, 0.36788, 0.18394, 0.06131, 0.01533], abs=0.002)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.08 and abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.2


def test_shared_hot_score_is_summed_before_the_shuffle(spark):
    rows = spark.range(5000).select(F.lit("k").alias("model"), F.lit("o").alias("outcome"), F.col("id").alias("subject_id"), F.lit(0.0).alias("score"),
                                    (F.col("id") % 3 == 0).alias("future")).repartition(4)
    cells = rp.poisson_cells(rows, ["model", "outcome"], 20, 1, ["subject_id"])
    assert cells.count() <= 2 * 8


@pytest.mark.parametrize("n,block", [(1, 4), (4, 4), (5, 4), (100, 7), (1000, 64)])
def test_exact_draws_add_up(n, block):
    blocks = -(-n // block)
    drawn = np.array([rp.block_draws("g", n, b, 200, 3, block) for b in range(blocks)])
    assert (drawn.sum(axis=0) == n).all()
    sizes = np.array([min(block, n - b * block) for b in range(blocks)])
    assert drawn.mean(axis=1) == pytest.approx(sizes, abs=6 * np.sqrt(sizes.max() / 200) + 1e-9)


def test_exact_draws_of_rows(spark):
    """Sums are n in every replicate, models share them, single rows are Binomial(n, 1/n)."""
    n, n_rep = 90, 400
    rows = spark.range(n).select(F.lit("s").alias("site"), F.lit("o").alias("outcome"), F.col("id").alias("subject_id"),
                                 F.explode(F.array(F.lit("a"), F.lit("b"))).alias("model"), F.col("id").cast("double").alias("score"),
                                 (F.col("id") % 2 == 0).alias("future"))
    cells = rp.multinomial_cells(rows, ["site", "model", "outcome"], n_rep, 5, ["site", "outcome"], "subject_id", block_rows=16).collect()
    by = {(("\"a\"" in r._k), r._s): rp._unpack(r._w, n_rep) for r in cells}
    assert len(by) == 2 * n
    a = np.array([by[True, float(i)] for i in range(n)])
    assert (a == np.array([by[False, float(i)] for i in range(n)])).all()
    assert (a.sum(axis=0) == n).all()
    assert np.bincount(a.ravel(), minlength=4)[:4] / a.size == pytest.approx([0.3658, 0.3699, 0.1849, 0.0609], abs=0.01)
    cov = np.cov(a)
    assert cov[~np.eye(n, dtype=bool)].mean() == pytest.approx(-1 / n, abs=0.004)


def test_exact_and_poisson_intervals_agree(spark):
    rows = rows_of(spark, 400, 0.1).where("site = 'A'")
    one = {(r.model, r.metric): (r.lo, r.hi) for r in bs.bootstrap_ci(rows, n_rep=300).collect()}
    two = {(r.model, r.metric): (r.lo, r.hi) for r in bs.bootstrap_ci(rows, n_rep=300, exact=True).collect()}
    assert one.keys() == two.keys() and len(one) == 4
    for k in one:
        assert one[k] == pytest.approx(two[k], abs=0.03)


def test_no_rows_times_replicates_in_the_plan(spark):
    plan = bs.bootstrap_ci(rows_of(spark, 50), n_rep=9)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" not in plan and "Generate explode" not in plan.replace("Generate explode(ends", "")


def test_empty_scores(spark):
    rows = rows_of(spark, 20).limit(0)
    assert bs.bootstrap_ci(rows, n_rep=5).collect() == [] and bs.bootstrap_ci(rows, n_rep=5, exact=True).collect() == []


def test_numbers_without_one_task(spark):
    rows = spark.range(200).select(F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 == 8, F.lit("b")).alias("k"), (F.col("id") * 37 % 200).alias("v"))
    got = number_rows(rows, ["k"], ["v"], "i", "n")
    for key in ("hot", "b", None):
        mine = sorted((r.v, r.i, r.n) for r in got.collect() if r.k == key)
        assert [i for _, i, _ in mine] == list(range(len(mine))) and {n for *_, n in mine} == {len(mine)}
    whole = number_rows(rows, [], ["v"], "i", "n")
    assert sorted((r.v, r.i) for r in whole.collect()) == [(i, i) for i in range(200)]
    assert number_rows(rows.limit(0), ["k"], ["v"], "i").collect() == []


def test_equal_parts(spark):
    for n, parts in ((10, 4), (12, 4), (3, 5)):
        got = spark.range(n).select(equal_parts(F.col("id"), F.lit(n), parts).alias("p"), F.expr(f"ntile({parts}) over (order by id)").alias("q")).collect()
        assert all(r.p == r.q for r in got)
