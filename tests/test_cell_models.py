"""Batched models against direct computation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.operators import cell_models as cm
from timeloom.session import stage_table

DIM = 6


def data(spark, n=400, seed=3):
    """Two sites, two outcomes; counts 0 to 4; rows that miss an outcome."""
    rng = np.random.default_rng(seed)
    x = rng.poisson(0.8, (n, DIM)) * (rng.random((n, DIM)) < 0.6)
    site = rng.integers(0, 2, n)
    y = (rng.random((n, 2)) < 1 / (1 + np.exp(-(x[:, [0, 1]] * 1.5 - x[:, [2, 3]] + site[:, None] * 0.5 - 0.5)))).astype(float)
    y[rng.random((n, 2)) < 0.1] = np.nan
    rows = []
    for i in range(n):
        j = np.flatnonzero(x[i])
        cells, labels = [], []
        for o in range(2):
            if not np.isnan(y[i, o]):
                for c in (2 * o + int(site[i]), 4 + o):
                    cells.append(c)
                    labels.append(float(y[i, o]))
        rows.append((i, j.tolist(), x[i, j].astype(float).tolist(), cells, labels))
    df = spark.createDataFrame(rows, "id int, idx array<int>, val array<double>, cells array<int>, labels array<double>").repartition(3)
    return stage_table(df, "cell-rows"), x, site, y


def member(c, site, y):
    o = c // 2 if c < 4 else c - 4
    return ~np.isnan(y[:, o]) & ((site == c % 2) | (c >= 4)), y[:, o]


def newton(x, y):
    w = np.zeros(x.shape[1] + 1)
    a = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.append(np.ones(x.shape[1]), 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (p - y) + ridge * w)
    return w


def test_logistic_reaches_the_optimum_of_every_cell(spark):
    df, x, site, y = data(spark)
    got = {r.cell: r for r in cm.fit_logistic_cells(df, 7, DIM, tol=1e-6).collect()}
    assert got.keys() == set(range(6))  # cell 6 has no rows
    for c, r in got.items():
        mine, t = member(c, site, y)
        assert r.n == mine.sum() and r.residual <= 1e-6
        assert r.weights == pytest.approx(newton(x[mine].astype(float), t[mine]).tolist(), abs=1e-5)


@pytest.mark.parametrize("newton_dim, most", [(256, 9), (0, 200)])
def test_logistic_on_many_rows_needs_few_jobs(spark, monkeypatch, newton_dim, most):
    """The gradient is a sum over rows held to an absolute tolerance: the jobs
    must not grow with the rows. The other way (more weights) has the same optimum."""
    df, x, site, y = data(spark, 4000)
    df = stage_table(df.select("idx", F.transform("val", lambda v: v * 3).alias("val"), "cells", "labels"), "cell-rows")
    monkeypatch.setattr(cm, "NEWTON_DIM", newton_dim)
    for r in cm.fit_logistic_cells(df, 6, DIM, tol=1e-6).collect():
        mine, t = member(r.cell, site, y)
        assert r.rounds <= most and r.residual <= 1e-6
        assert r.weights == pytest.approx(newton(3.0 * x[mine], t[mine]).tolist(), abs=1e-6)


def test_groups_of_cells_when_a_broadcast_is_full(spark, monkeypatch):
    df, *_ = data(spark)
    one = {r.cell: r.weights for r in cm.fit_logistic_cells(df, 6, DIM).collect()}
    monkeypatch.setattr(cm, "MODEL_BYTES", 2 * 8 * (DIM + 1))
    models = cm.fit_logistic_cells(df, 6, DIM)
    two = {r.cell: r.weights for r in models.collect()}
    assert two.keys() == one.keys() and all(two[c] == pytest.approx(one[c], abs=1e-9) for c in one)
    rows = df.select("id", "idx", "val", F.array(F.lit(1), F.lit(5), F.lit(9)).alias("for_cells"))
    scored = cm.score_logistic_cells(rows, models).collect()
    assert sorted((r.id, r.cell) for r in scored) == sorted((i, c) for i in range(400) for c in (1, 5))


def test_scores_are_the_model_s(spark):
    df, x, *_ = data(spark)
    models = cm.fit_logistic_cells(df, 6, DIM)
    w = np.array(models.where("cell = 4").first().weights)
    for r in cm.score_logistic_cells(df.select("id", "idx", "val", F.array(F.lit(4)).alias("for_cells")), models).collect():
        assert r.score == pytest.approx(1 / (1 + np.exp(-(x[r.id] @ w[:-1] + w[-1]))))


def brute_split(x, g, h, mine, min_rows, l2=1.0):
    best = None
    for f in range(x.shape[1]):
        for v in sorted(set(x[mine, f]) - {0}):
            right, left = mine & (x[:, f] >= v), mine & (x[:, f] < v)
            if right.sum() >= min_rows and left.sum() >= min_rows:
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + l2) for s in (left, right)) - g[mine].sum() ** 2 / (h[mine].sum() + l2)
                if gain > 1e-9 and (best is None or round(gain, 9) > best[0]):
                    best = (round(gain, 9), f, float(v))
    return best


def test_first_tree_splits_as_by_brute_force(spark):
    """Two leaves: the root's split; four leaves: the children's too, whose
    histograms come by subtraction."""
    df, x, site, y = data(spark)
    for leaves in (2, 4):
        models = cm.fit_boosted_cells(df, 6, trees=1, leaves=leaves, min_rows=10)
        for c, (base, (tree,)) in models.items():
            mine, t = member(c, site, y)
            p = t[mine].mean()
            assert base == pytest.approx(np.log(p / (1 - p)))
            g, h = np.where(mine, p - t, 0.0), np.where(mine, p * (1 - p), 0.0)
            at = {0: mine}
            for i, node in enumerate(tree):
                if isinstance(node, tuple):
                    f, v, left, right = node
                    want = brute_split(x, g, h, at[i], 10)
                    assert f == want[1] and (v == want[2] or (v == 1e-300 and want[2] == 1.0))
                    goes = (x[:, f] >= v)
                    at[left], at[right] = at[i] & ~goes, at[i] & goes
                else:
                    assert node == pytest.approx(-0.1 * g[at[i]].sum() / (h[at[i]].sum() + 1.0), abs=1e-9)


def test_trees_lower_the_loss_and_beat_chance(spark):
    df, x, site, y = data(spark, 900)
    models = cm.fit_boosted_cells(df, 6, trees=12, leaves=5, min_rows=10)
    scored = cm.score_boosted_cells(df.select("id", "idx", "val", F.array(F.lit(4)).alias("for_cells")), models).collect()
    s = np.zeros(900)
    for r in scored:
        s[r.id] = r.score
    mine, t = member(4, site, y)
    pos, neg = s[mine][t[mine] == 1], s[mine][t[mine] == 0]
    assert (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean() > 0.72


def test_cells_grow_without_waiting_for_one_another(spark, monkeypatch):
    """As many jobs as the cell of most rounds needs, the same trees as alone."""
    df, *_ = data(spark, 300)
    jobs = []
    built = cm.histograms
    monkeypatch.setattr(cm, "histograms", lambda *a: jobs.append(set(a[3])) or built(*a))
    together = cm.fit_boosted_cells(df, 6, trees=4, leaves=6, min_rows=15)
    n = len(jobs)
    assert n == max(sum(c in j for j in jobs) for c in together)
    few = df.withColumn("keep", F.array_position("cells", 4)).where("keep > 0").select(
        "idx", "val", F.array(F.lit(4)).alias("cells"), F.array(F.get("labels", (F.col("keep") - 1).cast("int"))).alias("labels"))
    alone = cm.fit_boosted_cells(stage_table(few, "cell-rows"), 6, trees=4, leaves=6, min_rows=15)
    for a, b in zip(together[4][1], alone[4][1], strict=True):
        assert [x if isinstance(x, tuple) else pytest.approx(x, abs=1e-9) for x in a] == b


def test_sparse_rows(spark):
    df = spark.createDataFrame([(1, [3, 1, 3, 3]), (2, []), (3, None), (4, [7])], "k int, tokens_past array<int>")
    got = {r.k: (r.idx, r.val) for r in cm.sparse_rows(df, ["k"]).collect()}
    assert got == {1: ([1, 3], [1.0, 3.0]), 2: ([], []), 3: ([], []), 4: ([7], [1.0])}
    assert {r.k: r.val for r in cm.sparse_rows(df, ["k"], binary=True).collect()}[1] == [1.0, 1.0]
