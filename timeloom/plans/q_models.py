"""Queries for model averaging, baselines and sequence loss."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from timeloom.functions.scalar import hash_unit
from timeloom.operators import bootstrap as bs
from timeloom.operators import cell_models as cm
from timeloom.operators import federate as fd
from timeloom.operators import models as ml
from timeloom.operators import winnow as wnw
from timeloom.operators.metrics import auc_table
from timeloom.operators.sequence import cross_site_loss as csl
from timeloom.plans import driver as drv
from timeloom.session import stage_table
from timeloom.plans.catalog import D, query, r9
from timeloom.plans.oracle import hash_unit_sql, sql

# Plan parameters for the embeddings table.
ROUNDS = 3            # averaging rounds for the server-side rules
SHARD_SEED = 0
SWEEP_ROUNDS = [1, 5, 10, 50]
SWEEP_SEED = 5

_CM = """SELECT label AS client, pos, avg(x) AS value, any_value(n) AS n FROM (
    SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
        count(*) OVER (PARTITION BY label) AS n FROM embeddings) GROUP BY label, pos"""


def _emb(spark, sf):
    return D(spark, sf).t("embeddings")


def _cm(spark, sf):
    return fd.client_means(_emb(spark, sf), "label", "embedding")


@query("weighted_mean", f"""SELECT pos, round(sum(value * n) / sum(n), 9) AS value FROM ({_CM}) GROUP BY pos""")
def weighted_mean(spark, sf):
    """Clients report (value, n); the server takes Σ value·n / Σ n."""
    cm = _cm(spark, sf)
    return fd.weighted_mean(cm, ["pos"]).select("pos", r9("value").alias("value"))


@query("fed_avg", f"SELECT pos, round(sum(value * n) / sum(n), 9) AS value FROM ({_CM}) GROUP BY pos")
def fed_avg(spark, sf):
    return fd.fed_avg(_cm(spark, sf)).select("pos", r9("value").alias("value"))


def _round_avgs(spark, sf):
    e = _emb(spark, sf).withColumn("round", F.floor(hash_unit("vec_id", SHARD_SEED) * ROUNDS).cast("int") + 1)
    cm = fd.client_means(e, "label", "embedding", by=["round"])
    return fd.fed_avg(cm, ["round", "pos"]).withColumnRenamed("value", "a")


_AR = f"""SELECT round, pos, sum(value * n) / sum(n) AS a FROM (
    SELECT round, label, pos, avg(x) AS value, any_value(n) AS n FROM (
        SELECT CAST(floor({hash_unit_sql('vec_id', SHARD_SEED)} * {ROUNDS}) AS INTEGER) + 1 AS round, label,
            CAST(unnest(embedding) AS DOUBLE) AS x, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
            count(*) OVER (PARTITION BY CAST(floor({hash_unit_sql('vec_id', SHARD_SEED)} * {ROUNDS}) AS INTEGER), label) AS n
        FROM embeddings) GROUP BY round, label, pos) GROUP BY round, pos"""


def _momentum_sql(lr=1.0, beta=0.5):
    ctes = [f"ar AS ({_AR})",
            "s1 AS (SELECT pos, 0.0 - (0.0 - a) AS x, 0.0 - a AS v FROM ar WHERE round = 1)"]
    for r in range(2, ROUNDS + 1):
        ctes.append(f"""s{r} AS (SELECT s.pos, s.x - {lr} * ({beta} * s.v + (s.x - a.a)) AS x, {beta} * s.v + (s.x - a.a) AS v
            FROM s{r - 1} s JOIN ar a ON a.pos = s.pos AND a.round = {r})""")
    return "WITH " + ", ".join(ctes) + f" SELECT pos, round(x, 9) AS value FROM s{ROUNDS}"


def _adam_sql(eta=0.1, b1=0.9, b2=0.99, tau=1e-9):
    ctes = [f"ar AS ({_AR})", "s0 AS (SELECT DISTINCT pos, 0.0::DOUBLE AS x, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM ar)"]
    for r in range(1, ROUNDS + 1):
        ctes.append(f"""d{r} AS (SELECT s.pos, s.x, {b1} * s.m + {1 - b1} * (a.a - s.x) AS m,
                {b2} * s.v + {1 - b2} * (a.a - s.x) * (a.a - s.x) AS v FROM s{r - 1} s JOIN ar a ON a.pos = s.pos AND a.round = {r}),
            s{r} AS (SELECT pos, x + {eta} * m / (sqrt(v) + {tau}) AS x, m, v FROM d{r})""")
    return "WITH " + ", ".join(ctes) + f" SELECT pos, round(x, 9) AS value FROM s{ROUNDS}"


@query("fed_avg_momentum", _momentum_sql())
def fed_avg_momentum(spark, sf):
    return fd.fed_avg_momentum(_round_avgs(spark, sf)).select("pos", r9("value").alias("value"))


@query("fed_adam", _adam_sql())
def fed_adam(spark, sf):
    return fd.fed_adam(_round_avgs(spark, sf)).select("pos", r9("value").alias("value"))


@query("site_subsets", f"""SELECT a.client || '+' || b.client AS subset, c.pos, round(sum(c.value * c.n) / sum(c.n), 9) AS value
    FROM (SELECT DISTINCT CAST(label AS VARCHAR) AS client FROM embeddings) a
    JOIN (SELECT DISTINCT CAST(label AS VARCHAR) AS client FROM embeddings) b ON a.client < b.client
    JOIN ({_CM}) c ON CAST(c.client AS VARCHAR) IN (a.client, b.client) GROUP BY 1, 2""")
def site_subsets(spark, sf):
    """FedAvg over every pair of clients; membership is a short literal
    table (subset, client), so each client's weights are read once."""
    cm = _cm(spark, sf).withColumn("client", F.col("label").cast("string"))
    clients = sorted(r[0] for r in cm.select("client").distinct().collect())
    members = [(name, c) for name, cs in fd.subset_memberships(clients, 2) for c in cs]
    mem = spark.createDataFrame(members, "subset string, client string")
    j = cm.join(F.broadcast(mem), "client")
    return fd.fed_avg(j, ["subset", "pos"]).select("subset", "pos", r9("value").alias("value"))


CLIENTS, DIM = 3, 64
_FED_ROWS = f"""SELECT CAST(embedding AS DOUBLE[]) AS x, CASE WHEN label >= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y,
    CAST(floor({hash_unit_sql('vec_id', 3)} * {CLIENTS}) AS INTEGER) AS client, {hash_unit_sql('vec_id', 0)} AS u FROM embeddings"""
_FED_P = f"1 / (1 + exp(-(list_dot_product(x, w[1:{DIM}]) + w[{DIM + 1}])))"
_FED_LOSS = f"avg(-(y * ln(greatest(least({_FED_P}, 1 - 1e-12), 1e-12)) + (1 - y) * ln(1 - greatest(least({_FED_P}, 1 - 1e-12), 1e-12))))"


def _fed_rows(spark, sf):
    return _emb(spark, sf).select("vec_id", F.col("embedding").cast("array<double>").alias("x"), (F.col("label") >= 5).cast("int").alias("y"),
                                  F.floor(hash_unit("vec_id", 3) * CLIENTS).cast("int").alias("client"))


@query("rounds_sweep", f"""WITH RECURSIVE e AS MATERIALIZED ({_FED_ROWS}),
    rec(n_rounds, r, w) AS (
      SELECT unnest({SWEEP_ROUNDS}), 0, list_transform(range({DIM + 1}), lambda i: 0.0::DOUBLE)
      UNION ALL
      SELECT n_rounds, r + 1, list(v ORDER BY pos) FROM (
        SELECT n_rounds, r, pos, sum(n * (wv - 0.5 * 0.5 * (1 + cos(pi() * r / n_rounds)) * g / n)) / sum(n) AS v FROM (
          SELECT n_rounds, r, client, pos, any_value(wv) AS wv, sum(gx) AS g, count(*) AS n FROM (
            SELECT n_rounds, r, client, unnest(w) AS wv, unnest(list_append(list_transform(x, lambda a: a * err), err)) AS gx,
                   unnest(range({DIM + 1})) AS pos
            FROM (SELECT rec.*, e.client, e.x, {_FED_P} - y AS err FROM rec JOIN e ON floor(e.u * rec.n_rounds) = rec.r WHERE rec.r < rec.n_rounds))
          GROUP BY n_rounds, r, client, pos)
        GROUP BY n_rounds, r, pos)
      GROUP BY n_rounds, r)
    SELECT n_rounds, round(sqrt(any_value(list_dot_product(w, w))), 9) AS norm, round({_FED_LOSS}, 9) AS loss
    FROM (SELECT * FROM rec WHERE r = n_rounds) CROSS JOIN e GROUP BY n_rounds""")
def rounds_sweep(spark, sf):
    """Metric against the number of averaging rounds: federations of 1, 5, 10
    and 50 rounds side by side, each over every row (one shard a round); size
    of the final weights and their loss."""
    runs = {str(r): fd.FedRun(n_rounds=r, local_steps=1) for r in SWEEP_ROUNDS}
    w, rounds = fd.fed_train_runs(_fed_rows(spark, sf), "client", "x", "y", DIM, runs, key="vec_id")
    norm = w.groupBy("run").agg(r9(F.sqrt(F.sum(F.col("value") * F.col("value")))).alias("norm"))
    last = rounds.where(F.col("round").cast("string") == F.col("run")).select("run", F.round("loss", 9).alias("loss"))
    return norm.join(last, "run").select(F.col("run").cast("int").alias("n_rounds"), "norm", "loss")


def _fed_sql(strategy: str) -> str:
    """Three rounds of two local steps, unrolled."""
    rule = {"fedavg": ("z[4]", "z[2]", "z[3]"),
            "fedavgm": ("z[1] - (0.5 * z[2] + (z[1] - z[4]))", "0.5 * z[2] + (z[1] - z[4])", "z[3]"),
            "fedadam": ("z[1] + 0.1 * (0.9 * z[2] + (1 - 0.9) * (z[4] - z[1])) / (sqrt(0.99 * z[3] + (1 - 0.99) * (z[4] - z[1]) * (z[4] - z[1])) + 1e-9)",
                        "0.9 * z[2] + (1 - 0.9) * (z[4] - z[1])", "0.99 * z[3] + (1 - 0.99) * (z[4] - z[1]) * (z[4] - z[1])")}[strategy]
    zeros = f"list_transform(range({DIM + 1}), lambda i: 0.0::DOUBLE)"
    ctes = [f"s0 AS (SELECT {zeros} AS w, {zeros} AS m, {zeros} AS v)"]
    for r in (1, 2, 3):
        here = f"(SELECT * FROM e WHERE floor(u * 3) + 1 = {r})"
        lr = f"(0.5 * 0.5 * (1 + cos(pi() * {r - 1} / 3)))"
        ctes.append(f"l{r}_0 AS (SELECT client, count(*) AS n, any_value(w) AS w FROM {here} CROSS JOIN s{r - 1} GROUP BY client)")
        for k in (1, 2):
            ctes.append(f"""g{r}_{k} AS (SELECT client, list(g ORDER BY pos) AS g FROM (SELECT client, pos, sum(gx) AS g FROM (
                SELECT client, unnest(list_append(list_transform(x, lambda a: a * err), err)) AS gx, unnest(range({DIM + 1})) AS pos
                FROM (SELECT h.client, h.x, {_FED_P} - y AS err FROM {here} h JOIN l{r}_{k - 1} l ON h.client = l.client)) GROUP BY client, pos) GROUP BY client)""")
            ctes.append(f"l{r}_{k} AS (SELECT l.client, n, list_transform(list_zip(w, g), lambda z: z[1] - {lr} * z[2] / n) AS w FROM l{r}_{k - 1} l JOIN g{r}_{k} g ON l.client = g.client)")
        ctes.append(f"""a{r} AS (SELECT list(a ORDER BY pos) AS a FROM (SELECT pos, sum(wv * n) / sum(n) AS a FROM (
            SELECT n, unnest(w) AS wv, unnest(range({DIM + 1})) AS pos FROM l{r}_2) GROUP BY pos))""")
        ctes.append(f"s{r} AS (SELECT " + ", ".join(f"list_transform(list_zip(w, m, v, a), lambda z: {x}) AS {n}" for x, n in zip(rule, ("w", "m", "v"))) + f" FROM s{r - 1} CROSS JOIN a{r})")
    ctes.append(f"loss AS (SELECT round({_FED_LOSS}, 9) AS loss FROM e CROSS JOIN s3)")
    return f"SELECT * FROM (WITH {', '.join(ctes)} SELECT '{strategy}' AS strategy, unnest(range({DIM + 1}))::INTEGER AS pos, round(unnest(w), 9) AS value, loss FROM s3 CROSS JOIN loss)"


@query("fed_train", f"WITH e AS MATERIALIZED ({_FED_ROWS}) " + " UNION ALL ".join(_fed_sql(x) for x in sorted(fd.STRATEGIES)))
def fed_train(spark, sf):
    """Federated logistic regression on the embeddings: 3 clients, 3 rounds,
    each server strategy, side by side; the loss of the last round rides along."""
    runs = {name: fd.FedRun(3, 2, strategy=name) for name in fd.STRATEGIES}
    w, rounds = fd.fed_train_runs(_fed_rows(spark, sf), "client", "x", "y", DIM, runs, key="vec_id")
    last = rounds.where("round = 3").select("run", F.round("loss", 9).alias("loss"))
    return w.join(last, "run").select(F.col("run").alias("strategy"), "pos", r9("value").alias("value"), "loss")


@query("scorer_hook", """WITH w AS (SELECT list(value ORDER BY pos) AS w FROM (SELECT pos, sum(value * n) / sum(n) AS value
        FROM (""" + _CM + """) GROUP BY pos))
    SELECT vec_id, round(1.0 / (1.0 + exp(-list_dot_product(list_transform(embedding, lambda v: CAST(v AS DOUBLE)), w.w))), 6) AS score
    FROM embeddings, w""")
def scorer_hook(spark, sf):
    """Score rows with a model loaded once per task (here the averaged weight
    vector, a short array) through an iterator ``mapInPandas``: numpy per
    Arrow batch, never per row."""
    w = [r["value"] for r in fd.fed_avg(_cm(spark, sf)).orderBy("pos").collect()]   # model size, not data size
    bw = spark.sparkContext.broadcast(np.asarray(w, dtype=np.float64))

    def score(batches):
        wv = bw.value
        for pdf in batches:
            x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, len(wv)))
            s = 1.0 / (1.0 + np.exp(-(x @ wv)))
            yield pd.DataFrame({"vec_id": pdf["vec_id"].to_numpy(), "score": np.round(s, 6)})

    return _emb(spark, sf).select("vec_id", "embedding").mapInPandas(score, "vec_id long, score double")


# ---------------------------------------------------------------- baselines
KINDS = ("logistic", "boosted")
#: Features: counts of past tokens, or their presence.
METHODS = ("counts", "presence")
N_REP, SEED = 1000, 42
POOLED = "all"


def _inference(spark, sf):
    """(past token lists with split, outcome flags), staged once per driver."""
    d = D(spark, sf)
    if "inference" not in d._fitted:
        win = wnw.winnow_duration(d.token_ids(), drv.WINNOW_SECONDS)
        rows = wnw.inference_rows(win, keys=("site", "subject_id", "split"), ordering=drv.ORDERING).drop("tokens")
        flags = wnw.outcome_flags(win, d.subjects(), wnw.outcome_tokens(d.vocab().df, drv.OUTCOMES))
        d._fitted["inference"] = stage_table(rows, "inference", ["split"]), stage_table(flags, "flags")
    return d._fitted["inference"]


def _cells(spark, sf, method):
    """(rows of all splits with features, qualified labels, {(site or all,
    outcome): cell}) of the cells whose training rows have both labels."""
    d = D(spark, sf)
    key = ("cells", method)
    if key not in d._fitted:
        rows, flags = _inference(spark, sf)
        feats = stage_table(cm.sparse_rows(rows, ["site", "subject_id", "split"], binary=method == "presence"), "features", ["split"])
        labels = stage_table(flags.where("not past").join(rows.select("site", "subject_id", "split"), ["site", "subject_id"]).select(
            "site", "subject_id", "split", "outcome", F.col("future").cast("double").alias("label")), "labels", ["split"])
        both = labels.where("split = 'train'").rollup("outcome", "site").agg(F.count_distinct("label").alias("k"), F.grouping_id().alias("g"))
        found = both.where("k = 2 and g < 3").select(F.when(F.col("g") == 1, POOLED).otherwise(F.col("site")).alias("s"), "outcome").orderBy("outcome", "s").collect()
        d._fitted[key] = feats, labels, {(r.s, r.outcome): i for i, r in enumerate(found)}
    return d._fitted[key]


def _models(spark, sf, kind, method):
    """All cells' models, fitted together."""
    d = D(spark, sf)
    key = ("models", kind, method)
    if key not in d._fitted:
        feats, labels, cells = _cells(spark, sf, method)
        keys = ["site", "subject_id"]
        train = cm.with_cells(feats.where("split = 'train'").drop("split"), labels.where("split = 'train'"), keys, cells, ["site", "outcome"], POOLED)
        train = stage_table(train.select("idx", "val", "cells", "labels"), "train-rows")
        if kind == "logistic":
            dim = (d.vocab().df.agg(F.max("token_id")).first()[0] or 0) + 1
            d._fitted[key] = cm.fit_logistic_cells(train, len(cells), dim, tol=1e-3)
        else:
            d._fitted[key] = cm.fit_boosted_cells(train, len(cells))
    return d._fitted[key]


def _scored(spark, sf, kind, method):
    """Held-out scores of every (training site or all, outcome) model on every
    site: train_site, site, subject_id, outcome, future, score."""
    d = D(spark, sf)
    key = ("scored", kind, method)
    if key not in d._fitted:
        feats, labels, cells = _cells(spark, sf, method)
        by_outcome = {}
        for (_, o), c in cells.items():
            by_outcome.setdefault(o, []).append(c)
        wanted = spark.createDataFrame(sorted(by_outcome.items()), "outcome string, for_cells array<int>")
        rows = (labels.where("split = 'held_out'").join(F.broadcast(wanted), "outcome")
                .join(feats.where("split = 'held_out'").drop("split"), ["site", "subject_id"])
                .select("site", "subject_id", "outcome", (F.col("label") == 1).alias("future"), "idx", "val", "for_cells"))
        models = _models(spark, sf, kind, method)
        scored = (cm.score_logistic_cells if kind == "logistic" else cm.score_boosted_cells)(rows, models)
        names = spark.createDataFrame([(c, s) for (s, _), c in cells.items()], "cell int, train_site string")
        d._fitted[key] = stage_table(scored.join(F.broadcast(names), "cell").drop("cell"), "fit-scores")
    return d._fitted[key]


def _areas(spark, sf, kind, method):
    d = D(spark, sf)
    key = ("areas", kind, method)
    if key not in d._fitted:
        d._fitted[key] = stage_table(auc_table(_scored(spark, sf, kind, method), ["train_site", "site", "outcome"])
                                     .withColumnRenamed("site", "test_site"), "fit-areas")
    return d._fitted[key]


def _rocs(spark, sf, kind):
    return _areas(spark, sf, kind, "counts").select("train_site", "test_site", "outcome", "roc_auc")


@query("fit_logistic")
def fit_logistic(spark, sf):
    """Logistic regression per (outcome, training site) on sparse past-token
    counts, all cells in one job a round; held-out ROC AUC on every site."""
    return _rocs(spark, sf, "logistic").where(F.col("train_site") != POOLED)


@query("fit_boosted")
def fit_boosted(spark, sf):
    """Leaf-wise boosted trees per (outcome, training site), all cells in the
    same rounds; held-out ROC AUC on every site."""
    return _rocs(spark, sf, "boosted").where(F.col("train_site") != POOLED)


@query("fit_pooled")
def fit_pooled(spark, sf):
    return _rocs(spark, sf, "logistic").where(F.col("train_site") == POOLED)


@query("cross_site_eval")
def cross_site_eval(spark, sf):
    """Every training site (and the pooled model) × every test site ×
    outcome, one grouped metric job over the long scores."""
    return _rocs(spark, sf, "logistic")


_FIT_CELLS = """SELECT coalesce(i.site, 'all') AS train_site, f.outcome, count(*) AS n, count(*) FILTER (WHERE f.future) AS positives, true AS optimal
    FROM (SELECT site, subject_id FROM infr WHERE split = 'train') i JOIN flags f ON f.site = i.site AND f.subject_id = i.subject_id
    WHERE NOT f.past GROUP BY GROUPING SETS ((i.site, f.outcome), (f.outcome)) HAVING count(DISTINCT f.future) = 2"""


@query("fit_logistic_cells", sql(_FIT_CELLS))
def fit_logistic_cells(spark, sf):
    """Per model: training rows, positives, and whether the gradient of its
    objective vanishes at the result (largest component below 0.01)."""
    _, labels, cells = _cells(spark, sf, "counts")
    names = spark.createDataFrame([(c, s, o) for (s, o), c in cells.items()], "cell int, train_site string, outcome string")
    got = _models(spark, sf, "logistic", "counts").join(names, "cell").select("train_site", "outcome", "n", (F.col("residual") < 0.01).alias("optimal"))
    pos = labels.where("split = 'train'").rollup("outcome", "site").agg(F.count_if(F.col("label") == 1).alias("positives")).where("outcome is not null")
    return got.join(pos.withColumn("train_site", F.coalesce("site", F.lit(POOLED))).drop("site"), ["train_site", "outcome"])


def _side_by_side(spark, sf, step):
    """``step`` of every kind and method of the grid, fitted and scored at the
    same time: a round of a fit is a short job, and one fit's rounds leave the
    cores idle between them. In the order of the grid."""
    for m in METHODS:
        _cells(spark, sf, m)  # what the fits share is made before
    grid = [(k, m) for k in KINDS for m in METHODS]
    with ThreadPoolExecutor(len(grid)) as pool:
        return [(k, m, got) for (k, m), got in zip(grid, pool.map(lambda km: step(spark, sf, *km), grid), strict=True)]


@query("baseline_grid")
def baseline_grid(spark, sf):
    """Both kinds of model on counts and on presence, every training site and
    the pooled model, every test site and outcome: ROC and PR area."""
    parts = [got.select(F.lit(k).alias("kind"), F.lit(m).alias("method"), "*") for k, m, got in _side_by_side(spark, sf, _areas)]
    return reduce(lambda a, b: a.unionByName(b), parts).select("kind", "method", "train_site", "test_site", "outcome",
                                                               F.round("roc_auc", 9).alias("roc_auc"), F.round("pr_auc", 9).alias("pr_auc"))


@query("baseline_cis")
def baseline_cis(spark, sf):
    """95 % intervals of the outcome-averaged areas of every grid cell; the
    draws are shared by all models on the same subjects."""
    parts = [got.select(F.concat_ws("/", F.lit(k), F.lit(m), "train_site").alias("model"), "site", "subject_id", "outcome", "future", "score")
             for k, m, got in _side_by_side(spark, sf, _scored)]
    got = bs.bootstrap_ci(reduce(lambda a, b: a.unionByName(b), parts), ("model", "site"), N_REP, SEED)
    name = F.split("model", "/")
    return got.select(name[0].alias("kind"), name[1].alias("method"), name[2].alias("train_site"), F.col("site").alias("test_site"), "metric",
                      F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi"))


@query("rep_score")
def rep_score(spark, sf):
    """Representation vectors → logistic-CV score on held-out rows."""
    e = _emb(spark, sf).withColumn("label", (F.col("label") >= 5).cast("double")) \
        .withColumn("_u", hash_unit("vec_id", 9))
    s = ml.rep_score(e.filter(F.col("_u") < 0.7), e.filter(F.col("_u") >= 0.7))
    return s.select("vec_id", "label", "score")


# ---------------------------------------------------------------- sequence loss
_CSL = """WITH w AS (SELECT lang AS site, string_split(lower(text), ' ') AS ws FROM documents),
    bg AS (SELECT site, ws[i] AS prev, ws[i + 1] AS nxt FROM w, LATERAL (SELECT unnest(range(1, len(ws))) AS i)),
    cnt AS (SELECT site, prev, nxt, count(*) AS c FROM bg GROUP BY ALL),
    pc AS (SELECT site, prev, sum(c) AS cp FROM cnt GROUP BY ALL),
    voc AS (SELECT site, count(DISTINCT word) AS V FROM (SELECT site, unnest(ws) AS word FROM w WHERE len(ws) >= 2) GROUP BY site),
    ms AS (SELECT DISTINCT site AS model_site FROM cnt)
SELECT ms.model_site, e.site AS eval_site,
    round(-sum(e.c * ln((coalesce(m.c, 0) + 1.0) / (coalesce(p.cp, 0) + 1.0 * v.V))) / sum(e.c), 9) AS loss,
    CAST(sum(e.c) AS BIGINT) AS n_bigrams
FROM cnt e CROSS JOIN ms JOIN voc v ON v.site = ms.model_site
LEFT JOIN cnt m ON m.site = ms.model_site AND m.prev = e.prev AND m.nxt = e.nxt
LEFT JOIN pc p ON p.site = ms.model_site AND p.prev = e.prev
GROUP BY ms.model_site, e.site"""


@query("cross_site_loss", _CSL)
def cross_site_loss(spark, sf):
    d = D(spark, sf).t("documents")
    out = csl(d, site="lang", text="text", alpha=1.0)
    return out.select("model_site", "eval_site", r9("loss").alias("loss"), "n_bigrams")
