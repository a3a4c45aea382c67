"""Bootstrap intervals and tests. Replicates are vectors of weights, summed
per score (see ``replicates``); what has a row per replicate is a table of
results per key.

Weights are drawn from Poisson(1) by a seeded hash of (outcome, subject) and
replicate: the number of times the row would be drawn. That approximates n
draws with replacement and needs no state, so two models scored on the same
subjects share draws (paired, S20) and a rerun gives the same numbers
(stateless, S21). ``exact=True`` draws exactly n rows with replacement from
every group instead, shared by the models in the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.operators.replicates import multinomial_cells, poisson_cells, poisson_cuts, replicate, replicate_areas

__all__ = ["poisson_cuts", "replicate", "replicate_stats", "bootstrap_ci", "paired_diff_ci", "bootstrap_pvalue",
           "check_paired", "check_paired_all"]


def replicate_stats(scores: DataFrame, keys, n_rep: int, seed, draw_keys, outcome: str = "outcome", exact: bool = False,
                    group=None, subject: str = "subject_id") -> DataFrame:
    """Per (keys…, metric, rep): AUCs averaged over outcomes. An outcome
    without both classes in a replicate voids it (null), as an average with NaN
    would. ``draw_keys`` name the columns that a Poisson draw depends on;
    ``group`` the columns within which an exact draw is made."""
    keys = list(keys)
    each = [*keys, outcome]
    if exact:
        cells = multinomial_cells(scores, each, n_rep, seed, group, subject)
    else:
        cells = poisson_cells(scores, each, n_rep, seed, draw_keys)
    areas = replicate_areas(cells, T.StructType([scores.schema[c] for c in each]), n_rep)
    v = areas.unpivot([*each, "rep"], ["roc_auc", "pr_auc"], "metric", "v")
    return v.groupBy(*keys, "metric", "rep").agg(F.when(F.count("v") == F.count(F.lit(1)), F.avg("v")).alias("stat"))


def _interval(stats: DataFrame, keys, alpha: float) -> DataFrame:
    ok = stats.filter(F.col("stat").isNotNull() & ~F.isnan("stat"))
    return ok.groupBy(*keys, "metric").agg(
        F.percentile("stat", F.lit(alpha / 2)).alias("lo"),
        F.percentile("stat", F.lit(1 - alpha / 2)).alias("hi"))


def bootstrap_ci(scores: DataFrame, keys=("site", "model"), n_rep: int = 1000, seed: int = 42,
                 alpha: float = 0.05, outcome: str = "outcome", subject: str = "subject_id",
                 exact: bool = False, site: str = "site") -> DataFrame:
    """(keys…, metric, lo, hi): percentile interval of the outcome-averaged
    ROC/PR AUC. Draws are per (replicate, outcome, subject), as the source
    draws a fresh sample per label; ``exact`` draws n of the n subjects of each
    (site, outcome)."""
    st = replicate_stats(scores, keys, n_rep, seed, [outcome, subject], outcome, exact, [site, outcome], subject)
    return _interval(st, list(keys), alpha)


def check_paired(a: DataFrame, b: DataFrame, on, label: str = "future") -> None:
    """Both models must score the same qualified rows with equal labels."""
    j = a.select(*on, F.col(label).alias("_la")).join(
        b.select(*on, F.col(label).alias("_lb")), list(on), "full")
    bad = j.filter(F.col("_la").isNull() | F.col("_lb").isNull() | (F.col("_la") != F.col("_lb"))).limit(1).collect()
    if bad:
        raise ValueError(f"paired scores differ in rows or labels, e.g. {bad[0].asDict()}")


def check_paired_all(scores: DataFrame, on, n_models: int, label: str = "future",
                     model: str = "model") -> None:
    """Every model scores every qualified row, with one label per row: one
    grouped pass over all models (first offending row reported)."""
    g = scores.groupBy(*on).agg(F.count_distinct(model).alias("_m"),
                                F.count_distinct(label).alias("_l"), F.count(label).alias("_n"))
    bad = g.filter((F.col("_m") != n_models) | (F.col("_l") > 1) | (F.col("_n") != F.col("_m"))).limit(1).collect()
    if bad:
        raise ValueError(f"paired scores differ in rows or labels, e.g. {bad[0].asDict()}")


def paired_diff_ci(scores: DataFrame, base: str, models=None, keys=("site",), n_rep: int = 1000,
                   seed: int = 42, alpha: float = 0.05, outcome: str = "outcome",
                   subject: str = "subject_id", model: str = "model", exact: bool = False) -> DataFrame:
    """(keys…, model, metric, lo, hi) of model − base, with shared draws per
    (replicate, outcome, subject) so the difference is paired. ``exact`` draws
    n of the n subjects of each (keys…, outcome)."""
    keys = list(keys)
    models = models or [r[0] for r in scores.select(model).distinct().collect() if r[0] != base]
    sub = scores.filter(F.col(model).isin([base] + list(models)))
    check_paired_all(sub, keys + [outcome, subject], len(models) + 1, model=model)
    st = replicate_stats(sub, keys + [model], n_rep, seed, [outcome, subject], outcome, exact, keys + [outcome], subject)
    # the base statistic rides along on the small per-replicate table (one
    # pass; two filtered branches would recompute the replicates)
    same = Window.partitionBy(*keys, "metric", "rep")
    d = (st.withColumn("_b", F.max(F.when(F.col(model) == base, F.col("stat"))).over(same))
         .filter(F.col(model) != base).withColumn("stat", F.col("stat") - F.col("_b")))
    return _interval(d, keys + [model], alpha)


def bootstrap_pvalue(scores: DataFrame, base: str, other: str, keys=("site",), n_rep: int = 1000,
                     seed: int = 42, outcome: str = "outcome", subject: str = "subject_id",
                     model: str = "model", alternative: str = "two-sided", exact: bool = False) -> DataFrame:
    """Unpaired test of other − base: separate draws per model. Over replicates
    (ours): P(d ≤ 0) for "greater", P(d ≥ 0) for "less", and twice the smaller
    of them, at most 1, for "two-sided". Both models must score the same rows
    with equal labels."""
    if alternative not in ("two-sided", "greater", "less"):
        raise ValueError(f"unknown alternative {alternative!r}")
    keys = list(keys)
    sub = scores.filter(F.col(model).isin(base, other))
    check_paired_all(sub, keys + [outcome, subject], 2, model=model)
    st = replicate_stats(sub, keys + [model], n_rep, seed, [model, outcome, subject], outcome, exact, keys + [model, outcome], subject)
    d = (st.groupBy(*keys, "metric", "rep")
         .agg(F.max(F.when(F.col(model) == other, F.col("stat"))).alias("_o"),
              F.max(F.when(F.col(model) == base, F.col("stat"))).alias("_b"))
         .withColumn("d", F.col("_o") - F.col("_b"))
         .filter(F.col("d").isNotNull() & ~F.isnan("d")))
    g = d.groupBy(*keys, "metric").agg(F.avg((F.col("d") <= 0).cast("double")).alias("le"),
                                      F.avg((F.col("d") >= 0).cast("double")).alias("ge"))
    p = {"greater": F.col("le"), "less": F.col("ge")}.get(alternative, F.least(F.lit(1.0), 2 * F.least("le", "ge")))
    return g.select(*keys, "metric", p.alias("p_value"))
