"""Tie-aware ROC and PR areas, grouped: one job computes every (site, model,
outcome[, replicate]) cell. Optional row weights make the same code serve
the bootstrap (weight = how often a row was drawn)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions.scalar import fill_nan, round_even
from timeloom.operators.scans import null_safe_join, running_sums

__all__ = ["qualify", "score_counts", "roc_auc", "pr_auc", "auc_table"]


def qualify(scores: DataFrame, past: str = "past", score: str = "score") -> DataFrame:
    """Rows whose outcome is not already in the past (S19; a null flag drops
    the row, ours), with NaN/null scores → 0 and ±inf clipped (S18)."""
    return scores.filter(~F.col(past)).withColumn(score, fill_nan(score))


def score_counts(scores: DataFrame, keys, label: str = "future", score: str = "score",
                 weight: str | None = None) -> DataFrame:
    """(keys…, _s, pos, neg): weighted label counts per distinct score. Both
    areas start from this; it is the only shuffle of the row-level data."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    y = F.col(label).cast("boolean")
    return scores.groupBy(*keys, F.col(score).alias("_s")).agg(
        F.sum(F.when(y, w).otherwise(0.0)).alias("pos"),
        F.sum(F.when(~y, w).otherwise(0.0)).alias("neg"))


def _counts(scores, keys, label, score, weight):
    if "_s" in scores.columns and "pos" in scores.columns:
        return scores.select(*keys, "_s", "pos", "neg")
    return score_counts(scores, keys, label, score, weight)


def roc_auc(scores: DataFrame, keys, label: str = "future", score: str = "score",
            weight: str | None = None, n_buckets: int = 64, out: str = "roc_auc") -> DataFrame:
    """Σ_s pos_s · (neg below s + ½ neg at s) / (P·N) per key; ties count one
    half. Null when a key has no positives or no negatives. ``scores`` may
    also be the output of ``score_counts``."""
    keys = list(keys)
    c = _counts(scores, keys, label, score, weight)
    c = running_sums(c, keys, "_s", ["neg"], inclusive=False, n_buckets=n_buckets)
    g = c.groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("_num"),
                             F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return g.select(*keys, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                                  F.col("_num") / (F.col("_p") * F.col("_n"))).alias(out))


def pr_auc(scores: DataFrame, keys, label: str = "future", score: str = "score",
           weight: str | None = None, places: int = 4, n_buckets: int = 64,
           out: str = "pr_auc") -> DataFrame:
    """Trapezoid area under (recall, precision) over thresholds at the
    distinct scores rounded half-to-even to ``places`` (S16), starting at
    (recall 0, precision 1) (S17). The previous point of each threshold is the
    running sum minus the current step, so no ordered ``lag`` is needed.
    Null when a key has no positives."""
    keys = list(keys)
    if "_s" in scores.columns and "pos" in scores.columns:   # already counted by raw score
        c = (scores.groupBy(*keys, round_even("_s", places).alias("_s"))
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    else:
        s = scores.withColumn("_r", round_even(score, places))
        c = _counts(s, keys, label, "_r", weight)
    c = running_sums(c, keys, "_s", ["pos", "neg"], descending=True, inclusive=True, n_buckets=n_buckets)
    if n_buckets <= 1:
        c = c.withColumn("_P", F.sum("pos").over(Window.partitionBy(*keys)))
    else:
        c = null_safe_join(c, c.groupBy(*keys).agg(F.sum("pos").alias("_P")), keys)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    ptp, pfp = tp - F.col("pos"), fp - F.col("neg")
    prec = F.try_divide(tp, tp + fp)
    pprec = F.when(ptp + pfp > 0, F.try_divide(ptp, ptp + pfp)).otherwise(F.lit(1.0))
    rec, prec_rec = F.try_divide(tp, F.col("_P")), F.try_divide(ptp, F.col("_P"))
    area = (rec - prec_rec) * (prec + pprec) / 2
    g = c.groupBy(*keys).agg(F.sum(area).alias("_a"), F.max("_P").alias("_P"))
    return g.select(*keys, F.when(F.col("_P") > 0, F.col("_a")).alias(out))


def auc_table(scores: DataFrame, keys, **kw) -> DataFrame:
    """ROC and PR area side by side per key."""
    keys = list(keys)
    c = score_counts(scores, keys, kw.pop("label", "future"), kw.pop("score", "score"), kw.pop("weight", None))
    return null_safe_join(roc_auc(c, keys, **kw), pr_auc(c, keys, **kw), keys)


def roc_pr_from_counts(counts: DataFrame, keys, places: int = 4) -> DataFrame:
    """Both areas from one ordered pass over ``score_counts`` output:
    (keys…, metric, v).

    Rounding is monotone, so one descending sort by the raw score serves
    both: ROC takes the negatives below a score as N − (running negatives);
    PR reads the running counts at the last row of each rounded-score group
    (an aggregate on the same partitioning, no second sort). For many small
    keys (bootstrap replicates): each key is one window partition."""
    keys = list(keys)
    part = Window.partitionBy(*keys)
    run = part.orderBy(F.col("_s").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = (counts.withColumn("cp", F.sum("pos").over(run)).withColumn("cn", F.sum("neg").over(run))
         .withColumn("P", F.sum("pos").over(part)).withColumn("N", F.sum("neg").over(part)))
    # one chain: per (key, rounded score) carry the ROC numerator along
    g = c.groupBy(*keys, round_even("_s", places).alias("_r")).agg(
        F.sum(F.col("pos") * (F.col("N") - F.col("cn") + 0.5 * F.col("neg"))).alias("rn"),
        F.max("cp").alias("tp"), F.max("cn").alias("fp"), F.sum("pos").alias("dp"), F.sum("neg").alias("dn"),
        F.max("P").alias("P"), F.max("N").alias("N"))
    tp, fp = F.col("tp"), F.col("fp")
    ptp, pfp = tp - F.col("dp"), fp - F.col("dn")
    prec = F.try_divide(tp, tp + fp)
    pprec = F.when(ptp + pfp > 0, F.try_divide(ptp, ptp + pfp)).otherwise(F.lit(1.0))
    area = (F.try_divide(tp, F.col("P")) - F.try_divide(ptp, F.col("P"))) * (prec + pprec) / 2
    k = g.groupBy(*keys).agg(F.sum("rn").alias("rn"), F.sum(area).alias("a"),
                             F.max("P").alias("P"), F.max("N").alias("N"))
    k = k.select(*keys,
                 F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("rn") / (F.col("P") * F.col("N"))).alias("roc_auc"),
                 F.when(F.col("P") > 0, F.col("a")).alias("pr_auc"))
    return k.unpivot(keys, ["roc_auc", "pr_auc"], "metric", "v")
