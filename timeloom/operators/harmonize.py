"""Harmonization: unit conversion, forward fill, severity scores, encounter
blocks and table validation. All definitions here are ours where the source
calls an external package; each says so."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators.relational import unique_rows
from timeloom.operators.scans import forward_fill as _ffill
from timeloom.operators.scans import null_safe_join

__all__ = ["convert_dose_units", "forward_fill", "severity_score", "encounter_block",
           "block_summary", "validate_table"]


def convert_dose_units(df: DataFrame, factors: DataFrame, category: str, dose: str,
                       unit: str, preferred: DataFrame | None = None,
                       out: str = "dose_converted", status: str = "_convert_status") -> DataFrame:
    """dose × factor(unit → preferred unit of the category) (ours).

    ``factors``: (from_unit, to_unit, factor), unique per (from_unit, to_unit);
    ``preferred``: (category, to_unit), unique per category. Without
    ``preferred`` a unit's only factor decides. Every row stays, once: status
    is 'success', 'missing dose', 'unknown unit' (no factor from it at all),
    'no preferred unit' (the category has none) or 'no factor' (none to the
    preferred unit); only a success has a converted dose."""
    if preferred is None:
        f = unique_rows(factors, ["from_unit"], "factors").withColumn("_known", F.lit(True))
        j = df.join(f, F.col(unit) == F.col("from_unit"), "left")
        st = F.when(F.col("_known").isNull(), "unknown unit")
    else:
        p = unique_rows(preferred.select(F.col(category).alias("_cat"), F.col("to_unit").alias("_pref")), ["_cat"], "preferred")
        f = unique_rows(factors, ["from_unit", "to_unit"], "factors")
        known = factors.select(F.col("from_unit").alias("_k")).distinct().withColumn("_known", F.lit(True))
        j = (df.join(known, F.col(unit) == F.col("_k"), "left").drop("_k")
             .join(p, F.col(category) == F.col("_cat"), "left").drop("_cat")
             .join(f, (F.col(unit) == F.col("from_unit")) & (F.col("_pref") == F.col("to_unit")), "left"))
        j = j.withColumn("to_unit", F.col("_pref"))
        st = (F.when(F.col("_known").isNull(), "unknown unit").when(F.col("_pref").isNull(), "no preferred unit")
              .when(F.col("factor").isNull(), "no factor"))
    st = F.when(F.col(dose).isNull(), "missing dose").otherwise(st.otherwise("success"))
    return (j.withColumn(status, st)
            .withColumn(out, F.when(F.col(status) == "success", F.col(dose) * F.col("factor")))
            .withColumnRenamed("to_unit", f"{out}_unit")
            .drop("from_unit", "factor", "_known", "_pref"))


def forward_fill(df: DataFrame, keys, order: str, cols, bucket=None) -> DataFrame:
    """Carry settings forward within a stay (see ``scans.forward_fill``)."""
    return _ffill(df, keys, order, cols, bucket)


def severity_score(df: DataFrame, keys, component: str, value: str, cutoffs: dict,
                   higher_is_worse: dict | None = None, prefix: str = "sev_") -> DataFrame:
    """Worst value per (keys…, component), scored 0–4 by a cut-off table
    (score = number of cut-offs reached), one column per component and the
    total. Components absent in a block score 0 (ours)."""
    higher_is_worse = higher_is_worse or {}
    comps = list(cutoffs)
    worst_hi = F.max(value)
    worst_lo = F.min(value)
    g = df.filter(F.col(component).isin(comps)).groupBy(*keys, component).agg(
        worst_hi.alias("_hi"), worst_lo.alias("_lo"))
    score = F.lit(0)
    for comp in comps:
        hi = higher_is_worse.get(comp, True)
        w = F.col("_hi") if hi else F.col("_lo")
        n = reduce(lambda a, b: a + b,
                   [F.when((w >= c) if hi else (w <= c), 1).otherwise(0) for c in cutoffs[comp]])
        score = F.when(F.col(component) == comp, n).otherwise(score)
    scored = g.withColumn("_s", score)
    wide = scored.groupBy(*keys).pivot(component, comps).agg(F.first("_s"))
    wide = wide.fillna(0, subset=comps)
    wide = wide.select(*keys, *[F.col(c).cast("int").alias(f"{prefix}{c}") for c in comps])
    total = reduce(lambda a, b: a + b, [F.col(f"{prefix}{c}") for c in comps])
    return wide.withColumn(f"{prefix}total", total.cast("int"))


def encounter_block(stays: DataFrame, group: str, start: str, end: str, gap_hours: float = 6.0,
                    stay: str = "stay_id", out: str = "encounter_block", bucket=None) -> DataFrame:
    """Stitch a patient's stays into blocks: a stay starts a new block when it
    begins more than ``gap_hours`` after the latest end so far (ours).

    Two scans over (patient, bucket) summaries, which combine associatively:
    the greatest end of earlier buckets tells where a bucket's blocks begin,
    the number of blocks begun in earlier buckets numbers them. ``bucket`` is
    any column that grows with the start (default: its month), so a patient
    with very many stays is many windows."""
    b = stays.withColumn("_bkt", F.date_trunc("MONTH", F.col(start)) if bucket is None else bucket)
    keys = [group, "_bkt"]
    earlier = Window.partitionBy(group).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    ends = b.groupBy(*keys).agg(F.max(end).alias("_end")).select(*keys, F.max("_end").over(earlier).alias("_end_before"))
    w = Window.partitionBy(*keys).orderBy(F.col(start).asc_nulls_first(), F.col(stay))
    b = null_safe_join(b, ends, keys)
    prev_end = F.greatest(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_end_before"))
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_hours * 3600.0))
    b = b.withColumn("_prev", prev_end)
    b = b.withColumn("_new", F.when(F.col("_prev").isNull() | (F.col(start) > F.col("_prev") + gap), 1).otherwise(0))
    begun = b.groupBy(*keys).agg(F.sum("_new").alias("_k")).select(*keys, F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_blocks"))
    b = b.withColumn("_in", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return null_safe_join(b, begun, keys).withColumn(out, (F.col("_blocks") + F.col("_in")).cast("long")).drop(
        "_bkt", "_end_before", "_prev", "_new", "_in", "_blocks")


def block_summary(df: DataFrame, keys, time: str, ident: str) -> DataFrame:
    """Latest time and the last non-null id per block."""
    return df.groupBy(*keys).agg(
        F.max(time).alias("max_time"),
        F.max_by(F.col(ident), F.when(F.col(ident).isNotNull(), F.col(time))).alias(f"last_{ident}"))


def validate_table(df: DataFrame, name: str, not_null=(), keys=(), domains: dict | None = None) -> DataFrame:
    """One aggregate pass → report rows (table, check, n_bad): null counts for
    required columns, values outside a domain, and duplicate keys."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"null:{c}") for c in not_null]
    for c, values in (domains or {}).items():
        aggs.append(F.sum((~F.col(c).isin(values)).cast("long")).alias(f"domain:{c}"))
    rep = df.agg(*aggs)
    checks = [c for c in rep.columns if c != "rows"]
    long = rep.unpivot([], checks, "check", "n_bad") if checks else None
    parts = [] if long is None else [long]
    if keys:
        dup = (df.groupBy(*keys).count().filter("count > 1")
               .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("n_bad"))
               .select(F.lit("unique:" + ",".join(keys)).alias("check"), "n_bad"))
        parts.append(dup)
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select(F.lit(name).alias("tbl"), "check", F.coalesce("n_bad", F.lit(0)).cast("long").alias("n_bad"))
