"""Quantiles of groups of any size: mergeable sketches, and exact ranks.

Sketches (KLL) are small binary values that merge without loss of their error
bound, so a table of one sketch per (site, prefix, code) answers for any union
of sites without reading the events again.

Exact quantiles narrow in rounds. A sketch of a group's values gives every
wanted rank an interval that holds it (checked by exact counts of the values
below and inside; where the sketch was off, the interval is the whole group
again); only values inside stay, as (value, count). A round keeps some
``2 / NARROW`` of the values, whatever their distribution, and equal values are
one row from the first aggregation on. When few different values are left, a
window over those finds the rank. No task holds a group's values, and nothing
but the largest count of a round reaches the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators.scans import null_safe_join
from timeloom.session import release, stage_table

__all__ = ["sketch_table", "merge_sketches", "sketch_quantiles", "exact_quantiles"]

#: Size of a sketch; its rank error is some 0.3 % (99 % of the time).
SKETCH_K = 800
#: Ranks on each side of the wanted one that an interval takes in, as a share of the group.
NARROW = 0.01
#: Different values of a group from which another round is worth it.
FEW_VALUES = 50_000


def numbers(value) -> Column:
    """The value as a double; null where it is NaN."""
    v = F.col(value) if isinstance(value, str) else value
    v = v.cast("double")
    return F.when(~F.isnan(v), v)


def sketch_table(df: DataFrame, by, value: str, k: int = SKETCH_K) -> DataFrame:
    """(by…, n, sketch): one KLL sketch per group of the values that are
    neither null nor NaN; groups without any are left out. One partial
    aggregation, a few KB per group cross the network."""
    return (df.select(*by, numbers(value).alias("_v")).where("_v is not null").groupBy(*by)
            .agg(F.count("_v").alias("n"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch")))


def merge_sketches(table: DataFrame, by) -> DataFrame:
    """The sketch table of coarser groups (e.g. without the site)."""
    return table.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(table: DataFrame, probs, out: str = "breaks") -> DataFrame:
    """A sketch table with ``out`` array<double>: values whose rank is ``probs``
    of the group, within the sketch's error."""
    return table.withColumn(out, F.expr(f"kll_sketch_get_quantile_double(sketch, {_sql_doubles(probs)})"))


def _sql_doubles(values) -> str:
    return "array(" + ", ".join(f"CAST({float(v)!r} AS DOUBLE)" for v in values) + ")"


def exact_quantiles(df: DataFrame, by, value: str, probs, out: str = "breaks", few: int = FEW_VALUES) -> DataFrame:
    """(by…, n, ``out`` array<double>): the quantiles at ``probs`` with linear
    interpolation between the two ranks around (n − 1)·p, exactly. Null and NaN
    values take no part, null keys are a key, groups without values are left
    out. Infinite values are values."""
    by, probs = list(by), [float(p) for p in probs]
    rows = df.select(*by, numbers(value).alias("_v")).where("_v is not null").withColumn("_c", F.lit(1).cast("long"))
    groups = stage_table(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), "quantile-groups")
    if not probs:
        return groups.select(*by, "n", F.array().cast("array<double>").alias(out))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(probs)]))
    # a target: _rank, counted from 0, among the _m values that are still in play for it
    targets = groups.select(*by, "n", wanted.alias("t")).select(*by, "n", "t.i", ((F.col("n") - 1) * F.col("t.p")).alias("_h"))
    targets = targets.select(*by, "i", "n", "_h", F.floor("_h").alias("_rank"), F.col("n").alias("_m"))
    key, many = by, groups.agg(F.max("n")).first()[0] or 0
    while many > few:
        rows, targets = _narrow(rows, targets, by, key)
        key, before = [*by, "i"], many
        many = rows.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
        if many >= before:
            raise RuntimeError("quantiles do not narrow any further")
    cells = rows.groupBy(*key, "_v").agg(F.sum("_c").alias("_c"))
    upto = Window.partitionBy(*key).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.select(*key, "_v", F.sum("_c").over(upto).alias("_to"))
    found = null_safe_join(ranked, targets, key).groupBy(*by, "i", "n", "_h").agg(
        F.min(F.when(F.col("_to") > F.col("_rank"), F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("_to") > F.col("_rank") + 1, F.col("_v"))).alias("_hi"))
    part, lo, hi = F.col("_h") - F.floor("_h"), F.col("_lo"), F.col("_hi")
    at = F.when((part == 0) | (lo == hi), lo).otherwise(lo + part * (hi - lo))
    return (found.groupBy(*by, "n").agg(F.array_sort(F.collect_list(F.struct("i", at.alias("v")))).alias("_b"))
            .select(*by, "n", F.col("_b.v").alias(out)))


def _narrow(rows: DataFrame, targets: DataFrame, by, key):
    """One round: (values inside their target's interval as (by…, i, _v, _c),
    targets with their rank and number among those)."""
    own = [*by, "i"]
    # rows that count 2^b times share a sketch; its 1,000 quantiles stand for its values
    bits = F.when(F.col("_c") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.lit(50)), lambda b: F.col("_c").bitwiseAND(F.pow(F.lit(2.0), b).cast("long")) != 0))
    sketches = rows.select(*key, "_v", F.explode(bits).alias("_bit")).groupBy(*key, "_bit").agg(
        F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("_s"), F.count(F.lit(1)).alias("_k"))
    grid = _sql_doubles([(j + 0.5) / 1000 for j in range(1000)])
    points = sketches.select(*key, (F.pow(F.lit(2.0), "_bit") * F.col("_k") / 1000).alias("_w"),
                             F.explode(F.expr(f"kll_sketch_get_quantile_double(_s, {grid})")).alias("_v"))
    points = points.groupBy(*key, "_v").agg(F.sum("_w").alias("_w"))
    points = points.withColumn("_to", F.sum("_w").over(Window.partitionBy(*key).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    spread = F.greatest(F.col("_m") * NARROW, F.lit(2.0))
    near = null_safe_join(targets, points, key)
    aimed = near.groupBy(*own, "n", "_h", "_rank", "_m").agg(
        F.max(F.when(F.col("_to") <= F.col("_rank") - spread, F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("_to") - F.col("_w") >= F.col("_rank") + 1 + spread, F.col("_v"))).alias("_hi"))
    aimed = stage_table(aimed, "quantile-aimed")
    # the intervals' ends cut a group's values into cells: 2 j + 1 is the j-th end itself, 2 j what lies before it
    ends = aimed.groupBy(*key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.filter(F.array("_lo", "_hi"), lambda x: x.isNotNull()))))).alias("_ends"))
    cell = 2 * F.size(F.filter("_ends", lambda x: x < F.col("_v"))) + F.array_contains("_ends", F.col("_v")).cast("int")
    counts = null_safe_join(rows, ends, key).select(*key, cell.alias("_cell"), "_c").groupBy(*key, "_cell").agg(F.sum("_c").alias("_c"))
    first = F.when(F.col("_lo").isNull(), -1).otherwise(2 * F.array_position("_ends", F.col("_lo")) - 1)
    last = F.when(F.col("_hi").isNull(), 1 << 30).otherwise(2 * F.array_position("_ends", F.col("_hi")) - 1)
    ranges = null_safe_join(aimed, ends, key).withColumn("_from", first.cast("int")).withColumn("_to", last.cast("int"))
    held = null_safe_join(ranges, counts, key).groupBy(*own, "n", "_h", "_rank", "_m", "_from", "_to").agg(
        F.coalesce(F.sum(F.when(F.col("_cell") < F.col("_from"), F.col("_c"))), F.lit(0)).alias("_below"),
        F.coalesce(F.sum(F.when(F.col("_cell").between(F.col("_from"), F.col("_to")), F.col("_c"))), F.lit(0)).alias("_in"))
    # both ranks inside? if not, the whole group stays for this target
    good = (F.col("_rank") >= F.col("_below")) & (F.least(F.col("_rank") + 1, F.col("_m") - 1) < F.col("_below") + F.col("_in"))
    narrowed = stage_table(held.select(
        *own, "n", "_h", F.when(good, F.col("_rank") - F.col("_below")).otherwise(F.col("_rank")).alias("_rank"),
        F.when(good, F.col("_in")).otherwise(F.col("_m")).alias("_m"),
        F.when(good, F.col("_from")).otherwise(-1).alias("_from"), F.when(good, F.col("_to")).otherwise(1 << 30).alias("_to")), "quantile-targets")
    # one row per key with all its targets' cells: a value comes out once for each that holds it
    wants = narrowed.groupBy(*key).agg(F.collect_list(F.struct("i", "_from", "_to")).alias("_wants"))
    placed = null_safe_join(null_safe_join(rows, ends, key), wants, key).select(*key, "_v", "_c", cell.alias("_cell"), "_wants")
    hits = F.filter("_wants", lambda w: (F.col("_cell") >= w["_from"]) & (F.col("_cell") <= w["_to"]))
    kept = placed.select(*by, "_v", "_c", F.explode(F.transform(hits, lambda w: w["i"])).alias("i"))
    kept = stage_table(kept.groupBy(*own, "_v").agg(F.sum("_c").alias("_c")), "quantile-values")
    if hasattr(rows, "_stage_path"):
        release(rows)
    release(aimed)
    return kept, narrowed.drop("_from", "_to")
