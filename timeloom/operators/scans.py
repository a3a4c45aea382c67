"""Ordered scans (running sums, forward fill) that stay parallel when one key
holds a large share of the rows.

A window partitioned by key alone puts a hot key into one task. Here each
key's rows are cut into ordered buckets; a per-bucket aggregate (one row per
bucket) is scanned first, and that carry is added inside each (key, bucket)
window. The result is exact; buckets only spread the work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["null_safe_join", "range_buckets", "running_sums", "forward_fill"]


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null, so that a null key is a key
    like any other; ``right``'s key columns are dropped."""
    keys = list(keys)
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def range_buckets(df: DataFrame, keys, order: str, n_buckets: int = 64,
                  accuracy: int = 10_000, out: str = "_bkt") -> DataFrame:
    """Bucket = number of approximate per-key quantiles ≤ the order value, so
    buckets follow the order and equal values share a bucket. A null order
    value has bucket −1 (nulls come first, as in an ascending window). The
    quantile table has n_buckets−1 numbers per key (keys × buckets in all)."""
    keys = list(keys)
    if n_buckets <= 1:
        return df.withColumn(out, F.lit(0))
    probs = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    q = df.groupBy(*keys).agg(F.percentile_approx(F.col(order).cast("double"), probs, accuracy)
                              .alias("_qs"))
    v = F.col(order).cast("double")
    below = F.size(F.array_distinct(F.filter("_qs", lambda x: x < v)))
    return (null_safe_join(df, q, keys, "left")
            .withColumn(out, F.when(v.isNull() | F.col("_qs").isNull(), -1).otherwise(below))
            .drop("_qs"))


def running_sums(df: DataFrame, keys, order: str, values, descending: bool = False,
                 inclusive: bool = True, n_buckets: int = 64, prefix: str = "cum_") -> DataFrame:
    """Running sums of ``values`` along ``order`` within each key. Rows with
    equal order values must already be aggregated into one row (as after a
    group-by on (keys, order)); ``inclusive=False`` excludes the current row."""
    keys = list(keys)
    o = F.col(order).desc() if descending else F.col(order).asc()
    hi = Window.currentRow if inclusive else -1
    if n_buckets <= 1:   # keys are many and small (e.g. bootstrap replicates): one window
        w = Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, hi)
        return df.withColumns({f"{prefix}{v}": F.coalesce(F.sum(v).over(w), F.lit(0)) for v in values})
    b = range_buckets(df, keys, order, n_buckets)
    if descending:
        b = b.withColumn("_bkt", -F.col("_bkt"))
    per = b.groupBy(*keys, "_bkt").agg(*[F.sum(v).alias(f"_b_{v}") for v in values])
    wk = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*keys, "_bkt", *[F.coalesce(F.sum(f"_b_{v}").over(wk), F.lit(0)).alias(f"_c_{v}")
                                         for v in values])
    wb = Window.partitionBy(*keys, "_bkt").orderBy(o).rowsBetween(Window.unboundedPreceding, hi)
    j = null_safe_join(b, carry, keys + ["_bkt"])
    for v in values:
        j = j.withColumn(f"{prefix}{v}", F.col(f"_c_{v}") + F.coalesce(F.sum(v).over(wb), F.lit(0)))
    return j.drop("_bkt", *[f"_c_{v}" for v in values])


def forward_fill(df: DataFrame, keys, order: str, cols, bucket: Column | None = None) -> DataFrame:
    """Carry the last non-null value of each column forward within each key,
    along ``order`` (ties broken by the caller's order column being unique).

    ``bucket`` (e.g. the day of the time column) splits a key's rows; the last
    non-null value of earlier buckets is found on the one-row-per-bucket table
    and joined back, so no task holds a whole key. Null keys are keys, null
    order values come first (their bucket must be null too); every row stays."""
    keys = list(keys)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    b = df.withColumn("_bkt", bucket)
    last = b.groupBy(*keys, "_bkt").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(F.col(order).isNotNull(), F.col(order)))).alias(f"_l_{c}")
        for c in cols])
    wk = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, "_bkt", *[F.last(f"_l_{c}", ignorenulls=True).over(wk).alias(f"_c_{c}")
                                         for c in cols])
    wb = Window.partitionBy(*keys, "_bkt").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    j = null_safe_join(b, carry, keys + ["_bkt"])
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(wb), F.col(f"_c_{c}")))
    return j.drop("_bkt", *[f"_c_{c}" for c in cols])
