"""Global numbering without a task that sees all rows.

Rows are range-partitioned by (keys, order), so a partition holds a stretch of
the order; counts per (keys, partition) give every stretch its offset, and a
row's number is that offset plus its place in the stretch. The sorted rows are
written once, which freezes the places. A key that holds most rows spreads over
its stretches; the only window runs over one row per (keys, partition)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators.scans import null_safe_join
from timeloom.session import stage_table

__all__ = ["number_rows", "equal_parts"]


def number_rows(df: DataFrame, keys, order, out: str, total: str | None = None) -> DataFrame:
    """``df`` with ``out``, the row's number from 0 within its keys along
    ``order`` (names or sort columns), and with ``total`` the number of rows of
    its keys. ``keys`` may be empty: then the numbering is global. Null keys
    are a key. Rows that tie in all of ``order`` are numbered in any order:
    append a unique column where that matters; very many ties are one
    stretch."""
    keys = list(keys)
    sort = [*keys, *order] or [F.lit(0)]
    at, part = "_at_" + out, "_part_" + out
    rows = stage_table(df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn(at, F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn(part, F.shiftright(at, 33))
    counts = rows.groupBy(*keys, part).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_c"))
    # without keys the window's rows are the partitions themselves
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    before = group.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*keys, part, (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
                         *([F.sum("_c").over(group).alias(total)] if total else []))
    base = stage_table(base, "offsets")
    return (null_safe_join(rows, base, [*keys, part]).withColumn(out, F.col("_base") + F.col(at))
            .drop(at, part, "_base"))


def equal_parts(number: Column, total: Column, parts: int) -> Column:
    """Part (from 1) of a row number from 0: the first ``total % parts`` parts
    hold one row more."""
    small, more = F.floor(total / parts), total % parts
    return F.when(number < more * (small + 1), F.floor(number / (small + 1))).otherwise(
        more + F.floor(F.try_divide(number - more * (small + 1), small))).cast("int") + 1
