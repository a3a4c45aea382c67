"""Generic relational building blocks: guarded joins, checked pivots, grids,
per-group picks, ranked windows, samples and shards."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions.scalar import hash_bigint, hash_unit
from timeloom.operators.numbering import equal_parts, number_rows

__all__ = [
    "CardinalityError", "join_guard", "unique_rows", "checked_join", "first_per_group",
    "pivot_checked", "grid_complete", "top_bottom_k", "cumulative_share",
    "share_of_group", "custom_order", "seeded_sample", "split_table_parts",
    "contiguous_shards", "round_shard", "melt", "transpose_table", "concat_metrics", "and_all",
    "union_all",
]


class CardinalityError(ValueError):
    pass


def _keys(on):
    return [on] if isinstance(on, str) else list(on)


def join_guard(df: DataFrame, on, what: str = "right side") -> DataFrame:
    """Raise if ``on`` is not unique in ``df`` (the "1" side of m:1 / 1:1).

    One aggregate pass; only the first duplicate key reaches the driver."""
    keys = _keys(on)
    dup = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if dup:
        raise CardinalityError(f"{what}: key {keys} not unique, e.g. {dup[0].asDict()}")
    return df


def unique_rows(df: DataFrame, on, what: str = "right side") -> DataFrame:
    """``df`` with the promise that ``on`` is unique checked inside the plan:
    one row per key; a second row of a key raises when the plan runs. The
    aggregation is by the keys that the join needs anyway, so a sort-merge
    join reuses its exchange, and no job runs while the query is built."""
    keys = _keys(on)
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *([F.any_value(F.struct(*rest)).alias("_v")] if rest else []))
    told = F.concat(F.lit(f"{what}: key {keys} not unique, e.g. "), F.to_json(F.struct(*keys)))
    one = g.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(told).cast("boolean")))
    return one.select(*[F.col(c) if c in keys else F.col("_v")[c].alias(c) for c in df.columns])


def checked_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                 validate: str | None = None, in_plan: bool = False) -> DataFrame:
    """Join with the cardinality promise checked: "m:1", "1:m", "1:1".
    ``in_plan`` checks when the plan runs (``unique_rows``), else a job checks
    now and raises ``CardinalityError``."""
    check = unique_rows if in_plan else join_guard
    if validate in ("m:1", "1:1"):
        right = check(right, on, "right side")
    if validate in ("1:m", "1:1"):
        left = check(left, on, "left side")
    return left.join(right, on, how)


def first_per_group(df: DataFrame, group, order: list[Column]) -> DataFrame:
    """Earliest whole row per group under ``order`` (append a unique key to it
    as tie-break). Nulls sort first with ``asc()``, so a null start wins, as
    in the source. Uses a window, not ``min_by``, which skips nulls (S2)."""
    w = Window.partitionBy(*_keys(group)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def pivot_checked(df: DataFrame, index, column: str, value: str, values=None) -> DataFrame:
    """Long → wide with one cell per (index, column); a duplicate cell raises
    (S13) instead of a silent pick. The check rides in the same aggregation
    (a count per cell and ``raise_error``), so there is no extra pass.
    Passing ``values`` skips the job that finds the distinct pivot values."""
    idx = _keys(index)
    g = df.groupBy(*idx)
    g = g.pivot(column, values) if values is not None else g.pivot(column)
    wide = g.agg(F.first(value).alias("v"), F.count(F.lit(1)).alias("n"))
    names = values if values is not None else sorted(
        {c.rsplit("_", 1)[0] for c in wide.columns if c not in idx})
    out = [F.when(F.col(f"`{v}_n`") > 1, F.raise_error(F.lit(f"pivot: duplicate cell for column {v}")))
           .otherwise(F.col(f"`{v}_v`")).alias(str(v)) for v in names]
    return wide.select(*idx, *out)


def grid_complete(spark, dims: dict, facts: DataFrame) -> DataFrame:
    """Every combination of the dimension values (e.g. outcomes × models ×
    sites, each a short list), left-joined to the facts so a missing cell
    stays null (S24). The grid is built from the value lists, not by a
    cross join of tables."""
    names = list(dims)
    rows = list(product(*[dims[n] for n in names]))
    types = {n: facts.schema[n].dataType.simpleString() for n in names}
    grid = spark.createDataFrame(rows, ", ".join(f"{n} {types[n]}" for n in names))
    return grid.join(facts, names, "left")


def top_bottom_k(df: DataFrame, score: str, name: str, k: int = 5, by=None) -> DataFrame:
    """Rows ranked ``k`` highest and ``k`` lowest by score: ties go by name
    ascending in the top list and descending in the bottom list. Adds
    ``list`` ('top'/'bottom') and ``rank``."""
    part = _keys(by) if by else []
    wt = Window.partitionBy(*part).orderBy(F.col(score).desc(), F.col(name).asc())
    wb = Window.partitionBy(*part).orderBy(F.col(score).asc(), F.col(name).desc())
    top = df.withColumn("rank", F.row_number().over(wt)).filter(F.col("rank") <= k) \
        .withColumn("list", F.lit("top"))
    bottom = df.withColumn("rank", F.row_number().over(wb)).filter(F.col("rank") <= k) \
        .withColumn("list", F.lit("bottom"))
    return top.unionByName(bottom)


def cumulative_share(df: DataFrame, partition, order, value: str, out: str = "cum") -> DataFrame:
    w = (Window.partitionBy(*_keys(partition)).orderBy(*_keys(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(value).over(w))


def share_of_group(df: DataFrame, partition, value: str, out: str = "share") -> DataFrame:
    """value / group total with null → 0."""
    v = F.coalesce(F.col(value), F.lit(0.0))
    return df.withColumn(out, v / F.sum(v).over(Window.partitionBy(*_keys(partition))))


def custom_order(df: DataFrame, column: str, order: list, out: str = "ord") -> DataFrame:
    """Position of the value in an explicit list (1-based; 0 if absent)."""
    return df.withColumn(out, F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column)))


def seeded_sample(df: DataFrame, partition, key: str, n: int, seed: int = 0,
                  check: bool = True) -> DataFrame:
    """``n`` rows per partition chosen by a seeded hash of the key: the same
    rows on every run and for every model. Raises when a partition has fewer
    than ``n`` rows, like sampling without replacement would."""
    part = _keys(partition)
    if check:
        small = df.groupBy(*part).count().filter(F.col("count") < n).limit(1).collect()
        if small:
            raise ValueError(f"cannot sample {n} rows from {small[0].asDict()}")
    w = Window.partitionBy(*part).orderBy(hash_bigint(key, seed), F.col(key))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def split_table_parts(df: DataFrame, order, parts: int = 4, out: str = "part") -> DataFrame:
    """Cut an ordered table into equal parts (from 1); raises, when the plan
    runs, if the row count does not divide. Numbered by range partitions."""
    n = number_rows(df, [], _keys(order), "_i", "_n")
    told = F.raise_error(F.concat(F.col("_n").cast("string"), F.lit(f" rows do not split into {parts} equal parts"))).cast("int")
    return n.withColumn(out, F.when(F.col("_n") % parts == 0, equal_parts(F.col("_i"), F.col("_n"), parts)).otherwise(told)).drop("_i", "_n")


def contiguous_shards(df: DataFrame, order, n_rounds: int, out: str = "shard") -> DataFrame:
    """``df`` with the shard (from 1) that its row falls into when the ordered
    table is cut into ``n_rounds`` stretches; the first ones hold one row more
    where the count does not divide."""
    n = number_rows(df, [], _keys(order), "_i", "_n")
    return n.withColumn(out, equal_parts(F.col("_i"), F.col("_n"), n_rounds)).drop("_i", "_n")


def round_shard(df: DataFrame, key: str, rnd: int, n_rounds: int, seed: int = 0) -> DataFrame:
    """Rows of shard ``rnd`` (1-based) of ``n_rounds``: disjoint, complete,
    decided per row by a hash (no global order, no shuffle)."""
    return df.filter(F.floor(hash_unit(key, seed) * n_rounds) == (rnd - 1))


def melt(df: DataFrame, ids, cols, var: str = "variable", val: str = "value") -> DataFrame:
    return df.unpivot(_keys(ids), list(cols), var, val)


def transpose_table(df: DataFrame, index: str, header: str = "stat") -> DataFrame:
    """Rows become columns: unpivot every non-index column, pivot on index."""
    cols = [c for c in df.columns if c != index]
    long = df.unpivot([index], cols, header, "value")
    values = [r[0] for r in df.select(index).distinct().orderBy(index).collect()]
    return pivot_checked(long, header, index, "value", values)


def concat_metrics(frames: dict, on) -> DataFrame:
    """Side-by-side tables under metric prefixes, joined on the key."""
    out = None
    for metric, df in frames.items():
        ren = df.select(*_keys(on), *[F.col(c).alias(f"{metric}_{c}") for c in df.columns
                                       if c not in _keys(on)])
        out = ren if out is None else out.join(ren, _keys(on), "full")
    return out


def and_all(preds) -> Column:
    """A list of predicates AND-ed (a config ``filter_expr`` list)."""
    preds = [F.expr(p) if isinstance(p, str) else p for p in preds]
    return reduce(lambda a, b: a & b, preds)


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
