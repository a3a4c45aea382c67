"""Helpers shared by the operators: word patterns, Arrow slices bounded in
bytes, stage tables and distributed connected components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.session import release, stage_table

#: Words of the contracts: runs of anything but space, tab, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"
#: The same white space as a split pattern.
SPACE = r"[\x20\x09-\x0D]+"


def words_of(text) -> "F.Column":
    """array<string> of the words of a text column (null: no words).

    Outer white space goes first, so splitting gives no empty word but the
    single one of an empty text, which is filtered away."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "")
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def let(value, body) -> "F.Column":
    """``body(value)`` with the value computed once per row. Naming a column
    does not ensure that: the optimizer may put its expression back into every
    place, lambdas over elements included."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_words(text) -> "F.Column":
    """Number of words without building them: word ends after squeezing."""
    return F.size(words_of(text)).cast("long")


def arrow_slices(batches, column: int, max_bytes: int = 4 << 20) -> Iterator:
    """Cut record batches so that the text column of each holds about
    ``max_bytes`` at most (one longer text makes a slice of its own)."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start, batch.num_rows - start)


def per_process(key: tuple, make: Callable):
    """``make()``, made once in a Python worker and kept for its later tasks:
    for vocabularies, which are read-only and of a fixed size. Task functions
    travel by value, so a global of this module would not outlive a task."""
    held = sys.modules.setdefault("_timeloom_llm_held", types.ModuleType("_timeloom_llm_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges.

    Alternating large-star and small-star rounds: every round only takes a
    per-node minimum (combined before the shuffle) and joins it back, so no
    component is ever gathered in one task, and a chain needs a logarithmic
    number of rounds. Each round is written to the shared folder, which cuts
    the lineage. Nodes may be of any orderable type; an edge with a null end
    is dropped, self-links add nothing. Raises if ``rounds`` do not suffice.
    """
    spark = edges.sparkSession
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
         .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = stage_table(e, "cc")
    mark = None
    for _ in range(rounds):
        # large star: neighbours above u go to the least of u's neighbourhood
        sym = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # small star: u and its lower neighbours go to the least of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p")).select("p.*")
        before, e = e, stage_table(small.where("u != v").distinct(), "cc")
        release(before)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = e.groupBy("u").agg(F.min("v").alias("component"))
    out = stage_table(stars.select(F.col("u").alias("node"), "component")
                      .unionByName(stars.select(F.col("component").alias("node"), "component").distinct()), "cc-parts")
    release(e)
    return out
