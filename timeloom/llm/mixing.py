"""Mixing sources to target weights.

A source's words, document after document in a fixed pseudorandom order, are
packed into fixed-length blocks. The source's slots are dealt to the output
shards by a multinomial draw; slot j holds block perm(j mod n), where perm is a
keyed permutation of the source's n block numbers. Every block is therefore
used either floor(slots / n) or one more time, and joining slots with blocks by
(source, block) gives the mix. The last slot is cut to the words still missing,
so each source gives exactly its target, rounded to words.

Targets: the sources, by code point with null last, weigh 3, 1, 2, repeating,
and share ``share`` times all words; no target passes ``cap`` times its
source's words, the excess goes to the others by weight (water filling).

Nothing is gathered: word offsets are prefix sums over (source, bucket) totals
and windows inside a bucket, so a source that holds a third of all rows spreads
over all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.llm.common import let, n_words, words_of
from timeloom.session import stage_table

BLOCK_WORDS = 32
SHARDS = 64
BUCKETS = 1024
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEED = 7


def _rounds(half: int, seed: int, forward: bool, left, right):
    """Four Feistel rounds on two halves of ``half`` bits (numpy arrays)."""
    import numpy as np

    mask = np.uint64((1 << half) - 1)
    for r in range(4) if forward else range(3, -1, -1):
        x = (right if forward else left) + np.uint64((seed * 4 + r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        f = (x ^ (x >> np.uint64(31))) & mask
        left, right = (right, left ^ f) if forward else (right ^ f, left)
    return left, right


def permute(j, n: int, seed: int, forward: bool = True):
    """Image (or with ``forward=False`` the origin) of the numbers ``j`` under
    a keyed permutation of 0 .. n - 1: a Feistel network over the next even
    power of two, walked until it falls below n."""
    import numpy as np

    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    x = np.asarray(j, dtype=np.uint64).copy()
    todo = np.arange(len(x))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = _rounds(half, seed & 0xFFFFFFFF, forward, x[todo] >> shift, x[todo] & mask)
            x[todo] = (left << shift) | right
            todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, weight, target) from rows with source and size.

    The windows run over one row per source. Sources compare by code point
    (Spark's byte order of UTF-8 is the same order); null comes last."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    # fill by the level at which a source is full: full ones stop there, the
    # others share what is left by weight
    level = F.col("source_size") * cap / F.col("weight")
    upto = Window.orderBy(level, F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = (per.withColumn("_all", F.sum("source_size").over(whole) * share)
           .withColumn("_full", F.coalesce(F.sum(F.col("source_size") * cap).over(upto), F.lit(0.0)))
           .withColumn("_rest", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
           .withColumn("_level", (F.col("_all") - F.col("_full")) / F.col("_rest")))
    # the water level: the first (least) source that does not fill up sets it
    first = F.min(F.when(F.col("_level") < level, F.struct(level.alias("at"), F.col("_level").alias("water")))).over(whole)
    return per.select("source", "source_size", "weight",
                      F.least(F.col("source_size") * float(cap),
                              F.coalesce(F.col("weight") * first["water"], F.col("source_size") * float(cap))).alias("target"))


def lay_out(docs: DataFrame, block_words: int = BLOCK_WORDS, buckets: int = BUCKETS, seed: int = SEED):
    """(documents with size and start, block pieces).

    ``start`` is the offset of a document's words in its source. A piece is the
    part of a block that one document fills: (source, start, block, at, words),
    ``at`` being its first word in the document."""
    h = F.xxhash64(F.lit(seed), "doc_id", "size", "_text")
    rows = docs.withColumn("_h", h).withColumn("_bucket", F.pmod("_h", F.lit(buckets)))
    rows = stage_table(rows.drop("_text"), "mix-docs")
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_n"))
            .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_base"))
    inside = Window.partitionBy("source", "_bucket").orderBy("_h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(base, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
              .select("doc_id", "source", "size", (F.col("_base") + F.col("_in")).alias("start")))
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = (placed.where("size > 0").select("source", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
              .withColumn("_from", F.greatest("start", F.col("block") * block_words))
              .withColumn("_to", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words))
              .select("source", "start", "block", (F.col("_from") - F.col("start")).alias("at"),
                      (F.col("_from") - F.col("block") * block_words).alias("in_block"),
                      (F.col("_to") - F.col("_from")).alias("words")))
    return placed, pieces


def deal_slots(per_source: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Slots of the mix: (source, slot, shard, block, keep).

    ``keep`` is the number of the block's words that the slot takes, all
    (``block_words``) but for the source's last slot. The numbers of slots per
    shard are one multinomial draw per source, seeded by the source's name, so
    reruns agree; the slots themselves are generated in ranges."""
    size, target = F.col("source_size"), F.round("target").cast("long")
    span = 1 << 16

    @F.pandas_udf("long")
    def last_at(n: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([int(permute([m - 1], int(m), int(k), forward=False)[0]) for m, k in zip(n, key, strict=True)], dtype="int64")

    @F.pandas_udf("array<long>")
    def draw(slots: pd.Series, key: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series([np.cumsum(np.random.Generator(np.random.PCG64(int(k) & 0xFFFFFFFF)).multinomial(int(s), [1 / shards] * shards))
                          for s, k in zip(slots, key, strict=True)])

    n = F.ceil(size / block_words)
    plan = (per_source.where("source_size > 0").select("source", n.alias("n"), size.alias("source_size"), target.alias("want"),
                                                       F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("\0null"))).alias("key"))
            .withColumn("last_at", last_at("n", "key"))
            .withColumn("short", F.col("n") * block_words - F.col("source_size"))
            .withColumn("rounds", F.floor(F.col("want") / F.col("source_size")))
            .withColumn("rest", F.col("want") - F.col("rounds") * F.col("source_size")))

    def given(r):
        return r * block_words - F.when(F.col("last_at") < r, F.col("short")).otherwise(0)

    least = F.ceil(F.col("rest") / block_words)
    plan = (plan.withColumn("part", F.when(given(least) < F.col("rest"), least + 1).otherwise(least))
            .withColumn("cut", F.when(F.col("part") > 0, given(F.col("part")) - F.col("rest")).otherwise(0))
            .withColumn("slots", F.col("rounds") * F.col("n") + F.col("part")))
    plan = plan.withColumn("upto", draw("slots", "key"))
    ranges = (plan.where("slots > 0")
              .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(span).cast("long"))).alias("lo"))
              .repartition(F.col("source"), F.col("lo")))

    def generate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            for r in batch.itertuples(index=False):
                j = np.arange(r.lo, min(r.lo + span, r.slots), dtype=np.int64)
                block = permute(j % r.n, int(r.n), int(r.key))
                full = np.where(block == r.n - 1, block_words - r.short, block_words)
                yield pd.DataFrame({"source": r.source, "slot": j, "shard": np.searchsorted(np.asarray(r.upto), j, side="right"),
                                    "block": block, "keep": np.where(j == r.slots - 1, full - r.cut, full)})

    return ranges.mapInPandas(generate, "source string, slot long, shard long, block long, keep long")


def mix(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP,
        block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED):
    """(documents, mix).

    documents: doc_id, source, size, start, source_size, target, one row per
    input row; mix: source, shard, slot, start, at, words: slot after slot, the
    words that are taken of the document at ``start`` in the source, from its
    word ``at`` on. Size is the number of words (null text: 0); a source or
    document without words gives none. A null source is a source of its own.
    Repeated rows are documents of their own; extra columns are left out."""
    sized = documents.select(F.col("doc_id"), F.col("source").cast("string").alias("source"),
                             n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_text"))
    placed, pieces = lay_out(sized, block_words, seed=seed)
    placed = stage_table(placed, "mix-placed")
    per_source = stage_table(targets(placed, weights, share, cap), "mix-targets")
    slots = deal_slots(per_source, block_words, shards, seed)
    # the planner cannot know how many slots a source makes: no broadcast
    taken = (slots.withColumnRenamed("source", "_s").withColumnRenamed("block", "_b").hint("merge")
             .join(pieces, F.col("_s").eqNullSafe(F.col("source")) & (F.col("_b") == F.col("block")))
             .withColumn("words", F.least("words", F.col("keep") - F.col("in_block"))).where("words > 0")
             .select("source", "shard", "slot", "start", "at", "words"))
    p = per_source.select(F.col("source").alias("_s"), "source_size", "target")
    docs = placed.join(p, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return docs, taken


def taken_per_document(docs: DataFrame, taken: DataFrame) -> DataFrame:
    """``docs`` with ``taken``, the number of its words in the mix."""
    sums = taken.groupBy(F.col("source").alias("_s"), F.col("start").alias("_t")).agg(F.sum("words").alias("_taken"))
    on = F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_t")) & (F.col("size") > 0)
    return docs.join(sums, on, "left").withColumn("taken", F.coalesce("_taken", F.lit(0)).cast("long")).drop("_s", "_t", "_taken")


def passes(docs: DataFrame, taken: DataFrame) -> DataFrame:
    """The mix by document: one row per (document, turn) with the spans, (at,
    words) in order, that this turn takes of its words.

    A word's first use in the mix belongs to turn 1, its second to turn 2: the
    stretches of a document are split by how often their block was drawn
    before, so no turn takes a word twice. Gathered per document and turn, with
    at most size / block words + 2 stretches."""
    turn = F.row_number().over(Window.partitionBy("source", "start", "at").orderBy("slot"))
    spans = (taken.withColumn("turn", turn).groupBy(F.col("source").alias("_s"), F.col("start").alias("_t"), "turn")
             .agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("spans")))
    on = F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_t")) & (F.col("size") > 0)
    return docs.join(spans, on).select("doc_id", "source", "size", "start", "turn", "spans")


def cut_words(text, spans) -> "F.Column":
    """The words of the spans, joined by single spaces."""
    return let(words_of(text), lambda w: F.array_join(F.flatten(F.transform(
        spans, lambda s: F.slice(w, s["at"].cast("int") + 1, s["words"].cast("int")))), " "))
