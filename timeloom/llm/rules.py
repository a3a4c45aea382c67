"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target
against the raw corpus, with plain counting rules before it. Native: built-in
functions only.

Words and word pairs are hashed to ``BUCKETS`` cells. Two multinomials are
counted over whole texts, one over all documents and one over all trusted ones,
both with ``PRIOR`` added to every cell. A document's ratio is the
mean over its n-grams of log p_target(cell) - log p_raw(cell); it is kept if
that is at least ``THRESHOLD`` nats and no base rule failed. The cells are a
fixed number, so what is collected and sent back is bounded (80 KB).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.llm.common import let, words_of

BUCKETS = 10_000
PRIOR = 1.0
THRESHOLD = -0.15
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
WINDOW = 3
# The symbols of the contract.
SYMBOLS = "#*$%&|<>"
#: Low bits of a packed window that hold its position.
POSITION_BITS = 24
#: Places in which a trusted id meets its documents.
SALTS = 8


def ngram_cells(words: Column) -> Column:
    """array<long> of the cells of all words and all neighbouring pairs."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)))
    two = F.when(F.size(words) > 1, F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda i: F.pmod(F.xxhash64(F.get(words, i - 1), F.get(words, i)), F.lit(BUCKETS)))).otherwise(F.array().cast("array<bigint>"))
    return F.concat(one, two)


def window_hashes(words: Column) -> Column:
    """Hashes of the 3-word windows, in order (fewer words: none)."""
    return F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))


def packed_windows(hashes: Column) -> Column:
    """Sorted longs of a hash's upper bits with its position below, so that
    equal windows are neighbours."""
    return F.sort_array(F.transform(hashes, lambda h, i: F.shiftleft(F.shiftright(h, POSITION_BITS), POSITION_BITS).bitwiseOR(i.cast("long"))))


def repeated_starts(hashes: Column, packed: Column) -> Column:
    """Positions, ascending, of windows that occur twice or more. Neighbours
    in ``packed`` count as equal if their full 64-bit hashes are."""
    mask = F.lit((1 << POSITION_BITS) - 1)

    def full(x):
        return F.get(hashes, x.bitwiseAND(mask).cast("int"))

    twice = F.filter(packed, lambda x, i: (full(x) == full(F.get(packed, i - 1))) | (full(x) == full(F.get(packed, i + 1))))
    return F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(mask)))


def covered_words(starts: Column) -> Column:
    """Words in the windows that begin at ``starts`` (ascending)."""
    each = F.transform(starts, lambda s, i: F.least(F.lit(WINDOW).cast("long"), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW).cast("long"))))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)


def base_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id column, the counts of the base rules, and ``cells``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, r"[\x20\x09-\x0D]+", "")) > 0)

    def measured(w):
        return let(window_hashes(w), lambda h: let(packed_windows(h), lambda p: let(
            repeated_starts(h, p), lambda starts: F.struct(
                F.size(w).cast("long").alias("n_words"), covered_words(starts).alias("n_repeat_words"), ngram_cells(w).alias("cells")))))

    rows = df.select(
        F.col(id_col), let(words_of(F.col(text_col)), measured).alias("_m"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    return rows.select(id_col, "_m.n_words", "word_chars", "n_symbols", "n_dup_lines", "_m.n_repeat_words", "_m.cells")


def cell_counts(df: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cell, raw, target): n-grams of all rows and of rows whose id is in the
    column ``_id`` of ``trusted``.

    No text is shuffled: a document meets the ids as its cells, two bytes each.
    Rows of one id are dealt over ``SALTS`` places, rows without id over all."""
    number = F.monotonically_increasing_id()
    salt = F.when(F.col(id_col).isNull(), number).otherwise(F.pmod(number, F.lit(SALTS)))
    # BUCKETS cells fit two bytes
    cells = df.select(F.col(id_col).alias("_doc"), salt.alias("_at"),
                      let(words_of(F.col(text_col)), ngram_cells).cast("array<smallint>").alias("_cells"))
    places = trusted.select("_id", F.lit(1).alias("_t"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_place"))
    # merge at every size: trusted ids grow with the corpus
    marked = cells.hint("merge").join(places, (F.col("_doc") == F.col("_id")) & (F.col("_at") == F.col("_place")), "left")
    return (marked.select(F.coalesce("_t", F.lit(0)).alias("_t"), F.explode("_cells").alias("cell"))
            .groupBy("cell").agg(F.count("*").alias("raw"), F.sum("_t").alias("target")))


def log_ratios(counts: DataFrame) -> list[float]:
    """log p_target - log p_raw of every cell; all 0 without trusted text."""
    raw, target = [PRIOR] * BUCKETS, [PRIOR] * BUCKETS
    for r in counts.collect():  # BUCKETS rows at most
        raw[r["cell"]] += r["raw"]
        target[r["cell"]] += r["target"]
    if sum(target) <= PRIOR * BUCKETS:
        return [0.0] * BUCKETS
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(a) + shift for t, a in zip(target, raw, strict=True)]


def judge(df: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: the id column, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept.

    ``trusted_ids`` has the ids of the trusted documents in its first column
    (repeats and ids without a document do no harm). A null text has no words,
    fails the base rules and has ratio 0, as has any text without words.
    Repeated rows are judged alike; extra columns are left out; an empty table
    gives an empty one. Without a trusted document every ratio is 0."""
    trusted = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("_id")).where("_id is not null").distinct()
    ratios = log_ratios(cell_counts(df, trusted, id_col, text_col))
    # one literal array: parsed once by the optimizer, not built per row
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    rows = base_counts(df, id_col, text_col)
    mean = let(F.col("cells"), lambda cells: F.aggregate(cells, F.lit(0.0), lambda a, c: a + F.get(table, c.cast("int"))) / F.size(cells))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (rows.withColumn("ratio", F.when(F.col("n_words") > 0, mean).otherwise(0.0)).drop("cells")
            .withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold)))
