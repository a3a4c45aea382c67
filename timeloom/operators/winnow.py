"""Winnowing: split each timeline at a threshold into past and future, and
flag outcomes in each half. Works on the long token rows, keyed by subject;
arrays are only built for the inference rows themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.operators.scans import null_safe_join
from timeloom.operators.tokenize import DEFAULT_ORDERING, join_chunks, timeline_chunks

__all__ = ["winnow_duration", "winnow_first_occurrence", "outcome_tokens",
           "outcome_flags", "inference_rows", "flags_wide", "winnow_splits"]


def _with_cut(tokens: DataFrame, keys, cut) -> DataFrame:
    """The subject's cut time beside every row: a partial aggregate and a join
    (whose large partitions can be split), no window over a subject."""
    keys = list(keys)
    return null_safe_join(tokens, tokens.groupBy(*keys).agg(cut.alias("_cut")), keys)


def winnow_duration(tokens: DataFrame, seconds: int = 86400, keys=("site", "subject_id")) -> DataFrame:
    """``past`` = time ≤ timeline start + seconds (boundary in the past, ours).
    The start is the subject's first time (its BOS row)."""
    cut = F.min("time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    return _with_cut(tokens, keys, cut).withColumn("past", F.col("time") <= F.col("_cut")).drop("_cut")


def winnow_first_occurrence(tokens: DataFrame, token: str, keys=("site", "subject_id"),
                            col: str = "token") -> DataFrame:
    """Cut at the first occurrence of a token (that event is in the past).
    A subject without the token has no cut: everything is past (ours)."""
    cut = F.min(F.when(F.col(col) == token, F.col("time")))
    return _with_cut(tokens, keys, cut).withColumn("past", F.col("_cut").isNull() | (F.col("time") <= F.col("_cut"))).drop("_cut")


def outcome_tokens(vocab: DataFrame, patterns, token: str = "token") -> list[str]:
    """Vocabulary tokens matching any shell pattern (a short list)."""
    from timeloom.functions.scalar import matches_any_glob
    return [r[0] for r in vocab.filter(matches_any_glob(token, patterns)).select(token)
            .orderBy(token).collect()]


def outcome_flags(winnowed: DataFrame, subjects: DataFrame, outcomes: list[str],
                  keys=("site", "subject_id"), col: str = "token") -> DataFrame:
    """Long flags (keys…, outcome, past, future) for every subject × outcome.
    The outcome list is short (from the vocabulary), so the grid is an
    ``explode`` of a literal array, not a join."""
    keys = list(keys)
    hits = (winnowed.filter(F.col(col).isin(outcomes))
            .groupBy(*keys, F.col(col).alias("outcome"))
            .agg(F.max(F.col("past").cast("int")).alias("_p"), F.max((~F.col("past")).cast("int")).alias("_f")))
    grid = subjects.select(*keys, F.explode(F.array(*[F.lit(o) for o in outcomes])).alias("outcome"))
    return (grid.join(hits, keys + ["outcome"], "left")
            .select(*keys, "outcome", F.coalesce(F.col("_p") == 1, F.lit(False)).alias("past"),
                    F.coalesce(F.col("_f") == 1, F.lit(False)).alias("future")))


def inference_rows(winnowed: DataFrame, keys=("site", "subject_id"), value: str = "token_id",
                   ordering=DEFAULT_ORDERING, tie: str = "token") -> DataFrame:
    """(keys…, tokens[], tokens_past[]) in timeline order."""
    rows = winnowed.select(*keys, "time", "prefix", tie, F.col(value).alias("_v"), "past")
    chunks = timeline_chunks(rows, ["_v", "past"], ordering, keys, tie)
    pick = F.transform(F.filter(F.arrays_zip("_v", "past"), lambda x: x["past"]), lambda x: x["_v"])
    chunks = chunks.select(*keys, "chunk", F.col("_v").alias("tokens"), pick.alias("tokens_past"))
    return join_chunks(chunks, ["tokens", "tokens_past"], keys)


def flags_wide(flags: DataFrame, outcomes: list[str], keys=("site", "subject_id")) -> DataFrame:
    """``{outcome}_past`` / ``{outcome}_future`` boolean columns (the source's
    layout) by a pivot over the known outcome list."""
    long = flags.unpivot(list(keys) + ["outcome"], ["past", "future"], "half", "flag") \
        .withColumn("col", F.concat("outcome", F.lit("_"), "half"))
    names = [f"{o}_{h}" for o in outcomes for h in ("past", "future")]
    return long.groupBy(*keys).pivot("col", names).agg(F.first("flag"))


def winnow_splits(rows: DataFrame, path: str, split: str = "split") -> None:
    """One directory per split."""
    rows.write.mode("overwrite").partitionBy(split).parquet(path)
