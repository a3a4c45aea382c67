"""Describing and comparing sites: token statistics, divergence between
binned distributions, demographics and timeline summaries. Every function
groups by ``site`` (no per-site loop)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions.scalar import micros, trunc_div
from timeloom.operators.order_stats import exact_quantiles
from timeloom.operators.scans import null_safe_join

from timeloom.session import stage_table

__all__ = [
    "explode_timelines", "token_counts", "token_stats", "quantized_groups",
    "site_divergence", "outcome_rates", "demographics_table", "timeline_stats",
    "training_volume", "prompt_stats", "type_counts", "mean_pairwise",
    "matrix_marginals", "site_pairs", "BIN_TOKEN",
]

# A one-digit quantile bin at the very end of the token.
BIN_TOKEN = r"_Q[0-9]\z"
BIN_GROUP = r"^(.+)_Q[0-9]\z"


def explode_timelines(timelines: DataFrame, keys=("site", "subject_id"),
                      col: str = "tokens", out: str = "token") -> DataFrame:
    """One row per token; an empty or null list gives one null token."""
    return timelines.select(*keys, F.explode_outer(col).alias(out))


def token_counts(tokens: DataFrame, by=("site",), subject: str = "subject_id",
                 token: str = "token") -> DataFrame:
    """Occurrences and distinct timelines per (site, token). Partial
    aggregation happens before the shuffle."""
    return tokens.groupBy(*by, token).agg(
        F.count(F.lit(1)).alias("n_occurrences"),
        F.count_distinct(subject).alias("n_timelines_with_token"))


def token_stats(tokens: DataFrame, n_timelines: DataFrame | None = None, by=("site",),
                subject: str = "subject_id", token: str = "token") -> DataFrame:
    """Counts plus prevalence (distinct timelines / timeline rows, S8) and
    frequency (share of all tokens of the site).

    ``n_timelines``: (site, n_timelines) — the row count of the timeline table.
    When omitted it is the number of distinct subjects in ``tokens``."""
    by = list(by)
    counts = token_counts(tokens, by, subject, token)
    if n_timelines is None:
        n_timelines = tokens.groupBy(*by).agg(F.count_distinct(subject).alias("n_timelines"))
    w = Window.partitionBy(*by)
    return (counts.join(n_timelines, by)
            .withColumn("prevalence", F.col("n_timelines_with_token") / F.col("n_timelines"))
            .withColumn("frequency", F.col("n_occurrences") / F.sum("n_occurrences").over(w))
            .drop("n_timelines"))


def quantized_groups(stats: DataFrame, token: str = "token") -> DataFrame:
    """Rows whose token ends in a one-digit bin, with ``grp`` and ``qbin``."""
    return (stats.filter(F.col(token).rlike(BIN_TOKEN))
            .withColumn("grp", F.regexp_extract(token, BIN_GROUP, 1))
            .withColumn("qbin", F.substring_index(F.col(token), "_", -1)))


def site_pairs(sites: DataFrame, site: str = "site") -> DataFrame:
    """All unordered pairs of distinct sites."""
    every = sites.agg(F.array_sort(F.collect_set(site)).alias("s"))   # distinct sites: a dimension
    pairs = F.flatten(F.transform("s", lambda a: F.transform(
        F.filter("s", lambda b: a < b), lambda b: F.struct(a.alias("site_a"), b.alias("site_b")))))
    return every.select(F.inline(pairs))


def site_divergence(stats: DataFrame, value: str = "frequency") -> DataFrame:
    """Mean pairwise Wasserstein-1 between sites, per measurement group.

    Bins are those seen at any site for the group (S22); a group missing at a
    site is skipped (S23); each site's shares are renormalized inside the
    group, cumulated over bins in token order, and W1(a, b) = Σ|cumA − cumB|.

    No site pairs are formed: for n sorted values x₁ ≤ … ≤ xₙ the sum of all
    pairwise gaps is Σⱼ xⱼ(2j − n − 1), a window over each (group, bin). The
    mean over pairs is that sum over bins divided by n(n − 1)/2."""
    # one row per (site, token): written once, the steps below reread it
    stats = stage_table(stats.select("site", "token", value), "token-stats")
    q = quantized_groups(stats)
    n_sites = stats.select("site").distinct().count()
    per_grp = Window.partitionBy("grp")
    q = (q.withColumn("k", F.size(F.collect_set("site").over(per_grp)))
         .filter(F.col("k") == n_sites).drop("k"))
    bins = q.select("grp", "token").distinct()
    sites = q.select("grp", "site").distinct()
    grid = (bins.join(sites, "grp")
            .join(q.select("grp", "site", "token", F.col(value).alias("v")),
                  ["grp", "site", "token"], "left")
            .withColumn("v", F.coalesce("v", F.lit(0.0))))
    tot = Window.partitionBy("grp", "site")
    cum = Window.partitionBy("grp", "site").orderBy("token").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    grid = (grid.withColumn("tot", F.sum("v").over(tot))
            .withColumn("cum", F.sum(F.col("v") / F.col("tot")).over(cum)))
    # a site whose group total is 0 has no distribution: drop the group
    ok = grid.groupBy("grp").agg(F.min("tot").alias("m")).filter("m > 0").select("grp")
    grid = grid.join(ok, "grp", "left_semi")
    j = Window.partitionBy("grp", "token").orderBy("cum", "site")
    gaps = grid.withColumn("j", F.row_number().over(j)).groupBy("grp").agg(
        F.sum(F.col("cum") * (2 * F.col("j") - n_sites - 1)).alias("gap_sum"))
    pairs = n_sites * (n_sites - 1) / 2.0
    return gaps.select("grp", (F.col("gap_sum") / F.lit(pairs)).alias("w1"))


def mean_pairwise(pairs: DataFrame, by, value: str = "w1") -> DataFrame:
    return pairs.groupBy(*by).agg(F.avg(value).alias(value))


def outcome_rates(flags: DataFrame, by=("site", "outcome")) -> DataFrame:
    """Share of subjects with the outcome ever (past OR future, Kleene, S6)
    and in the future; boolean means skip nulls (S7)."""
    ever = F.col("past") | F.col("future")
    return flags.groupBy(*by).agg(
        F.avg(ever.cast("int")).alias("rate_ever"),
        F.avg(F.col("future").cast("int")).alias("rate_future"))


def _rate(cond: Column) -> Column:
    return F.avg(cond.cast("int"))


def demographics_table(df: DataFrame, by=("site",), age: str = "age",
                       categories: dict | None = None) -> DataFrame:
    """count, mean and sd of age, and shares per category value with an
    "other" share (rows whose value is not listed; null values skipped, S7).

    ``categories``: {column: (list of lower-case values, name prefix, other?)}."""
    aggs = [F.count(F.lit(1)).alias("count"), F.avg(age).alias("age_avg"),
            F.stddev_samp(age).alias("age_std")]
    for column, (values, prefix, other) in (categories or {}).items():
        low = F.lower(F.col(column))
        for v in values:
            aggs.append(_rate(low == v).alias(f"freq_{prefix}{v.split()[0]}"))
        if other:
            aggs.append(_rate(~low.isin(values)).alias(f"freq_{prefix}other"))
    return df.groupBy(*by).agg(*aggs)


def _span_micros(times: str = "times") -> Column:
    return micros_diff(F.try_element_at(times, F.lit(-1)), F.try_element_at(times, F.lit(1)))


def micros_diff(end: Column, start: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def timeline_stats(timelines: DataFrame, by=("site",)) -> DataFrame:
    """count, mean and median length, mean and median stay (last − first time,
    in seconds; empty timelines give null, S11). The medians are exact ranks,
    found by narrowing over (group, statistic)."""
    by = list(by)
    rows = stage_table(timelines.select(*by, F.array_size("tokens").cast("double").alias("tkns"), (_span_micros() / F.lit(1e6)).alias("los_s")), "timeline-sizes")
    means = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("count"), F.avg("tkns").alias("avg_tkns"), F.avg("los_s").alias("avg_los_s"))
    medians = exact_quantiles(rows.unpivot(by, ["tkns", "los_s"], "_stat", "_x"), [*by, "_stat"], "_x", [0.5])
    pick = lambda stat: F.max(F.when(F.col("_stat") == stat, F.col("breaks")[0])).alias(f"med_{stat}")
    return null_safe_join(means, medians.groupBy(*by).agg(pick("tkns"), pick("los_s")), by, "left").select(
        *by, "count", "avg_tkns", "med_tkns", "avg_los_s", "med_los_s")


def training_volume(timelines: DataFrame, by=("site",)) -> DataFrame:
    """Total tokens, rows, and mean span in whole days (truncated before the
    mean, S15)."""
    span = micros_diff(F.array_max("times"), F.array_min("times"))
    return timelines.groupBy(*by).agg(
        F.sum(F.array_size("tokens")).alias("n_tokens"), F.count(F.lit(1)).alias("n_rows"),
        F.avg(trunc_div(span, 86400000000)).alias("avg_days"))


def prompt_stats(rows: DataFrame, by=("site",), col: str = "tokens_past") -> DataFrame:
    return rows.groupBy(*by).agg(F.avg(F.array_size(col)).alias("avg_prompt_len"),
                                 F.count(F.lit(1)).alias("n_rows"))


def type_counts(vocab: DataFrame, token: str = "token") -> DataFrame:
    """Vocabulary size by token prefix (text before the first ``//``)."""
    return vocab.groupBy(F.substring_index(token, "//", 1).alias("type")).agg(
        F.count(F.lit(1)).alias("n"))


def matrix_marginals(m: DataFrame, row: str, col: str, value: str, by=()) -> DataFrame:
    """Row means, column means and the grand mean of a long matrix, via
    ``cube``; ``row``/``col`` are null on the margins. ``by``: one matrix per
    value of these columns."""
    by = list(by)
    sets = [[*by, row, col], [*by, row], [*by, col], by]
    return m.groupingSets(sets, *by, row, col).agg(F.avg(value).alias(value), F.grouping_id().alias("level"))
