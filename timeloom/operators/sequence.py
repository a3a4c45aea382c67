"""Cross-site sequence loss with a bigram model (re-aimed from a neural
next-token scorer): each site's model is its bigram counts with additive
smoothing; the loss of model m on site e is the mean negative log
probability of e's bigrams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.session import stage_table

__all__ = ["words", "bigram_counts", "cross_site_loss"]


def words(docs: DataFrame, site: str, text: str) -> DataFrame:
    """(site, ws): lower-cased text split on a plain space, whole text.

    Text splitting is the heavy per-row step: an input planned with fewer
    splits than cores (one small file) is spread first; a large input keeps
    its scan splits (no shuffle)."""
    d = docs.select(site, text)
    par = d.sparkSession.sparkContext.defaultParallelism
    if d.rdd.getNumPartitions() < par:
        d = d.repartition(par)
    return d.select(F.col(site).alias("site"), F.split(F.lower(text), " ", -1).alias("ws"))


def bigram_counts(w: DataFrame, sites: list) -> DataFrame:
    """(prev, nxt, c0, c1, …): how often each site has the bigram, in one row
    for all sites. Texts with fewer than two words add nothing."""
    n = F.size("ws") - 1
    pairs = F.zip_with(F.slice("ws", 1, n), F.slice("ws", 2, n),
                       lambda a, b: F.struct(a.alias("prev"), b.alias("nxt")))
    return (w.select("site", F.explode(pairs).alias("b")).select("site", "b.prev", "b.nxt")
            .groupBy("prev", "nxt").agg(*[F.count_if(F.col("site") == F.lit(s)).alias(f"c{i}") for i, s in enumerate(sites)]))


def cross_site_loss(docs: DataFrame, site: str = "site", text: str = "text", alpha: float = 1.0) -> DataFrame:
    """(model_site, eval_site, loss, n_bigrams).

    p_m(n | p) = (c_m(p, n) + α) / (c_m(p) + α·V_m), V_m the number of distinct
    words in site m's texts of two or more words. Splitting the log keeps
    every sum inside one row: Σ c_e·ln(c_m + α) = Σ c_e·ln α + Σ_{bigram seen
    at m} c_e·(ln(c_m + α) − ln α), so a bigram's row gives its terms for all
    pairs of sites (a short list), as sums of the row's numbers; the normalizer
    does the same per previous word. The bigrams are shuffled once."""
    spark = docs.sparkSession
    sites = sorted(r[0] for r in docs.select(site).where(F.col(site).isNotNull()).distinct().collect())
    kind = docs.schema[site].dataType.simpleString()
    if not sites:
        return spark.createDataFrame([], f"model_site {kind}, eval_site {kind}, loss double, n_bigrams long")
    k = range(len(sites))
    # the bigram counts are the fitted models, read by three branches below:
    # written once (Parquet in the shared folder); texts without a site are left out
    cnt = stage_table(bigram_counts(words(docs, site, text).where("site is not null"), sites), "bigrams")
    # V_m: distinct words of the site's texts with two or more words (shorter
    # texts are skipped), read off the aggregated bigrams: no second text pass
    word = cnt.select(F.explode(F.array("prev", "nxt")).alias("word"), *[(F.col(f"c{i}") > 0).alias(f"c{i}") for i in k])
    vocab = word.groupBy("word").agg(*[F.max(f"c{i}").alias(f"c{i}") for i in k]).agg(*[F.count_if(f"c{i}").alias(f"v{i}") for i in k]).first()
    la = F.log(F.lit(alpha))
    seen = cnt.agg(*[F.coalesce(F.sum(F.col(f"c{e}") * (F.log(F.col(f"c{m}") + F.lit(alpha)) - la)), F.lit(0.0)).alias(f"s{e}_{m}") for e in k for m in k])
    per = cnt.groupBy("prev").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in k])
    # a site without bigrams has no model
    log_of = {m: F.log(F.col(f"c{m}") + F.lit(alpha * max(vocab[f"v{m}"], 1))) for m in k}
    norm = per.agg(*[F.sum(f"c{e}").alias(f"n{e}") for e in k], *[F.sum(F.col(f"c{e}") * log_of[m]).alias(f"t{e}_{m}") for e in k for m in k])
    with_model = [i for i in k if vocab[f"v{i}"]]
    rows = [F.struct(F.lit(sites[m]).cast(kind).alias("model_site"), F.lit(sites[e]).cast(kind).alias("eval_site"),
                     (-(F.col(f"n{e}") * la + F.col(f"s{e}_{m}") - F.col(f"t{e}_{m}")) / F.col(f"n{e}")).alias("loss"), F.col(f"n{e}").alias("n_bigrams"))
            for e in with_model for m in with_model]
    if not rows:
        return spark.createDataFrame([], f"model_site {kind}, eval_site {kind}, loss double, n_bigrams long")
    # one row each
    return seen.crossJoin(norm).select(F.inline(F.array(*rows)))
