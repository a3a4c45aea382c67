"""The domain roles played by the driver's tables (Spark side).

    site            region name, through customer → nation → region
    group / subject user (customer) / (user, calendar week of the event)
    events          ``events``: code = event_type, value, time = ts
    reference frame subjects with first and last event time, customer columns
    labels          first purchase, first error, first value ≥ 300
    stays (cohort)  orders: patient = o_custkey, stay = o_orderkey,
                    start = o_orderdate, end = last l_shipdate of the order;
                    unit entry = line items with l_returnflag = 'R'
    scores          labels ⋈ documents, site = lang

Every frame here is lazy and reads the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.operators.collate import Entry, Reference, collate, subject_split
from timeloom.session import stage_table
from timeloom.operators.tokenize import (add_bounds, quantile_apply, quantile_fit,
                                         timeline_build, token_build, vocab_apply,
                                         vocab_fit)

# Parameters of the driver-data plan.
FIT_SITE = "AFRICA"           # quantile breaks and vocabulary are learned here
SPLIT_SEED = 7
N_BINS = 10
WEEK_KEY = 100000             # subject_id = user_id * WEEK_KEY + epoch day of the week start
HIGH_VALUE = 300.0
ORDERING = ["BOS", "TIME", "CLCK", "SEG", "BAL", "VAL", "LABEL", "EOS"]
OUTCOMES = ["LABEL//*"]
WINNOW_SECONDS = 86400

REFERENCE = Reference(table="subjects", subject_id="subject_id", group_id="group_id",
                      start_time="start_time", end_time="end_time",
                      augment=[("customer", "group_id")])

ENTRIES = [
    Entry("REFERENCE", "SEG", code="c_mktsegment", time="start_time"),
    Entry("REFERENCE", "BAL", code="code", time="start_time", numeric_value="c_acctbal",
          with_col_expr={"code": "'acctbal'"}),
    Entry("events", "VAL", code="event_type", time="ts", numeric_value="value",
          event_id="event_id"),
    Entry("events", "LABEL", code="code", time="ts", filter_expr="event_type = 'purchase'",
          with_col_expr={"code": "'purchase_init'"}, agg_expr="first"),
    Entry("events", "LABEL", code="code", time="ts", filter_expr="event_type = 'error'",
          with_col_expr={"code": "'error_init'"}, agg_expr="first"),
    Entry("events", "LABEL", code="code", time="ts", filter_expr=[f"value >= {HIGH_VALUE}"],
          with_col_expr={"code": "'highval_init'"}, agg_expr="first"),
]


class Driver:
    """Lazy frames over one scale-factor directory. Fitted artifacts (breaks,
    vocabulary) are materialized once per instance and shared by queries."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._fitted: dict = {}

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------ sites
    def site_map(self) -> DataFrame:
        c, n, r = self.t("customer"), self.t("nation"), self.t("region")
        return (c.join(n, c.c_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select(F.col("c_custkey").alias("group_id"), F.col("r_name").alias("site")))

    def ev(self) -> DataFrame:
        e = self.t("events")
        week = F.unix_date(F.to_date(F.date_trunc("week", "ts"))).cast("long")
        return (e.join(self.site_map(), e.user_id == F.col("group_id"))
                .select("site", "group_id",
                        (F.col("user_id") * WEEK_KEY + week).alias("subject_id"),
                        "event_id", "ts", "event_type", "value"))

    def subjects(self) -> DataFrame:
        return self.ev().groupBy("site", "group_id", "subject_id").agg(
            F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))

    def ref(self) -> DataFrame:
        """Subjects ⟕ customer (m:1), with the split of the subject's group."""
        cust = self.t("customer").withColumnRenamed("c_custkey", "group_id") \
            .select("group_id", "c_mktsegment", "c_acctbal")
        return subject_split(self.subjects().join(cust, "group_id", "left"), "group_id", SPLIT_SEED)

    # ------------------------------------------------------------ events
    def events_long(self, materialize: bool = True) -> DataFrame:
        """The collated events (the source writes this stage to parquet);
        written once and read by the fits and the token stage."""
        if materialize and "events_long" in self._fitted:
            return self._fitted["events_long"]
        tables = {"events": self.ev()}
        evl = subject_split(collate(tables, self.ref(), REFERENCE, ENTRIES), "group_id", SPLIT_SEED)
        if materialize:
            evl = stage_table(evl, "events-long", ["site", "split"])
            self._fitted["events_long"] = evl
        return evl

    def fit_rows(self, df: DataFrame) -> DataFrame:
        return df.filter((F.col("site") == FIT_SITE) & (F.col("split") == "train"))

    def breaks(self, materialize: bool = True):
        if "breaks" not in self._fitted:
            b = quantile_fit(self.fit_rows(self.events_long()), n_bins=N_BINS,
                             materialize=materialize)
            if not materialize:
                return b
            self._fitted["breaks"] = b
        return self._fitted["breaks"]

    def tokens(self, materialize: bool = True) -> DataFrame:
        """Long token rows with BOS/EOS: site, group_id, subject_id, time,
        prefix, code, numeric_value, event_id, split, bin, token, sub."""
        if materialize and "tokens" in self._fitted:
            return self._fitted["tokens"]
        binned = quantile_apply(self.events_long(materialize), self.breaks(materialize))
        tok = add_bounds(token_build(binned), self.ref())
        if materialize:   # read by the vocabulary fit and the id stage: written once
            tok = stage_table(tok, "tokens", ["site", "split"])
            self._fitted["tokens"] = tok
        return tok

    def vocab(self, materialize: bool = True):
        if "vocab" not in self._fitted:
            v = vocab_fit(self.fit_rows(self.tokens(materialize)), materialize=materialize)
            if not materialize:
                return v
            self._fitted["vocab"] = v
        return self._fitted["vocab"]

    def token_ids(self, materialize: bool = True) -> DataFrame:
        """Tokens with ids; a token unseen at the fit site reads as UNK.

        Like the source's staged pipeline (collate → tokenize → winnow, each
        stage written to parquet), the token stage is written once (reliable
        Parquet table in the shared folder) and later stages read it."""
        if "token_ids" in self._fitted:
            return self._fitted["token_ids"]
        ids = vocab_apply(self.tokens(), self.vocab())
        ids = ids.withColumn("token", F.when(F.col("token_id") == 0, F.lit("UNK")).otherwise(F.col("token")))
        if materialize:
            ids = stage_table(ids, "token-ids", ["site", "split"])
            self._fitted["token_ids"] = ids
        return ids

    def timelines(self) -> DataFrame:
        return timeline_build(self.token_ids(), ORDERING, keys=("site", "subject_id", "split"),
                              value="token_id")

    def n_timelines(self) -> DataFrame:
        return self.subjects().groupBy("site").agg(F.count(F.lit(1)).alias("n_timelines"))

    # ------------------------------------------------------------ stays
    def stays(self) -> DataFrame:
        o, li = self.t("orders"), self.t("lineitem")
        end = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("end_time"))
        return (o.join(end, o.o_orderkey == end.l_orderkey, "left")
                .select(F.col("o_custkey").alias("patient_id"),
                        F.col("o_orderkey").alias("stay_id"),
                        F.col("o_orderdate").alias("start_time"), "end_time"))

    def units(self) -> DataFrame:
        li = self.t("lineitem")
        return li.select(F.col("l_orderkey").alias("stay_id"),
                         F.when(F.col("l_returnflag") == "R", F.lit("icu"))
                         .otherwise(F.lower("l_linestatus")).alias("location"),
                         F.col("l_shipdate").alias("in_time"))

    # ------------------------------------------------------------ scores
    def scores(self, materialize: bool = True) -> DataFrame:
        """Long score table: site, model, subject_id, outcome, past, future,
        score. Three models (chars, words, source) × two outcomes (quality, toxic).
        Written once (the source reads scores from parquet files)."""
        if "scores" in self._fitted:
            return self._fitted["scores"]
        out = self._scores()
        if materialize:
            out = stage_table(out, "scores", ["site"])
            self._fitted["scores"] = out
        return out

    def _scores(self) -> DataFrame:
        d, lab = self.t("documents"), self.t("labels")
        j = d.join(lab, "doc_id").select(
            F.col("lang").alias("site"), F.col("doc_id").alias("subject_id"),
            "quality", "toxic", "n_chars", "text", "source")
        chars = F.least(F.col("n_chars").cast("double") / F.lit(20000.0), F.lit(1.0))
        words = (F.size(F.split(F.col("text"), " ")).cast("double")
                 / (F.col("n_chars").cast("double") + F.lit(1.0)))
        source = F.substring("source", 4, 8).cast("double") / F.lit(50.0)
        models = F.array(F.struct(F.lit("chars").alias("model"), chars.alias("score")),
                         F.struct(F.lit("words").alias("model"), words.alias("score")),
                         F.struct(F.lit("source").alias("model"), source.alias("score")))
        outs = F.array(
            F.struct(F.lit("quality").alias("outcome"), F.lit(False).alias("past"),
                     (F.col("quality") == 1).alias("future")),
            F.struct(F.lit("toxic").alias("outcome"),
                     ((F.col("toxic") == 1) & (F.col("n_chars") < 1000)).alias("past"),
                     (F.col("toxic") == 1).alias("future")))
        per_model = j.select("site", "subject_id", "quality", "toxic", "n_chars",
                             F.explode(models).alias("m"))
        return (per_model.select("site", "subject_id", "m.model", "m.score", F.explode(outs).alias("o"))
                .select("site", "model", "subject_id", "o.outcome", "o.past", "o.future", "score"))


_CACHE: dict = {}


def driver(spark: SparkSession, sf_dir: str) -> Driver:
    # a stopped session's object id can be reused; the application id cannot
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = Driver(spark, sf_dir)
    return _CACHE[key]

