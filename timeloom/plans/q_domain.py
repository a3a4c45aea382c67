"""Domain queries: collation, tokens, timelines, winnowing, description."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeloom.operators import describe as dsc
from timeloom.operators import order_stats as ost
from timeloom.operators.relational import top_bottom_k
from timeloom.operators.scans import null_safe_join
from timeloom.plans.catalog import D, query, r9
from timeloom.plans.oracle import sql
from timeloom.session import stage_table


def _stats(spark, sf):
    d = D(spark, sf)
    return dsc.token_stats(d.token_ids(), d.n_timelines())


@query("token_stats", sql("""SELECT site, token, n_occurrences, n_timelines_with_token,
    round(prevalence, 9) AS prevalence, round(frequency, 9) AS frequency FROM tstats"""))
def token_stats(spark, sf):
    s = _stats(spark, sf)
    return s.select("site", "token", "n_occurrences", "n_timelines_with_token",
                    r9("prevalence").alias("prevalence"), r9("frequency").alias("frequency"))


@query("site_divergence", sql("SELECT grp, round(w1, 9) AS w1 FROM divergence"))
def site_divergence(spark, sf):
    return dsc.site_divergence(_stats(spark, sf)).select("grp", r9("w1").alias("w1"))


@query("top_bottom_k", sql("""SELECT * FROM (
    SELECT grp, round(w1, 9) AS w1, 'top' AS list, row_number() OVER (ORDER BY w1 DESC, grp ASC) AS rank FROM divergence
    UNION ALL
    SELECT grp, round(w1, 9) AS w1, 'bottom' AS list, row_number() OVER (ORDER BY w1 ASC, grp DESC) AS rank FROM divergence)
    WHERE rank <= 2"""))
def top_bottom(spark, sf):
    div = dsc.site_divergence(_stats(spark, sf))
    out = top_bottom_k(div, "w1", "grp", k=2)
    return out.select("grp", r9("w1").alias("w1"), "list", F.col("rank").cast("long").alias("rank"))


# ====================================================================== cohort
from timeloom.functions import scalar as S  # noqa: E402
from timeloom.operators import cohort as coh  # noqa: E402
from timeloom.operators import winnow as wnw  # noqa: E402
from timeloom.operators import tokenize as tkz  # noqa: E402
from timeloom.operators.collate import Entry, collate  # noqa: E402
from timeloom.operators.relational import (checked_join, custom_order, first_per_group,  # noqa: E402
                                           pivot_checked, seeded_sample, transpose_table,
                                           union_all, melt)
from timeloom.plans import driver as drv  # noqa: E402
from timeloom.plans.oracle import CTES, ORD, RANK, hash_unit_sql  # noqa: E402


def _cohort(spark, sf):
    d = D(spark, sf)
    return coh.cohort_select(d.stays(), d.units())


@query("cohort_select", sql("SELECT patient_id, stay_id, first_unit_in FROM cohort"))
def cohort_select(spark, sf):
    return _cohort(spark, sf)


@query("cohort_apply", sql("""SELECT 'lineitem' AS tbl, count(*) AS n_rows FROM lineitem WHERE l_orderkey IN (SELECT stay_id FROM cohort)
    UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey IN (SELECT stay_id FROM cohort)
    UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_custkey IN (SELECT patient_id FROM cohort)
    UNION ALL SELECT 'region', count(*) FROM region"""))
def cohort_apply(spark, sf):
    d = D(spark, sf)
    tables = {"lineitem": d.t("lineitem").withColumnRenamed("l_orderkey", "stay_id"),
              "orders": d.t("orders").withColumnRenamed("o_orderkey", "stay_id"),
              "customer": d.t("customer").withColumnRenamed("c_custkey", "patient_id"),
              "region": d.t("region")}
    out = coh.cohort_apply(tables, _cohort(spark, sf), "stay_id", "patient_id")
    return union_all([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("tbl"), "n_rows")
                      for k, df in out.items()])


@query("first_per_group", sql("SELECT patient_id, stay_id, start_time FROM fs"))
def first_per_group_q(spark, sf):
    return coh.first_stays(D(spark, sf).stays()).select("patient_id", "stay_id", "start_time")


@query("min_per_group", sql("SELECT stay_id, first_unit_in FROM fu"))
def min_per_group(spark, sf):
    return coh.first_unit_entry(D(spark, sf).units())


@query("cohort_join", sql("SELECT f.stay_id, f.patient_id, u.first_unit_in FROM fs f JOIN fu u ON f.stay_id = u.stay_id"))
def cohort_join(spark, sf):
    d = D(spark, sf)
    first = coh.first_stays(d.stays()).select("stay_id", "patient_id")
    return checked_join(first, coh.first_unit_entry(d.units()), "stay_id", "inner", "1:1", in_plan=True)


@query("subset_semi", sql("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT stay_id FROM cohort)"""))
def subset_semi(spark, sf):
    keys = _cohort(spark, sf).select(F.col("stay_id").alias("l_orderkey"))
    return D(spark, sf).t("lineitem").join(keys, "l_orderkey", "left_semi") \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@query("augment_join", sql("SELECT site, subject_id, c_mktsegment, c_acctbal FROM ref"))
def augment_join(spark, sf):
    return D(spark, sf).ref().select("site", "subject_id", "c_mktsegment", "c_acctbal")


@query("reference_key_join", sql("""SELECT s.subject_id, s.group_id, c.c_acctbal FROM subjects s
    JOIN customer c ON c.c_custkey = s.group_id"""))
def reference_key_join(spark, sf):
    d = D(spark, sf)
    cust = d.t("customer").select(F.col("c_custkey").alias("group_id"), "c_acctbal")
    return cust.join(d.subjects().select("subject_id", "group_id"), "group_id") \
        .select("subject_id", "group_id", "c_acctbal")


# ====================================================================== collation
_EVC = "site, subject_id, time, prefix, code, round(numeric_value, 6) AS numeric_value, text_value"


def _ev_out(df):
    return df.select("site", "subject_id", "time", "prefix", "code",
                     F.round("numeric_value", 6).alias("numeric_value"), "text_value")


def _collate(spark, sf, entries, tables=None):
    d = D(spark, sf)
    tables = tables or {"events": d.ev()}
    return _ev_out(collate(tables, d.ref(), drv.REFERENCE, entries))


@query("collate", sql(f"SELECT {_EVC} FROM evl"))
def collate_q(spark, sf):
    """Collation computed in full (not the stored stage)."""
    return _ev_out(D(spark, sf).events_long(materialize=False))


@query("collate_entry", sql(f"SELECT {_EVC} FROM evl WHERE prefix = 'VAL'"))
def collate_entry(spark, sf):
    return _collate(spark, sf, [drv.ENTRIES[2]])


@query("ev_static", sql(f"SELECT {_EVC} FROM evl WHERE prefix IN ('SEG', 'BAL')"))
def ev_static(spark, sf):
    return _collate(spark, sf, drv.ENTRIES[:2])


@query("label_first", sql(f"SELECT {_EVC} FROM evl WHERE prefix = 'LABEL'"))
def label_first(spark, sf):
    return _collate(spark, sf, drv.ENTRIES[3:])


@query("ev_vitals", sql("SELECT site, subject_id, ts AS time, 'VTL' AS prefix, event_type AS code, round(value, 6) AS numeric_value, CAST(NULL AS VARCHAR) AS text_value FROM ev"))
def ev_vitals(spark, sf):
    return _collate(spark, sf, [Entry("events", "VTL", code="event_type", time="ts", numeric_value="value")])


@query("ev_position", sql("SELECT site, subject_id, ts AS time, 'POSN' AS prefix, event_type AS code, CAST(NULL AS DOUBLE) AS numeric_value, CAST(NULL AS VARCHAR) AS text_value FROM ev WHERE event_type = 'signup'"))
def ev_position(spark, sf):
    return _collate(spark, sf, [Entry("events", "POSN", code="event_type", time="ts",
                                      filter_expr="event_type = 'signup'")])


@query("ev_crrt", sql("""SELECT site, subject_id, ts AS time, 'CRRT' AS prefix, event_type AS code, round(value, 6) AS numeric_value,
    CAST(NULL AS VARCHAR) AS text_value FROM ev WHERE event_type IS NOT NULL AND value >= 100"""))
def ev_crrt(spark, sf):
    return _collate(spark, sf, [Entry("events", "CRRT", code="event_type", time="ts", numeric_value="value",
                                      filter_expr=["event_type IS NOT NULL", "value >= 100"])])


@query("ev_labs", sql("""SELECT site, subject_id, ts AS time, 'LAB-ORD' AS prefix, event_type AS code, CAST(NULL AS DOUBLE) AS numeric_value,
        CAST(NULL AS VARCHAR) AS text_value FROM ev WHERE event_type = 'purchase'
    UNION ALL SELECT site, subject_id, ts + INTERVAL 1 HOUR, 'LAB-RES', event_type, round(value, 6), NULL FROM ev WHERE event_type = 'purchase'"""))
def ev_labs(spark, sf):
    return _collate(spark, sf, [
        Entry("events", "LAB-ORD", code="event_type", time="ts", filter_expr="event_type = 'purchase'"),
        Entry("events", "LAB-RES", code="event_type", time="t_res", numeric_value="value",
              filter_expr="event_type = 'purchase'", with_col_expr={"t_res": "ts + INTERVAL 1 HOUR"})])


@query("ev_assessments", sql("""SELECT site, subject_id, ts AS time, 'ASMT' AS prefix, event_type AS code, round(value, 6) AS numeric_value,
        CAST(NULL AS VARCHAR) AS text_value FROM ev WHERE event_type = 'view'
    UNION ALL SELECT site, subject_id, ts, 'ASMT', event_type, NULL,
        CASE WHEN event_type = 'error' THEN CASE WHEN value >= 100 THEN 'Yes' ELSE 'No' END ELSE NULL END FROM ev WHERE event_type = 'error'"""))
def ev_assessments(spark, sf):
    return _collate(spark, sf, [
        Entry("events", "ASMT", code="event_type", time="ts", numeric_value="value", filter_expr="event_type = 'view'"),
        Entry("events", "ASMT", code="event_type", time="ts", text_value="answer", filter_expr="event_type = 'error'",
              with_col_expr={"answer": "CASE WHEN event_type = 'error' THEN CASE WHEN value >= 100 THEN 'Yes' ELSE 'No' END END"})])


_SETTINGS = [("value", "value"), ("half", "value / 2"),
             ("ratio", "CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE) ELSE value / 10 END")]


@query("ev_respiratory", sql("""SELECT site, subject_id, ts AS time, 'RESP' AS prefix, event_type AS code, CAST(NULL AS DOUBLE) AS numeric_value,
        CAST(NULL AS VARCHAR) AS text_value FROM ev WHERE event_type IN ('click', 'error')
    UNION ALL SELECT site, subject_id, ts, 'RESP', s.code, round(s.v, 6), NULL FROM ev,
        LATERAL (VALUES ('value', value), ('half', value / 2),
                 ('ratio', CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE ELSE value / 10 END)) s(code, v)
        WHERE event_type IN ('click', 'error') AND NOT isnan(s.v) AND abs(s.v) < 'inf'::DOUBLE"""))
def ev_respiratory(spark, sf):
    """Mode entry plus three settings unpivoted with ``stack`` and kept only
    when finite (S5)."""
    d = D(spark, sf)
    ev = d.ev().filter(F.col("event_type").isin("click", "error"))
    stack = "stack(3, " + ", ".join(f"'{n}', cast({e} as double)" for n, e in _SETTINGS) + ") AS (setting, v)"
    long = ev.select("*", F.expr(stack))
    entries = [Entry("events", "RESP", code="event_type", time="ts")]
    mode = collate({"events": ev}, d.ref(), drv.REFERENCE, entries)
    sets = collate({"events": long.filter(S.finite("v"))}, d.ref(), drv.REFERENCE,
                   [Entry("events", "RESP", code="setting", time="ts", numeric_value="v")])
    return _ev_out(mode.unionByName(sets))


@query("ev_code_status", sql("""SELECT s.site, s.subject_id, s.start_time AS time, 'CODE' AS prefix, c.c_mktsegment AS code,
    CAST(NULL AS DOUBLE) AS numeric_value, CAST(NULL AS VARCHAR) AS text_value FROM customer c JOIN subjects s ON c.c_custkey = s.group_id"""))
def ev_code_status(spark, sf):
    """Patient-level rows fan out to each of the patient's subjects through
    the reference key; the time is the subject's start."""
    d = D(spark, sf)
    e = Entry("customer", "CODE", code="c_mktsegment", time="start_time", reference_key="c_custkey")
    return _collate(spark, sf, [e], {"customer": d.t("customer")})


@query("ev_transfer", sql("""SELECT site, subject_id, ts AS time, 'XFR-IN' AS prefix, event_type AS code, CAST(NULL AS DOUBLE) AS numeric_value,
        CAST(NULL AS VARCHAR) AS text_value FROM ev WHERE event_type = 'view'
    UNION ALL SELECT site, subject_id, ts + INTERVAL 30 MINUTE, 'XFR-OUT', event_type, NULL, NULL FROM ev WHERE event_type = 'view'"""))
def ev_transfer(spark, sf):
    return _collate(spark, sf, [
        Entry("events", "XFR-IN", code="event_type", time="ts", filter_expr="event_type = 'view'"),
        Entry("events", "XFR-OUT", code="event_type", time="t_out", filter_expr="event_type = 'view'",
              with_col_expr={"t_out": "ts + INTERVAL 30 MINUTES"})])


# ====================================================================== splits
@query("subject_split", sql("SELECT DISTINCT group_id, split FROM ref"))
def subject_split_q(spark, sf):
    return D(spark, sf).ref().select("group_id", "split").distinct()


@query("pass_through", sql("""SELECT f.site, f.subject_id, r.split, r.c_mktsegment, r.c_acctbal
    FROM (SELECT DISTINCT site, subject_id FROM flags) f JOIN ref r ON f.site = r.site AND f.subject_id = r.subject_id"""))
def pass_through(spark, sf):
    from timeloom.operators.collate import pass_through as pt
    d = D(spark, sf)
    rows = d.subjects().select("site", "subject_id")
    return pt(rows, d.ref().drop("site"), "subject_id", ["split", "c_mktsegment", "c_acctbal"])


# ====================================================================== tokens
@query("quantile_fit", sql("""SELECT prefix, code, CAST(q AS INTEGER) AS q, round(breaks[q], 6) AS brk
    FROM breaks, range(1, 10) t(q)"""))
def quantile_fit(spark, sf):
    b = D(spark, sf).breaks().df
    return b.select("prefix", "code", F.posexplode("breaks").alias("q", "brk")) \
        .select("prefix", "code", (F.col("q") + 1).alias("q"), F.round("brk", 6).alias("brk"))


@query("quantile_sketch", sql("""SELECT prefix, code, count(*) AS n, true AS within FROM evl
    WHERE numeric_value IS NOT NULL AND NOT isnan(numeric_value) GROUP BY prefix, code"""))
def quantile_sketch(spark, sf):
    """Breaks from a sketch table per (site, prefix, code), merged over sites:
    number of values, and whether every break's exact rank is within 1 % of
    the wanted one."""
    ev = D(spark, sf).events_long()
    table = stage_table(ost.sketch_table(ev, ["site", "prefix", "code"], "numeric_value"), "sketches")
    probs = [i / 10 for i in range(1, 10)]
    sizes = table.groupBy("prefix", "code").agg(F.sum("n").alias("n"))
    fit = null_safe_join(tkz.quantile_fit_sketch(table), sizes, ["prefix", "code"])
    seen = null_safe_join(ev.select("prefix", "code", ost.numbers("numeric_value").alias("v")).where("v is not null"), fit, ["prefix", "code"])
    ranks = [F.struct((F.sum((F.col("v") < F.col("breaks")[i]).cast("long")) / F.count("v")).alias("lt"),
                      (F.sum((F.col("v") <= F.col("breaks")[i]).cast("long")) / F.count("v")).alias("le")) for i in range(len(probs))]
    off = [F.greatest(F.lit(0.0), p - r["le"], r["lt"] - p) for p, r in zip(probs, ranks)]
    return seen.groupBy("prefix", "code", "n").agg((F.greatest(*off) <= 0.01).alias("within"))


@query("quantile_apply", sql("SELECT prefix, code, bin, count(*) AS n FROM binned GROUP BY ALL"))
def quantile_apply(spark, sf):
    d = D(spark, sf)
    b = tkz.quantile_apply(d.events_long(), d.breaks())
    return b.groupBy("prefix", "code", "bin").agg(F.count(F.lit(1)).alias("n"))


@query("token_build", sql("SELECT token, count(*) AS n FROM tok GROUP BY token"))
def token_build(spark, sf):
    return D(spark, sf).tokens().groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("vocab_fit", sql("SELECT token, token_id FROM vocab"))
def vocab_fit(spark, sf):
    return D(spark, sf).vocab().df


@query("vocab_apply", sql("""SELECT site, CAST(sum(CASE WHEN token_id > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_known,
    CAST(sum(CASE WHEN token_id = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_unk FROM ids GROUP BY site"""))
def vocab_apply(spark, sf):
    ids = D(spark, sf).token_ids()
    return ids.groupBy("site").agg(F.sum((F.col("token_id") > 0).cast("long")).alias("n_known"),
                                   F.sum((F.col("token_id") == 0).cast("long")).alias("n_unk"))


@query("event_order", sql(f"""SELECT site, subject_id, token,
    row_number() OVER (PARTITION BY site, subject_id ORDER BY {ORD}) AS pos FROM ids"""))
def event_order(spark, sf):
    ids = tkz.event_order(D(spark, sf).token_ids(), drv.ORDERING)
    return ids.select("site", "subject_id", "token", F.col("pos").cast("long").alias("pos"))


def _text(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


@query("timeline_build", sql("""SELECT site, subject_id, split, array_to_string(tokens, ' ') AS tokens,
    CAST(len(tokens) AS INTEGER) AS n FROM timelines"""))
def timeline_build(spark, sf):
    tl = D(spark, sf).timelines()
    return tl.select("site", "subject_id", "split", _text("tokens").alias("tokens"),
                     F.array_size("tokens").alias("n"))


@query("timeline_decode", sql(f"""SELECT site, subject_id, string_agg(token, ' ' ORDER BY {ORD}) AS tokens
    FROM ids GROUP BY site, subject_id"""))
def timeline_decode(spark, sf):
    d = D(spark, sf)
    dec = tkz.timeline_decode(d.timelines(), d.vocab(), keys=("site", "subject_id"))
    return dec.select("site", "subject_id", F.array_join("tokens", " ").alias("tokens"))


@query("token_lookup_join", sql(f"""SELECT site, subject_id, CAST(row_number() OVER (PARTITION BY site, subject_id ORDER BY {ORD}) - 1 AS INTEGER) AS pos,
    token FROM ids"""))
def token_lookup_join(spark, sf):
    d = D(spark, sf)
    ex = d.timelines().select("site", "subject_id", F.posexplode("tokens").alias("pos", "token_id"))
    found = d.vocab().join_to(ex, "token_id", "left")
    unknown = F.raise_error(F.concat(F.lit("unknown token id "), F.col("token_id").cast("string")))
    return found.select("site", "subject_id", "pos", F.when(F.col("token").isNull(), unknown.cast("string")).otherwise(F.col("token")).alias("token"))


@query("f_list_map", sql(f"""SELECT site, subject_id, string_agg(token, ' ' ORDER BY {ORD}) AS tokens
    FROM ids GROUP BY site, subject_id"""))
def f_list_map(spark, sf):
    """Element-wise id → token lookup with the order of the list kept."""
    d = D(spark, sf)
    dec = tkz.timeline_decode(d.timelines(), d.vocab(), keys=("site", "subject_id"))
    return dec.select("site", "subject_id", F.array_join("tokens", " ").alias("tokens"))


@query("gap_spacers", sql(f"""SELECT site, label AS token, count(*) AS n FROM (
    SELECT site, CASE """ + " ".join(
    f"WHEN gap >= {lo} THEN 'TIME//{name}'" for name, lo in reversed(tkz.SPACERS)) + f""" END AS label FROM (
        SELECT site, date_diff('microsecond', lag(time) OVER (PARTITION BY site, subject_id ORDER BY {ORD}), time) / 60000000.0 AS gap
        FROM ids)) WHERE label IS NOT NULL GROUP BY site, label"""))
def gap_spacers(spark, sf):
    ids = D(spark, sf).token_ids()
    sp = tkz.gap_spacers(ids.select("site", "subject_id", "time", "prefix", "token"))
    return sp.filter(F.col("prefix") == "TIME").groupBy("site", "token").agg(F.count(F.lit(1)).alias("n"))


@query("clock_tokens", sql("""SELECT site, 'CLCK//' || strftime(t, '%H') AS token, count(*) AS n FROM (
    SELECT site, unnest(generate_series(date_trunc('hour', start_time) + to_hours(CAST(4 - hour(start_time) % 4 AS BIGINT)),
        end_time, INTERVAL 4 HOUR)) AS t FROM subjects) GROUP BY ALL"""))
def clock_tokens(spark, sf):
    ck = tkz.clock_tokens(D(spark, sf).subjects())
    return ck.groupBy("site", "token").agg(F.count(F.lit(1)).alias("n"))


@query("time_positions", sql("""SELECT site, subject_id, array_to_string(list_transform(times,
    lambda t: CAST(floor(date_diff('microsecond', times[1], t) / 300000000.0) AS INTEGER)), ' ') AS positions FROM timelines"""))
def time_positions(spark, sf):
    tp = tkz.time_positions(D(spark, sf).timelines())
    return tp.select("site", "subject_id", _text("positions").alias("positions"))


# ====================================================================== winnow
def _outcomes(d):
    return wnw.outcome_tokens(d.vocab().df, drv.OUTCOMES)


def _winnowed(d):
    return wnw.winnow_duration(d.token_ids(), drv.WINNOW_SECONDS)


def _flags(d):
    return wnw.outcome_flags(_winnowed(d), d.subjects(), _outcomes(d))


@query("winnow_duration", sql("""SELECT site, subject_id, split, array_to_string(tokens_past, ' ') AS tokens_past,
    CAST(len(tokens) - len(tokens_past) AS INTEGER) AS n_future FROM infr"""))
def winnow_duration(spark, sf):
    d = D(spark, sf)
    rows = wnw.inference_rows(_winnowed(d), keys=("site", "subject_id", "split"), ordering=drv.ORDERING)
    return rows.select("site", "subject_id", "split", _text("tokens_past").alias("tokens_past"),
                       (F.array_size("tokens") - F.array_size("tokens_past")).alias("n_future"))


@query("winnow_first_occurrence", sql("""SELECT site, subject_id, CAST(sum(CASE WHEN past THEN 1 ELSE 0 END) AS BIGINT) AS n_past, count(*) AS n FROM (
    SELECT site, subject_id, cut IS NULL OR time <= cut AS past FROM (
        SELECT *, min(CASE WHEN token = 'LABEL//purchase_init' THEN time END) OVER (PARTITION BY site, subject_id) AS cut FROM ids))
    GROUP BY site, subject_id"""))
def winnow_first_occurrence(spark, sf):
    w = wnw.winnow_first_occurrence(D(spark, sf).token_ids(), "LABEL//purchase_init")
    return w.groupBy("site", "subject_id").agg(F.sum(F.col("past").cast("long")).alias("n_past"),
                                               F.count(F.lit(1)).alias("n"))


@query("outcome_flags", sql("SELECT site, subject_id, outcome, past, future FROM flags"))
def outcome_flags(spark, sf):
    return _flags(D(spark, sf))


@query("any_flag", sql("SELECT site, subject_id, outcome, past OR future AS ever FROM flags"))
def any_flag(spark, sf):
    f = _flags(D(spark, sf))
    return f.select("site", "subject_id", "outcome", (F.col("past") | F.col("future")).alias("ever"))


@query("filter_flag", sql("SELECT site, subject_id FROM flags WHERE outcome = 'LABEL//purchase_init' AND past"))
def filter_flag(spark, sf):
    d = D(spark, sf)
    outs = _outcomes(d)
    wide = wnw.flags_wide(_flags(d), outs)
    return wide.filter(F.col("`LABEL//purchase_init_past`")).select("site", "subject_id")


@query("melt_flags", sql("""SELECT site, subject_id, outcome || '_past' AS col, past AS flag FROM flags
    UNION ALL SELECT site, subject_id, outcome || '_future', future FROM flags"""))
def melt_flags(spark, sf):
    d = D(spark, sf)
    outs = _outcomes(d)
    wide = wnw.flags_wide(_flags(d), outs)
    cols = [f"`{o}_{h}`" for o in outs for h in ("past", "future")]
    long = wide.select("site", "subject_id", *[F.col(c).alias(c.strip("`")) for c in cols])
    return melt(long, ["site", "subject_id"], [f"`{c.strip('`')}`" for c in cols], "col", "flag")


@query("winnow_splits", sql("""SELECT split, count(*) AS n_rows, CAST(sum(len(tokens_past)) AS BIGINT) AS n_past_tokens
    FROM infr GROUP BY split"""))
def winnow_splits(spark, sf):
    d = D(spark, sf)
    rows = wnw.inference_rows(_winnowed(d), keys=("site", "subject_id", "split"), ordering=drv.ORDERING)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum(F.array_size("tokens_past")).cast("long").alias("n_past_tokens"))


@query("lookup_subject", sql(f"""SELECT site, subject_id, string_agg('<' || token || '>', ', ' ORDER BY {ORD}) AS text
    FROM ids WHERE subject_id = (SELECT min(subject_id) FROM flags WHERE outcome = 'LABEL//purchase_init' AND past
        AND site = (SELECT min(site) FROM flags)) GROUP BY site, subject_id"""))
def lookup_subject(spark, sf):
    """One timeline as text: the smallest subject of the first site with the
    outcome in its past (the lookup itself is the feature)."""
    d = D(spark, sf)
    f = _flags(d)
    first_site = f.agg(F.min("site")).first()[0]
    sid = (f.filter((F.col("outcome") == "LABEL//purchase_init") & F.col("past") & (F.col("site") == first_site))
           .agg(F.min("subject_id")).first()[0])
    dec = tkz.timeline_decode(d.timelines().filter(F.col("subject_id") == sid), d.vocab(),
                              keys=("site", "subject_id"))
    return dec.select("site", "subject_id", S.tokens_text("tokens").alias("text"))


# ====================================================================== features
@query("features_counts", sql("""SELECT site, subject_id, token_id, count(*) AS n FROM wn WHERE past
    GROUP BY site, subject_id, token_id"""))
def features_counts(spark, sf):
    from timeloom.operators.models import counts_long
    return counts_long(_winnowed(D(spark, sf)).filter("past"))


@query("features_onehot", sql("SELECT DISTINCT site, subject_id, token_id, 1 AS n FROM wn WHERE past"))
def features_onehot(spark, sf):
    from timeloom.operators.models import counts_long
    return counts_long(_winnowed(D(spark, sf)).filter("past"), binary=True)


@query("n_tokens_prefix", sql("SELECT site, subject_id, CAST(len(tokens_past) AS INTEGER) AS n_tokens_prefix FROM infr"))
def n_tokens_prefix(spark, sf):
    rows = wnw.inference_rows(_winnowed(D(spark, sf)), ordering=drv.ORDERING)
    return rows.select("site", "subject_id", F.array_size("tokens_past").alias("n_tokens_prefix"))


# ====================================================================== describe
from timeloom.plans.oracle import CTES as _C  # noqa: E402

_C.update({
    "tl_all": """SELECT t.*, r.c_acctbal FROM timelines t JOIN ref r ON t.site = r.site AND t.subject_id = r.subject_id""",
    "rates": """SELECT site, outcome, avg(CAST(past OR future AS INTEGER)) AS rate_ever,
        avg(CAST(future AS INTEGER)) AS rate_future FROM flags GROUP BY site, outcome""",
})


@query("token_counts", sql("SELECT site, token, n_occurrences, n_timelines_with_token FROM tstats"))
def token_counts(spark, sf):
    return dsc.token_counts(D(spark, sf).token_ids())


@query("token_prevalence", sql("SELECT site, token, round(prevalence, 9) AS prevalence FROM tstats"))
def token_prevalence(spark, sf):
    return _stats(spark, sf).select("site", "token", r9("prevalence").alias("prevalence"))


@query("token_frequency", sql("SELECT site, token, round(frequency, 9) AS frequency FROM tstats"))
def token_frequency(spark, sf):
    return _stats(spark, sf).select("site", "token", r9("frequency").alias("frequency"))


@query("distinct_groups", sql("SELECT DISTINCT grp FROM qtok ORDER BY grp"))
def distinct_groups(spark, sf):
    return dsc.quantized_groups(_stats(spark, sf)).select("grp").distinct().orderBy("grp")


def _qgrid(spark, sf):
    from pyspark.sql import Window
    q = dsc.quantized_groups(_stats(spark, sf))
    n = q.select("site").distinct().count()
    w = Window.partitionBy("grp")
    q = q.withColumn("k", F.size(F.collect_set("site").over(w))).filter(F.col("k") == n)
    bins = q.select("grp", "token").distinct()
    sites = q.select("grp", "site").distinct()
    return (bins.join(sites, "grp").join(q.select("grp", "site", "token", F.col("frequency").alias("v")),
                                         ["grp", "site", "token"], "left"))


@query("share_of_group", sql("SELECT grp, site, token, round(v / tot, 9) AS share FROM qcum"))
def share_of_group(spark, sf):
    from timeloom.operators.relational import share_of_group as sog
    g = sog(_qgrid(spark, sf), ["grp", "site"], "v")
    return g.select("grp", "site", "token", r9("share").alias("share"))


@query("cumulative_share", sql("SELECT grp, site, token, round(cum, 9) AS cum FROM qcum"))
def cumulative_share(spark, sf):
    from timeloom.operators.relational import cumulative_share as cs, share_of_group as sog
    g = sog(_qgrid(spark, sf), ["grp", "site"], "v")
    return cs(g, ["grp", "site"], "token", "share").select("grp", "site", "token", r9("cum").alias("cum"))


@query("site_pairs", sql("""SELECT a.site AS site_a, b.site AS site_b FROM (SELECT DISTINCT site FROM subjects) a
    JOIN (SELECT DISTINCT site FROM subjects) b ON a.site < b.site"""))
def site_pairs(spark, sf):
    return dsc.site_pairs(D(spark, sf).subjects())


@query("mean_pairwise", sql("""SELECT sa AS site_a, sb AS site_b, round(avg(w1), 9) AS w1 FROM (
    SELECT a.grp, a.site AS sa, b.site AS sb, sum(abs(a.cum - b.cum)) AS w1 FROM qcum a JOIN qcum b
    ON a.grp = b.grp AND a.token = b.token AND a.site < b.site GROUP BY a.grp, a.site, b.site) GROUP BY sa, sb"""))
def mean_pairwise(spark, sf):
    """Per pair of sites, the W1 averaged over groups. The pair list is the
    (small, fixed) set of sites, joined per (group, bin)."""
    from timeloom.operators.relational import cumulative_share as cs, share_of_group as sog
    g = cs(sog(_qgrid(spark, sf), ["grp", "site"], "v"), ["grp", "site"], "token", "share")
    a = g.select("grp", "token", F.col("site").alias("site_a"), F.col("cum").alias("ca"))
    b = g.select("grp", "token", F.col("site").alias("site_b"), F.col("cum").alias("cb"))
    w = (a.join(b, ["grp", "token"]).filter("site_a < site_b")
         .groupBy("grp", "site_a", "site_b").agg(F.sum(F.abs(F.col("ca") - F.col("cb"))).alias("w1")))
    return dsc.mean_pairwise(w, ["site_a", "site_b"]).select("site_a", "site_b", r9("w1").alias("w1"))


@query("outcome_rates", sql("SELECT site, outcome, round(rate_ever, 9) AS rate_ever, round(rate_future, 9) AS rate_future FROM rates"))
def outcome_rates(spark, sf):
    r = dsc.outcome_rates(_flags(D(spark, sf)))
    return r.select("site", "outcome", r9("rate_ever").alias("rate_ever"), r9("rate_future").alias("rate_future"))


# Segment shares reported by name, the rest as "other".
SEGMENTS = ["automobile", "building", "furniture"]


def _demog_sql(group: str, site_expr: str) -> str:
    segs = ", ".join(f"round(avg(CAST(lower(c_mktsegment) = '{s}' AS INTEGER)), 9) AS freq_seg_{s}" for s in SEGMENTS)
    inlist = ", ".join(f"'{s}'" for s in SEGMENTS)
    return f"""SELECT {site_expr} AS site, count(*) AS count, round(avg(c_acctbal), 9) AS age_avg,
        round(stddev_samp(c_acctbal), 9) AS age_std, {segs},
        round(avg(CAST(lower(c_mktsegment) NOT IN ({inlist}) AS INTEGER)), 9) AS freq_seg_other FROM ref {group}"""


def _demog_cols(df):
    return df.select(*[r9(c).alias(c) if c not in ("site", "count") else F.col(c) for c in df.columns])


@query("demographics_table", sql(_demog_sql("GROUP BY site", "site")))
def demographics_table(spark, sf):
    d = dsc.demographics_table(D(spark, sf).ref(), age="c_acctbal",
                               categories={"c_mktsegment": (SEGMENTS, "seg_", True)})
    return _demog_cols(d)


@query("pooled_rollup", sql(_demog_sql("GROUP BY ROLLUP (site)", "coalesce(site, 'all')")))
def pooled_rollup(spark, sf):
    """Per-site statistics and the pooled 'all' row from one ``rollup``."""
    ref = D(spark, sf).ref()
    low = F.lower("c_mktsegment")
    aggs = [F.count(F.lit(1)).alias("count"), F.avg("c_acctbal").alias("age_avg"),
            F.stddev_samp("c_acctbal").alias("age_std")]
    aggs += [F.avg((low == s).cast("int")).alias(f"freq_seg_{s}") for s in SEGMENTS]
    aggs += [F.avg((~low.isin(SEGMENTS)).cast("int")).alias("freq_seg_other")]
    r = ref.rollup("site").agg(*aggs)
    r = r.withColumn("site", F.coalesce("site", F.lit("all")))
    return _demog_cols(r)


@query("timeline_stats", sql("""SELECT site, count(*) AS count, round(avg(len(tokens)), 9) AS avg_tkns,
    round(median(len(tokens)), 9) AS med_tkns,
    round(avg(date_diff('microsecond', times[1], times[-1]) / 1e6), 6) AS avg_los_s,
    round(median(date_diff('microsecond', times[1], times[-1]) / 1e6), 6) AS med_los_s FROM timelines GROUP BY site"""))
def timeline_stats(spark, sf):
    t = dsc.timeline_stats(D(spark, sf).timelines())
    return t.select("site", "count", r9("avg_tkns").alias("avg_tkns"), r9(F.col("med_tkns").cast("double")).alias("med_tkns"),
                    F.round("avg_los_s", 6).alias("avg_los_s"), F.round("med_los_s", 6).alias("med_los_s"))


@query("training_volume", sql("""SELECT site, CAST(sum(len(tokens)) AS BIGINT) AS n_tokens, count(*) AS n_rows,
    round(avg(CAST(trunc(date_diff('microsecond', list_min(times), list_max(times)) / 86400000000) AS BIGINT)), 9) AS avg_days
    FROM timelines WHERE split = 'train' GROUP BY site"""))
def training_volume(spark, sf):
    t = dsc.training_volume(D(spark, sf).timelines().filter(F.col("split") == "train"))
    return t.select("site", F.col("n_tokens").cast("long").alias("n_tokens"), "n_rows", r9("avg_days").alias("avg_days"))


@query("prompt_stats", sql("""SELECT site, round(avg(len(tokens_past)), 9) AS avg_prompt_len, count(*) AS n_rows
    FROM infr WHERE split = 'held_out' GROUP BY site"""))
def prompt_stats(spark, sf):
    rows = wnw.inference_rows(_winnowed(D(spark, sf)), keys=("site", "subject_id", "split"), ordering=drv.ORDERING)
    p = dsc.prompt_stats(rows.filter(F.col("split") == "held_out"))
    return p.select("site", r9("avg_prompt_len").alias("avg_prompt_len"), "n_rows")


@query("type_counts", sql("SELECT split_part(token, '//', 1) AS type, count(*) AS n FROM vocab GROUP BY 1"))
def type_counts(spark, sf):
    return dsc.type_counts(D(spark, sf).vocab().df)


def _sites(spark, sf):
    return [r[0] for r in D(spark, sf).subjects().select("site").distinct().orderBy("site").collect()]


# The sites of the driver's tables, for the SQL twins of pivots.
SITE_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
RATED_OUTCOMES = ["LABEL//error_init", "LABEL//highval_init", "LABEL//purchase_init"]


@query("pivot_sites", sql("SELECT token, " + ", ".join(
    f"""max(CASE WHEN site = '{s}' THEN round(frequency, 9) END) AS "{s}\"""" for s in SITE_NAMES) + " FROM tstats GROUP BY token"))
def pivot_sites(spark, sf):
    s = _stats(spark, sf).select("token", "site", r9("frequency").alias("f"))
    return pivot_checked(s, "token", "site", "f", _sites(spark, sf))


@query("transpose_table", sql("SELECT stat, " + ", ".join(
    f"""max(CASE WHEN site || ' ' || outcome = '{s} {o}' THEN v END) AS "{s} {o}\"""" for s in SITE_NAMES for o in RATED_OUTCOMES)
    + """ FROM (UNPIVOT (SELECT site, outcome, round(rate_ever, 9) AS rate_ever, round(rate_future, 9) AS rate_future FROM rates)
    ON rate_ever, rate_future INTO NAME stat VALUE v) GROUP BY stat"""))
def transpose_table_q(spark, sf):
    r = dsc.outcome_rates(_flags(D(spark, sf)))
    r = r.select(F.concat_ws(" ", "site", "outcome").alias("cell"), r9("rate_ever").alias("rate_ever"), r9("rate_future").alias("rate_future"))
    return transpose_table(r, "cell", "stat")


@query("union_sites", sql("""SELECT site, count(*) AS n_timelines, round(avg(len(tokens)), 9) AS avg_len FROM timelines GROUP BY site
    UNION ALL SELECT 'all', count(*), round(avg(len(tokens)), 9) FROM timelines"""))
def union_sites(spark, sf):
    tl = D(spark, sf).timelines()
    per = tl.groupBy("site").agg(F.count(F.lit(1)).alias("n_timelines"), F.avg(F.array_size("tokens")).alias("avg_len"))
    pooled = tl.agg(F.count(F.lit(1)).alias("n_timelines"), F.avg(F.array_size("tokens")).alias("avg_len")) \
        .withColumn("site", F.lit("all"))
    return union_all([per, pooled]).select("site", "n_timelines", r9("avg_len").alias("avg_len"))


# The report order of outcomes.
OUTCOME_ORDER = ["LABEL//purchase_init", "LABEL//highval_init", "LABEL//error_init"]


@query("custom_order", sql("""SELECT site, outcome, round(rate_ever, 9) AS rate_ever,
    CAST(coalesce(list_position(['""" + "', '".join(OUTCOME_ORDER) + """'], outcome), 0) AS INTEGER) AS ord FROM rates
    ORDER BY ord, site"""))
def custom_order_q(spark, sf):
    r = dsc.outcome_rates(_flags(D(spark, sf))).select("site", "outcome", r9("rate_ever").alias("rate_ever"))
    o = custom_order(r, "outcome", OUTCOME_ORDER)
    return o.withColumn("ord", F.col("ord").cast("int")).orderBy("ord", "site")


@query("seeded_sample", sql(f"""SELECT site, subject_id FROM (SELECT site, subject_id, row_number() OVER (PARTITION BY site
    ORDER BY ('0x' || substr(md5(CAST(subject_id AS VARCHAR) || '|0'), 1, 8))::BIGINT, subject_id) AS rn FROM subjects) WHERE rn <= 20"""))
def seeded_sample_q(spark, sf):
    """20 subjects per site by a seeded hash (the sample is the feature)."""
    return seeded_sample(D(spark, sf).subjects(), "site", "subject_id", 20, seed=0).select("site", "subject_id")


# ---------------------------------------------------------------- list & string functions
@query("f_regex_extract", sql("SELECT DISTINCT token, regexp_extract(token, '^(.+)_Q[0-9]$', 1) AS grp FROM ids WHERE regexp_matches(token, '_Q[0-9]$')"))
def f_regex_extract(spark, sf):
    t = D(spark, sf).token_ids().select("token").distinct().filter(F.col("token").rlike(dsc.BIN_TOKEN))
    return t.select("token", F.regexp_extract("token", dsc.BIN_GROUP, 1).alias("grp"))


@query("filter_regex", sql("SELECT token FROM vocab WHERE regexp_matches(token, '_Q[0-9]$')"))
def filter_regex(spark, sf):
    return D(spark, sf).vocab().df.filter(F.col("token").rlike(dsc.BIN_TOKEN)).select("token")


@query("filter_glob", sql("""SELECT token FROM vocab WHERE regexp_matches(token, '""" +
                          S.globs_to_regex(["LABEL//*", "VAL//click_Q?", "SEG//[ab]*"]) + "')"))
def filter_glob(spark, sf):
    v = D(spark, sf).vocab().df
    return v.filter(S.matches_any_glob("token", ["LABEL//*", "VAL//click_Q?", "SEG//[ab]*"])).select("token")


@query("f_split_first_last", sql("""SELECT token, split_part(token, '//', 1) AS first, split_part(token, '//', -1) AS last,
    split_part(token, '_', -1) AS tail FROM vocab"""))
def f_split_first_last(spark, sf):
    v = D(spark, sf).vocab().df
    return v.select("token", S.split_first("token").alias("first"), S.split_last("token").alias("last"),
                    S.rsplit_last("token").alias("tail"))


@query("f_affix", sql("""SELECT token, trim(upper(regexp_replace(split_part(token, '//', -1), '_init$', ''))) AS short
    FROM vocab WHERE token LIKE 'LABEL//%'"""))
def f_affix(spark, sf):
    v = D(spark, sf).vocab().df.filter(F.col("token").startswith("LABEL//"))
    return v.select("token", S.strip_suffix_upper(S.split_last("token"), "_init").alias("short"))


def _decoded(spark, sf):
    d = D(spark, sf)
    return tkz.timeline_decode(d.timelines(), d.vocab(), keys=("site", "subject_id"))


@query("f_array_join", sql(f"""SELECT site, subject_id, string_agg('<' || token || '>', ', ' ORDER BY {ORD}) AS text
    FROM ids GROUP BY site, subject_id"""))
def f_array_join(spark, sf):
    return _decoded(spark, sf).select("site", "subject_id", S.tokens_text("tokens").alias("text"))


@query("f_list_len", sql("SELECT site, subject_id, CAST(len(tokens) AS INTEGER) AS n FROM timelines"))
def f_list_len(spark, sf):
    return D(spark, sf).timelines().select("site", "subject_id", S.list_len("tokens").alias("n"))


@query("f_list_ends", sql("""SELECT site, subject_id, times[1] AS first, times[-1] AS last, list_min(times) AS tmin,
    list_max(times) AS tmax FROM timelines"""))
def f_list_ends(spark, sf):
    t = D(spark, sf).timelines()
    return t.select("site", "subject_id", S.list_first("times").alias("first"), S.list_last("times").alias("last"),
                    F.array_min("times").alias("tmin"), F.array_max("times").alias("tmax"))


def _purchase_id(d):
    return d.vocab().df.filter(F.col("token") == "LABEL//purchase_init").first()["token_id"]


@query("f_list_contains", sql("""SELECT site, subject_id, coalesce(list_contains(tokens_past,
    (SELECT token_id FROM vocab WHERE token = 'LABEL//purchase_init')), false) AS has FROM infr"""))
def f_list_contains(spark, sf):
    d = D(spark, sf)
    rows = wnw.inference_rows(_winnowed(d), ordering=drv.ORDERING)
    return rows.select("site", "subject_id", S.list_contains("tokens_past", F.lit(_purchase_id(d))).alias("has"))


@query("f_list_count", sql("""SELECT site, subject_id, CAST(len(list_filter(tokens, lambda x: x = b.token_id)) AS INTEGER) AS n_bos,
    CAST(len(list_filter(tokens, lambda x: x = 0)) AS INTEGER) AS n_unk FROM timelines, (SELECT token_id FROM vocab WHERE token = 'BOS') b"""))
def f_list_count(spark, sf):
    d = D(spark, sf)
    bos = d.vocab().df.filter(F.col("token") == "BOS").first()["token_id"]
    return d.timelines().select("site", "subject_id", S.list_count("tokens", F.lit(bos)).alias("n_bos"),
                                S.list_count("tokens", F.lit(0)).alias("n_unk"))


@query("f_list_slice", sql("SELECT site, subject_id, array_to_string(tokens[1:5], ' ') AS head FROM timelines"))
def f_list_slice(spark, sf):
    t = D(spark, sf).timelines()
    return t.select("site", "subject_id", F.array_join(S.list_slice("tokens", 5).cast("array<string>"), " ").alias("head"))


@query("f_duration", sql("""SELECT site, subject_id, CAST(trunc(date_diff('microsecond', list_min(times), list_max(times)) / 86400000000) AS BIGINT) AS days,
    round(date_diff('microsecond', times[1], times[-1]) / 1e6, 6) AS seconds FROM timelines"""))
def f_duration(spark, sf):
    t = D(spark, sf).timelines()
    span = F.timestamp_diff("MICROSECOND", F.array_min("times"), F.array_max("times"))
    return t.select("site", "subject_id", S.trunc_div(span, 86400000000).alias("days"),
                    F.round(F.timestamp_diff("MICROSECOND", S.list_first("times"), S.list_last("times")) / 1e6, 6)
                    .alias("seconds"))


# ====================================================================== harmonize
from timeloom.operators import harmonize as hz  # noqa: E402

# Unit factors ('unit' reaches every brand, 'case' only some units; PROMO has none).
UNIT_FACTORS = [("SMALL", "unit", 1.0), ("MEDIUM", "unit", 2.0), ("LARGE", "unit", 4.0),
                ("ECONOMY", "unit", 0.5), ("STANDARD", "unit", 1.5), ("SMALL", "case", 0.125), ("LARGE", "case", 0.5)]
#: Preferred unit of a brand, by the last digit of its name.
PREFERRED_SQL = "CASE right(p_brand, 1) WHEN '1' THEN 'unit' WHEN '2' THEN 'unit' WHEN '3' THEN 'case' WHEN '4' THEN 'case' END"


@query("convert_dose_units", f"""WITH pref AS (SELECT p_brand, any_value({PREFERRED_SQL}) AS to_unit FROM part WHERE {PREFERRED_SQL} IS NOT NULL GROUP BY p_brand),
    f(u, t, factor) AS (VALUES """ + ", ".join(f"('{u}', '{t}', {x})" for u, t, x in UNIT_FACTORS) + """)
    SELECT p.p_type AS unit, pref.to_unit, CASE WHEN l.l_quantity IS NULL THEN 'missing dose' WHEN p.p_type NOT IN (SELECT u FROM f) THEN 'unknown unit'
        WHEN pref.to_unit IS NULL THEN 'no preferred unit' WHEN f.factor IS NULL THEN 'no factor' ELSE 'success' END AS status,
    count(*) AS n, round(sum(l.l_quantity * f.factor), 6) AS dose FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    LEFT JOIN pref ON p.p_brand = pref.p_brand LEFT JOIN f ON p.p_type = f.u AND pref.to_unit = f.t GROUP BY 1, 2, 3""")
def convert_dose_units(spark, sf):
    d = D(spark, sf)
    li = d.t("lineitem").join(d.t("part"), F.col("l_partkey") == F.col("p_partkey"))
    factors = spark.createDataFrame(UNIT_FACTORS, "from_unit string, to_unit string, factor double")
    preferred = d.t("part").select("p_brand", F.expr(PREFERRED_SQL).alias("to_unit")).where("to_unit is not null").distinct()
    c = hz.convert_dose_units(li, factors, "p_brand", "l_quantity", "p_type", preferred)
    return c.groupBy(F.col("p_type").alias("unit"), F.col("dose_converted_unit").alias("to_unit"), F.col("_convert_status").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("dose_converted"), 6).alias("dose"))


@query("forward_fill", """SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM
    (SELECT event_id, user_id, ts, CASE WHEN event_type = 'view' THEN value END AS v FROM events)""")
def forward_fill(spark, sf):
    """Per user, the last 'view' value carried forward. Rows are bucketed by
    day, so a user with many events is not one task."""
    e = D(spark, sf).t("events").select("event_id", "user_id", "ts",
                                         F.when(F.col("event_type") == "view", F.col("value")).alias("filled"))
    f = hz.forward_fill(e, ["user_id"], "ts", ["filled"], bucket=F.to_date("ts"))
    return f.select("event_id", "filled")


# Severity cut-offs per event type (score = cut-offs reached).
CUTOFFS = {"click": [50.0, 100.0, 200.0, 300.0], "error": [20.0, 60.0, 120.0, 240.0],
           "purchase": [100.0, 150.0, 250.0, 350.0]}


def _sev_sql():
    parts = []
    for comp, cuts in CUTOFFS.items():
        n = " + ".join(f"CASE WHEN w >= {c} THEN 1 ELSE 0 END" for c in cuts)
        parts.append(f"CAST(coalesce(max(CASE WHEN event_type = '{comp}' THEN {n} END), 0) AS INTEGER) AS sev_{comp}")
    return parts


_SEV = ("""SELECT user_id AS group_id, day, """ + ", ".join(_sev_sql()) + """ FROM (
    SELECT user_id, CAST(ts AS DATE) AS day, event_type, max(value) AS w FROM events
    WHERE event_type IN ('click', 'error', 'purchase') GROUP BY 1, 2, 3) GROUP BY 1, 2""")


def _severity(spark, sf):
    e = D(spark, sf).t("events").select(F.col("user_id").alias("group_id"), F.to_date("ts").alias("day"),
                                         "event_type", "value")
    return hz.severity_score(e, ["group_id", "day"], "event_type", "value", CUTOFFS)


@query("severity_score", f"""SELECT *, sev_click + sev_error + sev_purchase AS sev_total FROM ({_SEV})""")
def severity_score(spark, sf):
    return _severity(spark, sf)


_SEVT = ("""SELECT site, subject_id, time, """ + ", ".join(_sev_sql()) + """ FROM (
    SELECT site, subject_id, date_trunc('day', ts) AS time, event_type, max(value) AS w FROM ev
    WHERE event_type IN ('click', 'error', 'purchase') GROUP BY ALL) GROUP BY site, subject_id, time""")


@query("ev_severity", sql("""SELECT site, subject_id, CAST(time AS TIMESTAMP) AS time, 'SOFA' AS prefix, code, CAST(NULL AS DOUBLE) AS numeric_value,
    CAST(NULL AS VARCHAR) AS text_value FROM (""" + " UNION ALL ".join(
    f"SELECT site, subject_id, time, '{c}-' || CAST(sev_{c} AS VARCHAR) AS code FROM ({_SEVT}) WHERE sev_{c} > 0" for c in CUTOFFS) + ")"))
def ev_severity(spark, sf):
    """One event per subject, day and component whose score is above 0, with
    codes like ``click-2``; the entries share one scan of the score table."""
    e = D(spark, sf).ev().select("site", "group_id", "subject_id", F.date_trunc("DAY", "ts").alias("time"), "event_type", "value")
    scores = hz.severity_score(e, ["site", "group_id", "subject_id", "time"], "event_type", "value", CUTOFFS)
    entries = [Entry("scores", "SOFA", code="code", time="time", filter_expr=f"sev_{c} > 0",
                     with_col_expr={"code": f"concat('{c}-', sev_{c})"}) for c in CUTOFFS]
    return _collate(spark, sf, entries, {"scores": scores})


_C.update({
    "blocks": """SELECT *, CAST(sum(nb) OVER (PARTITION BY patient_id ORDER BY start_time ASC NULLS FIRST, stay_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS encounter_block FROM (
        SELECT *, CASE WHEN pe IS NULL OR start_time > pe + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS nb FROM (
            SELECT *, max(end_time) OVER (PARTITION BY patient_id ORDER BY start_time ASC NULLS FIRST, stay_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM stays))""",
    "bsum": """SELECT patient_id, encounter_block, max(start_time) AS max_time,
            max(stay_id) FILTER (WHERE rk = 1) AS last_stay_id FROM (
            SELECT *, row_number() OVER (PARTITION BY patient_id, encounter_block ORDER BY start_time DESC, stay_id DESC) AS rk
            FROM blocks WHERE stay_id IS NOT NULL) GROUP BY patient_id, encounter_block""",
})


def _blocks(spark, sf):
    return hz.encounter_block(D(spark, sf).stays(), "patient_id", "start_time", "end_time", gap_hours=6)


@query("encounter_block", sql("SELECT stay_id, patient_id, encounter_block FROM blocks"))
def encounter_block(spark, sf):
    return _blocks(spark, sf).select("stay_id", "patient_id", "encounter_block")


def _block_summary(spark, sf):
    b = _blocks(spark, sf).withColumn("_t", F.struct("start_time", "stay_id"))
    s = hz.block_summary(b, ["patient_id", "encounter_block"], "_t", "stay_id")
    return s.select("patient_id", "encounter_block", F.col("max_time.start_time").alias("max_time"),
                    "last_stay_id")


@query("block_summary", sql("SELECT patient_id, encounter_block, max_time, last_stay_id FROM bsum"))
def block_summary(spark, sf):
    return _block_summary(spark, sf)


@query("score_join", sql("""SELECT s.patient_id, s.encounter_block, s.last_stay_id, round(t.total, 6) AS total
    FROM bsum s JOIN (SELECT b.patient_id, b.encounter_block, sum(o.o_totalprice) AS total FROM blocks b
        JOIN orders o ON o.o_orderkey = b.stay_id GROUP BY 1, 2) t
    ON s.patient_id = t.patient_id AND s.encounter_block = t.encounter_block"""))
def score_join(spark, sf):
    """Block summary ⋈ per-block totals, promised 1:1 and checked."""
    d = D(spark, sf)
    b = _blocks(spark, sf).join(d.t("orders").select(F.col("o_orderkey").alias("stay_id"), "o_totalprice"), "stay_id")
    tot = b.groupBy("patient_id", "encounter_block").agg(F.sum("o_totalprice").alias("total"))
    j = checked_join(_block_summary(spark, sf), tot, ["patient_id", "encounter_block"], "inner", "1:1", in_plan=True)
    return j.select("patient_id", "encounter_block", "last_stay_id", F.round("total", 6).alias("total"))


@query("validate_tables", """SELECT 'orders' AS tbl, 'null:o_orderdate' AS "check", CAST(count(*) FILTER (WHERE o_orderdate IS NULL) AS BIGINT) AS n_bad FROM orders
    UNION ALL SELECT 'orders', 'domain:o_orderstatus', CAST(count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) AS BIGINT) FROM orders
    UNION ALL SELECT 'orders', 'unique:o_orderkey', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) c FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem', 'null:l_shipdate', CAST(count(*) FILTER (WHERE l_shipdate IS NULL) AS BIGINT) FROM lineitem
    UNION ALL SELECT 'lineitem', 'unique:l_orderkey,l_linenumber', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM
        (SELECT count(*) c FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def validate_tables(spark, sf):
    d = D(spark, sf)
    o = hz.validate_table(d.t("orders"), "orders", not_null=["o_orderdate"], keys=["o_orderkey"],
                          domains={"o_orderstatus": ["F", "O", "P"]})
    li = hz.validate_table(d.t("lineitem"), "lineitem", not_null=["l_shipdate"], keys=["l_orderkey", "l_linenumber"])
    return o.unionByName(li)


@query("first_occurrence", sql("""SELECT site, subject_id, min(ts) AS time, 'LABEL' AS prefix,
    arg_min(code, ts) AS code, CAST(NULL AS DOUBLE) AS numeric_value, CAST(NULL AS VARCHAR) AS text_value
    FROM (SELECT *, 'first_' || event_type AS code FROM ev WHERE event_type = 'signup') GROUP BY site, subject_id"""))
def first_occurrence(spark, sf):
    """Per subject: the code of the earliest row and the earliest time, with
    the aggregates given as SQL text (``min_by``, ``min``)."""
    e = Entry("events", "LABEL", code="code", time="ts", filter_expr="event_type = 'signup'",
              with_col_expr={"code": "concat('first_', event_type)"},
              agg_expr=["min_by(code, ts) AS code", "min(ts) AS ts"])
    return _collate(spark, sf, [e])


def _med_rows(spark, sf):
    d = D(spark, sf)
    li = d.t("lineitem").join(d.t("part"), F.col("l_partkey") == F.col("p_partkey"))
    li = li.join(d.t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    li = li.join(d.site_map(), F.col("o_custkey") == F.col("group_id"))
    factors = spark.createDataFrame(UNIT_FACTORS, "from_unit string, to_unit string, factor double")
    preferred = d.t("part").select("p_brand", F.expr(PREFERRED_SQL).alias("to_unit")).where("to_unit is not null").distinct()
    return hz.convert_dose_units(li, factors, "p_brand", "l_quantity", "p_type", preferred) \
        .withColumnRenamed("l_orderkey", "subject_id")


@query("ev_meds", """WITH sm AS (SELECT c.c_custkey AS group_id, r.r_name AS site FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
    pref AS (SELECT DISTINCT p_brand, """ + PREFERRED_SQL + """ AS to_unit FROM part WHERE """ + PREFERRED_SQL + """ IS NOT NULL),
    f(u, t, factor) AS (VALUES """ + ", ".join(f"('{u}', '{t}', {x})" for u, t, x in UNIT_FACTORS) + """),
    m AS (SELECT sm.site, l.l_orderkey AS subject_id, l.l_shipdate AS t, p.p_brand, l.l_quantity * f.factor AS dose,
        CASE WHEN l.l_quantity IS NULL THEN 'missing dose' WHEN p.p_type NOT IN (SELECT u FROM f) THEN 'unknown unit'
             WHEN pref.to_unit IS NULL THEN 'no preferred unit' WHEN f.factor IS NULL THEN 'no factor' ELSE 'success' END AS status
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN sm ON o.o_custkey = sm.group_id LEFT JOIN pref ON p.p_brand = pref.p_brand
        LEFT JOIN f ON p.p_type = f.u AND pref.to_unit = f.t)
    SELECT site, subject_id, t AS time, 'MED-CTS' AS prefix, p_brand AS code, round(dose, 6) AS numeric_value,
        CAST(NULL AS VARCHAR) AS text_value FROM m WHERE status = 'success'
    UNION ALL SELECT site, subject_id, t, 'MED-CTS', p_brand, NULL, NULL FROM m WHERE status <> 'success'""")
def ev_meds(spark, sf):
    """Converted doses with their value, unconverted ones without; a row
    with a null status would land in neither (S4). Subjects here are orders."""
    from timeloom.operators.collate import Reference
    rows = _med_rows(spark, sf)
    ref = Reference(table="orders", subject_id="subject_id", group_id="group_id",
                    start_time="l_shipdate", end_time="l_shipdate")
    entries = [Entry("meds", "MED-CTS", code="p_brand", time="l_shipdate", numeric_value="dose_converted",
                     filter_expr="_convert_status = 'success'"),
               Entry("meds", "MED-CTS", code="p_brand", time="l_shipdate",
                     filter_expr="_convert_status != 'success'")]
    return _ev_out(collate({"meds": rows}, rows, ref, entries))
