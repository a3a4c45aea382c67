"""Evaluation queries: AUCs, bootstrap family, report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeloom.functions import scalar as S
from timeloom.operators import bootstrap as bs
from timeloom.operators import metrics as mt
from timeloom.operators import replicates as rp
from timeloom.operators.relational import (concat_metrics, custom_order, grid_complete,
                                           pivot_checked, split_table_parts as stp)
from timeloom.session import stage_table
from timeloom.plans.catalog import D, query, r9
from timeloom.plans.oracle import CTES, hash_unit_sql, sql

KEYS = ["site", "model", "outcome"]
N_REP = 1000      # replicates, as in the source
SEED = 42
BASE = "chars"

CUTS = bs.poisson_cuts()


def _w_sql(key: str) -> str:
    """Weight of a row in replicate r.rep: splitmix64 of the draw key's hash."""
    from timeloom.operators.replicates import GAMMA, MASK, MIX_1, MIX_2
    mul = lambda x, c: f"((({x}) * {c}::UHUGEINT) & {MASK}::UHUGEINT)"
    z = f"((('0x' || substr(md5('{SEED}|' || {key}), 1, 16))::UHUGEINT + r.rep::UHUGEINT * {GAMMA}::UHUGEINT) & {MASK}::UHUGEINT)"
    steps = (("xor(z, z >> 30)", MIX_1), ("xor(z, z >> 27)", MIX_2))
    # lambdas over a list of one, so that every step is computed once
    for x, c in steps:
        z = f"list_transform([{z}], lambda z: {mul(x, c)})[1]"
    u = f"list_transform([{z}], lambda z: xor(z, z >> 31) >> 11)[1]"
    return f"list_transform([{u}], lambda u: {' + '.join(f'(u >= {c})::INT' for c in CUTS)})[1]"


def _roc_sql(src: str, keys: str, w: str = "1") -> str:
    """Weighted ROC AUC by running sums (SQL side)."""
    return f"""SELECT {keys}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS v
        FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {keys} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT {keys}, score, sum(CASE WHEN future THEN {w} ELSE 0 END) AS pos,
                           sum(CASE WHEN future THEN 0 ELSE {w} END) AS neg FROM {src} GROUP BY ALL))
        GROUP BY {keys}"""


def _pr_sql(src: str, keys: str, w: str = "1") -> str:
    return f"""SELECT {keys}, CASE WHEN max(P) > 0 THEN sum((rec - prev_rec) * (prec + prev_prec) / 2) END AS v FROM (
        SELECT *, tp / (tp + fp) AS prec, tp / P AS rec,
            lag(tp / (tp + fp), 1, 1.0) OVER (PARTITION BY {keys} ORDER BY s DESC) AS prev_prec,
            lag(tp / P, 1, 0.0) OVER (PARTITION BY {keys} ORDER BY s DESC) AS prev_rec FROM (
            SELECT *, CAST(sum(pos) OVER (PARTITION BY {keys} ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS tp,
                CAST(sum(neg) OVER (PARTITION BY {keys} ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS fp,
                CAST(sum(pos) OVER (PARTITION BY {keys}) AS DOUBLE) AS P FROM (
                SELECT {keys}, round_even(score * 10000.0, 0) / 10000.0 AS s,
                    sum(CASE WHEN future THEN {w} ELSE 0 END) AS pos, sum(CASE WHEN future THEN 0 ELSE {w} END) AS neg
                FROM {src} GROUP BY ALL))) GROUP BY {keys}"""


_K = "site, model, outcome"
_RK = "site, model, outcome, rep"
CTES.update({
    "qs": """SELECT site, model, subject_id, outcome, future,
        CASE WHEN isnan(score) THEN 0.0 ELSE coalesce(score, 0.0) END AS score FROM scores WHERE NOT past""",
    "roc_rank": """SELECT site, model, outcome, CASE WHEN sum(y) = 0 OR sum(1 - y) = 0 THEN NULL ELSE
            (sum(CASE WHEN y = 1 THEN mr ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) END AS roc_auc
        FROM (SELECT *, CAST(future AS INTEGER) AS y,
                rank() OVER (PARTITION BY site, model, outcome ORDER BY score)
                + (count(*) OVER (PARTITION BY site, model, outcome, score) - 1) / 2.0 AS mr FROM qs)
        GROUP BY site, model, outcome""",
    "pr_t": _pr_sql("qs", _K).replace(" AS v FROM", " AS pr_auc FROM", 1),
    "aucs": "SELECT r.site, r.model, r.outcome, r.roc_auc, p.pr_auc FROM roc_rank r JOIN pr_t p USING (site, model, outcome)",
    "reps": f"""SELECT * FROM (SELECT q.*, r.rep, {_w_sql("(q.outcome || '|' || CAST(q.subject_id AS VARCHAR))")} AS w
        FROM qs q, range(1, {N_REP + 1}) r(rep)) WHERE w > 0""",
    "rep_stats": f"""SELECT site, model, 'roc_auc' AS metric, rep, CASE WHEN count(v) = count(*) THEN avg(v) END AS stat FROM ({_roc_sql("reps", _RK, "w")}) GROUP BY site, model, rep
        UNION ALL SELECT site, model, 'pr_auc', rep, CASE WHEN count(v) = count(*) THEN avg(v) END FROM ({_pr_sql("reps", _RK, "w")}) GROUP BY site, model, rep""",
    "cis": """SELECT site, model, metric, quantile_cont(stat, 0.025) AS lo, quantile_cont(stat, 0.975) AS hi
        FROM rep_stats WHERE stat IS NOT NULL AND NOT isnan(stat) GROUP BY site, model, metric""",
    "diffs": f"""SELECT a.site, a.model, a.metric, quantile_cont(a.stat - b.stat, 0.025) AS lo,
            quantile_cont(a.stat - b.stat, 0.975) AS hi
        FROM rep_stats a JOIN rep_stats b ON a.site = b.site AND a.metric = b.metric AND a.rep = b.rep
        WHERE b.model = '{BASE}' AND a.model <> '{BASE}' AND a.stat - b.stat IS NOT NULL AND NOT isnan(a.stat - b.stat)
        GROUP BY a.site, a.model, a.metric""",
})


def _scores(spark, sf):
    return D(spark, sf).scores()


def _q(spark, sf):
    return mt.qualify(_scores(spark, sf))


def _aucs(spark, sf):
    return mt.auc_table(_q(spark, sf), KEYS)


@query("qualify", sql("SELECT site, model, outcome, count(*) AS n, round(sum(score), 6) AS total FROM qs GROUP BY ALL"))
def qualify(spark, sf):
    return _q(spark, sf).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("score"), 6).alias("total"))


@query("roc_auc", sql("SELECT site, model, outcome, round(roc_auc, 9) AS roc_auc FROM roc_rank"))
def roc_auc(spark, sf):
    return mt.roc_auc(_q(spark, sf), KEYS).select(*KEYS, r9("roc_auc").alias("roc_auc"))


@query("pr_auc", sql("SELECT site, model, outcome, round(pr_auc, 9) AS pr_auc FROM pr_t"))
def pr_auc(spark, sf):
    return mt.pr_auc(_q(spark, sf), KEYS).select(*KEYS, r9("pr_auc").alias("pr_auc"))


def _dims(spark, sf):
    s = _scores(spark, sf)
    return {c: [r[0] for r in s.select(c).distinct().orderBy(c).collect()] for c in ("outcome", "model", "site")}


_GRID_SQL = """SELECT o.outcome, m.model, s.site, round(a.roc_auc, 9) AS roc_auc, round(a.pr_auc, 9) AS pr_auc
    FROM (SELECT DISTINCT outcome FROM scores) o, (SELECT DISTINCT model FROM scores) m, (SELECT DISTINCT site FROM scores) s
    LEFT JOIN aucs a ON a.outcome = o.outcome AND a.model = m.model AND a.site = s.site"""


@query("tokenwise_results", sql(_GRID_SQL))
def tokenwise_results(spark, sf):
    a = _aucs(spark, sf).select(*KEYS, r9("roc_auc").alias("roc_auc"), r9("pr_auc").alias("pr_auc"))
    return grid_complete(spark, _dims(spark, sf), a).select("outcome", "model", "site", "roc_auc", "pr_auc")


@query("grid_complete", sql(_GRID_SQL.replace("LEFT JOIN aucs a", "LEFT JOIN (SELECT * FROM aucs WHERE roc_auc >= 0.5) a")))
def grid_complete_q(spark, sf):
    """Cells with AUC below 0.5 are left out of the facts; the grid keeps
    them as nulls (S24)."""
    a = _aucs(spark, sf).filter(F.col("roc_auc") >= 0.5) \
        .select(*KEYS, r9("roc_auc").alias("roc_auc"), r9("pr_auc").alias("pr_auc"))
    return grid_complete(spark, _dims(spark, sf), a).select("outcome", "model", "site", "roc_auc", "pr_auc")


@query("concat_metrics", sql("""SELECT site, model, outcome, round(roc_auc, 9) AS roc_value, round(pr_auc, 9) AS pr_value FROM aucs"""))
def concat_metrics_q(spark, sf):
    q = _q(spark, sf)
    roc = mt.roc_auc(q, KEYS).select(*KEYS, r9("roc_auc").alias("value"))
    pr = mt.pr_auc(q, KEYS).select(*KEYS, r9("pr_auc").alias("value"))
    return concat_metrics({"roc": roc, "pr": pr}, KEYS)


# Outcomes and sites of the scored rows, for the twin of the pivot.
CELLS = [f"{o}_{x}" for o in ("quality", "toxic") for x in ("de", "en", "es", "fr")]


@query("unstack_outcomes", sql("SELECT model, " + ", ".join(
    f"max(CASE WHEN outcome || '_' || site = '{c}' THEN round(roc_auc, 9) END) AS {c}" for c in CELLS) + " FROM aucs GROUP BY model"))
def unstack_outcomes(spark, sf):
    a = _aucs(spark, sf).select("model", F.concat_ws("_", "outcome", "site").alias("col"), r9("roc_auc").alias("v"))
    cols = [r[0] for r in a.select("col").distinct().orderBy("col").collect()]
    return pivot_checked(a, "model", "col", "v", cols)


@query("split_table_parts", sql("""SELECT site, model, outcome, ntile(4) OVER (ORDER BY outcome, model, site) AS part FROM aucs"""))
def split_table_parts(spark, sf):
    """The result table (sites × models × outcomes) cut into 4 equal parts."""
    a = _aucs(spark, sf).select(*KEYS)
    return stp(a, ["outcome", "model", "site"], 4).withColumn("part", F.col("part").cast("long"))


@query("matrix_marginals", sql("""SELECT outcome, model, site, round(avg(roc_auc), 9) AS roc_auc FROM aucs
    GROUP BY GROUPING SETS ((outcome, model, site), (outcome, model), (outcome, site), (outcome))"""))
def matrix_marginals(spark, sf):
    from timeloom.operators.describe import matrix_marginals as mm
    m = mm(_aucs(spark, sf), "model", "site", "roc_auc", by=["outcome"])
    return m.select("outcome", "model", "site", r9("roc_auc").alias("roc_auc"))


@query("paired_scores", sql(f"""SELECT a.site, a.subject_id, a.outcome, a.future, b.model, round(a.score, 9) AS score_base,
    round(b.score, 9) AS score_other FROM qs a JOIN qs b ON a.site = b.site AND a.subject_id = b.subject_id AND a.outcome = b.outcome
    WHERE a.model = '{BASE}' AND b.model <> '{BASE}'"""))
def paired_scores(spark, sf):
    """Every other model beside the base on the same subjects; rows and labels
    must agree (one grouped pass checks all models)."""
    q = _q(spark, sf)
    on = ["site", "subject_id", "outcome"]
    bs.check_paired_all(q, on, q.select("model").distinct().count())
    a, b = q.filter(F.col("model") == BASE), q.filter(F.col("model") != BASE)
    return a.select(*on, "future", r9("score").alias("score_base")).join(b.select(*on, "model", r9("score").alias("score_other")), on)


def _ci_out(df):
    return df.select(*[c for c in df.columns if c not in ("lo", "hi")], r9("lo").alias("lo"), r9("hi").alias("hi"))


@query("bootstrap_ci", sql("SELECT site, model, metric, round(lo, 9) AS lo, round(hi, 9) AS hi FROM cis"))
def bootstrap_ci(spark, sf):
    return _ci_out(bs.bootstrap_ci(_q(spark, sf), ("site", "model"), N_REP, SEED))


@query("paired_diff_ci", sql("SELECT site, model, metric, round(lo, 9) AS lo, round(hi, 9) AS hi FROM diffs"))
def paired_diff_ci(spark, sf):
    return _ci_out(bs.paired_diff_ci(_q(spark, sf), BASE, ["words", "source"], ("site",), N_REP, SEED))


@query("all_diff_cis", sql("SELECT site, model, metric, round(lo, 9) AS lo, round(hi, 9) AS hi FROM diffs"))
def all_diff_cis(spark, sf):
    return _ci_out(bs.paired_diff_ci(_q(spark, sf), BASE, None, ("site",), N_REP, SEED))


CTES.update({
    "reps_u": f"""SELECT * FROM (SELECT q.*, r.rep, {_w_sql("(q.model || '|' || q.outcome || '|' || CAST(q.subject_id AS VARCHAR))")} AS w
        FROM qs q, range(1, {N_REP + 1}) r(rep) WHERE q.model IN ('{BASE}', 'source')) WHERE w > 0""",
    "rep_stats_u": f"""SELECT site, model, 'roc_auc' AS metric, rep, CASE WHEN count(v) = count(*) THEN avg(v) END AS stat FROM ({_roc_sql("reps_u", _RK, "w")}) GROUP BY site, model, rep
        UNION ALL SELECT site, model, 'pr_auc', rep, CASE WHEN count(v) = count(*) THEN avg(v) END FROM ({_pr_sql("reps_u", _RK, "w")}) GROUP BY site, model, rep""",
})


@query("bootstrap_pvalue", sql(f"""SELECT a.site, a.metric, round(least(1.0, 2 * least(avg(CAST(a.stat - b.stat <= 0 AS DOUBLE)),
        avg(CAST(a.stat - b.stat >= 0 AS DOUBLE)))), 9) AS p_value
    FROM rep_stats_u a JOIN rep_stats_u b ON a.site = b.site AND a.metric = b.metric AND a.rep = b.rep
    WHERE a.model = 'source' AND b.model = '{BASE}' AND a.stat - b.stat IS NOT NULL AND NOT isnan(a.stat - b.stat)
    GROUP BY a.site, a.metric"""))
def bootstrap_pvalue(spark, sf):
    p = bs.bootstrap_pvalue(_q(spark, sf), BASE, "source", ("site",), N_REP, SEED)
    return p.select("site", "metric", r9("p_value").alias("p_value"))


@query("bootstrap_exact_split", sql(f"""SELECT * FROM (WITH t AS (SELECT site, outcome, count(DISTINCT subject_id) AS n FROM qs GROUP BY site, outcome),
    b AS (SELECT site, outcome, n, unnest(range(0, (n + 31) // 32)) AS block FROM t)
    SELECT site, outcome, n, count(*) AS blocks, CAST({N_REP} AS BIGINT) AS full_replicates FROM b GROUP BY site, outcome, n)"""))
def bootstrap_exact_split(spark, sf):
    """The split table of the exact draw (blocks of 32 subjects): how many
    replicates' draws add up to the number of subjects, per site and outcome."""
    rows = rp.numbered_subjects(_q(spark, sf), ["site", "outcome"], "subject_id", KEYS)
    blocks = rows.select("_g", "_n", F.floor(F.col("_pos") / 32).alias("_block")).distinct()
    drawn = rp.split_draws(blocks, N_REP, SEED, 32).select("_g", "_n", "_block", F.posexplode("draws").alias("rep", "drawn"))
    per = drawn.groupBy("_g", "_n", "rep").agg(F.sum("drawn").alias("drawn"), F.count(F.lit(1)).alias("blocks"))
    per = per.groupBy("_g", "_n").agg(F.max("blocks").alias("blocks"), F.count_if(F.col("drawn") == F.col("_n")).alias("full_replicates"))
    return per.select(F.from_json("_g", "site string, outcome string").alias("k"), "*").select("k.*", F.col("_n").alias("n"), "blocks", "full_replicates")


@query("bootstrap_ci_exact")
def bootstrap_ci_exact(spark, sf):
    """Intervals from exact draws (numpy generators seeded per block: no twin)."""
    return _ci_out(bs.bootstrap_ci(_q(spark, sf), ("site", "model"), N_REP, SEED, exact=True))


def _cis(spark, sf):
    """The interval table, computed once per driver and shared by the report
    queries built on it (formatting, bars, cells)."""
    d = D(spark, sf)
    if "cis" not in d._fitted:
        d._fitted["cis"] = stage_table(bs.bootstrap_ci(_q(spark, sf), ("site", "model"), N_REP, SEED), "intervals")
    return d._fitted["cis"]


_CI_TEXT = "printf('%.3f (±%.3f)', (lo + hi) / 2, abs(hi - lo) / 2)"


@query("f_ci_format", sql(f"SELECT site, model, metric, {_CI_TEXT} AS text FROM cis"))
def f_ci_format(spark, sf):
    c = _cis(spark, sf)
    return c.select("site", "model", "metric", S.ci_format("lo", "hi").alias("text"))


@query("ci_table", sql(f"""SELECT site, model, max(CASE WHEN metric = 'roc_auc' THEN {_CI_TEXT} END) AS roc_auc,
    max(CASE WHEN metric = 'pr_auc' THEN {_CI_TEXT} END) AS pr_auc FROM cis GROUP BY site, model"""))
def ci_table(spark, sf):
    c = _cis(spark, sf).select("site", "model", "metric", S.ci_format("lo", "hi").alias("text"))
    return pivot_checked(c, ["site", "model"], "metric", "text", ["roc_auc", "pr_auc"])


@query("f_ci_center_bars", sql("""SELECT site, model, metric, round((lo + hi) / 2, 9) AS mid, round((lo + hi) / 2 - lo, 9) AS arm_lo,
    round(hi - (lo + hi) / 2, 9) AS arm_hi FROM cis"""))
def f_ci_center_bars(spark, sf):
    c = _cis(spark, sf)
    m, lo, hi = S.ci_center_bars("lo", "hi")
    return c.select("site", "model", "metric", r9(m).alias("mid"), r9(lo).alias("arm_lo"), r9(hi).alias("arm_hi"))


@query("parse_ci_cell", sql("""SELECT site, model, metric, round(lo, 9) AS lo, round(hi, 9) AS hi FROM cis"""))
def parse_ci_cell(spark, sf):
    """Interval cells written as text ``"[lo hi]"`` and read back."""
    c = _cis(spark, sf).select("site", "model", "metric",
                               F.concat(F.lit("["), F.col("lo").cast("string"), F.lit(" "),
                                        F.col("hi").cast("string"), F.lit("]")).alias("cell"))
    return c.select("site", "model", "metric", r9(S.parse_ci_lo("cell")).alias("lo"), r9(S.parse_ci_hi("cell")).alias("hi"))


@query("f_round_even", sql("SELECT site, model, subject_id, outcome, round_even(score * 10000.0, 0) / 10000.0 AS s4 FROM qs"))
def f_round_even(spark, sf):
    return _q(spark, sf).select("site", "model", "subject_id", "outcome", S.round_even("score", 4).alias("s4"))


# Report order of outcomes and models.
REPORT_OUTCOMES = ["quality", "toxic"]
REPORT_MODELS = ["chars", "words", "source"]


@query("tokenwise_report", sql("""SELECT upper(outcome) AS outcome, model, upper(model) AS label,
        max(CASE WHEN site = 'de' THEN round(roc_auc, 9) END) AS de, max(CASE WHEN site = 'en' THEN round(roc_auc, 9) END) AS en,
        max(CASE WHEN site = 'es' THEN round(roc_auc, 9) END) AS es, max(CASE WHEN site = 'fr' THEN round(roc_auc, 9) END) AS fr,
        CAST(list_position(['quality', 'toxic'], outcome) AS INTEGER) AS o_ord,
        CAST(list_position(['chars', 'words', 'source'], model) AS INTEGER) AS m_ord
    FROM aucs GROUP BY outcome, model ORDER BY o_ord, m_ord"""))
def tokenwise_report(spark, sf):
    """Three result sets (one per model) merged, labelled, pivoted by site
    and put in a fixed order."""
    a = _aucs(spark, sf)
    parts = [a.filter(F.col("model") == m) for m in REPORT_MODELS]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    u = u.withColumn("label", S.site_label("model", labels=[]))
    wide = pivot_checked(u.select("outcome", "model", "label", "site", r9("roc_auc").alias("v")),
                         ["outcome", "model", "label"], "site", "v", ["de", "en", "es", "fr"])
    wide = custom_order(wide, "outcome", REPORT_OUTCOMES, "o_ord")
    wide = custom_order(wide, "model", REPORT_MODELS, "m_ord")
    return (wide.withColumn("outcome", F.upper("outcome"))
            .withColumn("o_ord", F.col("o_ord").cast("int")).withColumn("m_ord", F.col("m_ord").cast("int"))
            .orderBy("o_ord", "m_ord"))


# Data fractions of the sweep, in percent (1–10, then by 5).
FRACTIONS = list(range(1, 11)) + list(range(15, 101, 5))


@query("fraction_sweep", sql(f"""SELECT site, model, outcome, CAST(f AS INTEGER) AS pct, count(*) AS n, round(
        CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN (sum(CASE WHEN y = 1 THEN mr ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
        / (sum(y) * sum(1 - y)) END, 9) AS roc_auc FROM (
    SELECT *, rank() OVER (PARTITION BY site, model, outcome, f ORDER BY score)
        + (count(*) OVER (PARTITION BY site, model, outcome, f, score) - 1) / 2.0 AS mr
    FROM (SELECT q.*, CAST(q.future AS INTEGER) AS y, t.f FROM qs q, (SELECT unnest({FRACTIONS}) AS f) t
          WHERE {hash_unit_sql('q.subject_id', 11)} < t.f / 100.0))
    GROUP BY site, model, outcome, f"""))
def fraction_sweep(spark, sf):
    """Metric against the share of each site's rows, for every model and
    outcome: nested samples (a row in the k % sample is in every larger one)
    by a seeded hash that is taken once per row."""
    q = _q(spark, sf).withColumn("_u", S.hash_unit("subject_id", 11))
    pct = F.filter(F.array(*[F.lit(f) for f in FRACTIONS]), lambda f: F.col("_u") < f / F.lit(100.0))
    x = q.select(*KEYS, "score", "future", F.explode(pct).alias("pct"))
    auc = mt.roc_auc(x, [*KEYS, "pct"])
    n = x.groupBy(*KEYS, "pct").agg(F.count(F.lit(1)).alias("n"))
    return n.join(auc, [*KEYS, "pct"]).select(*KEYS, "pct", "n", r9("roc_auc").alias("roc_auc"))


@query("mc_score", """SELECT vec_id, label, round(avg(CAST(x > 0 AS INTEGER)), 9) AS mc_score FROM
    (SELECT vec_id, label, unnest(embedding) AS x FROM embeddings) GROUP BY vec_id, label""")
def mc_score(spark, sf):
    """Share of sampled trajectories that hit the outcome: each of a vector's
    components stands for one trajectory, a hit when positive."""
    e = D(spark, sf).t("embeddings").select("vec_id", "label", F.explode("embedding").alias("x"))
    return e.groupBy("vec_id", "label").agg(r9(F.avg((F.col("x") > 0).cast("int"))).alias("mc_score"))


