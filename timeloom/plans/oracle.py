"""DuckDB twins of the driver-data frames, as named CTEs.

``sql(body, *needs)`` prepends the CTEs the body needs, in dependency order.
The SQL is written independently of the Spark code (brute force where the
Spark side is clever), so agreement is a real check."""

from __future__ import annotations

import re

from timeloom.plans.driver import FIT_SITE, HIGH_VALUE, N_BINS, SPLIT_SEED, WEEK_KEY, ORDERING

H = "CAST(('0x' || substr(md5(CAST({x} AS VARCHAR) || '|{seed}'), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE"


def hash_unit_sql(x: str, seed) -> str:
    return H.format(x=x, seed=seed)


def split_sql(x: str) -> str:
    h = hash_unit_sql(x, SPLIT_SEED)
    return f"CASE WHEN {h} < 0.7::DOUBLE THEN 'train' WHEN {h} < 0.8::DOUBLE THEN 'tuning' ELSE 'held_out' END"


PROBS = "[" + ", ".join(str(i / N_BINS) for i in range(1, N_BINS)) + "]"
ORDER_LIST = "[" + ", ".join(f"'{p}'" for p in ORDERING) + "]"
RANK = f"coalesce(list_position({ORDER_LIST}, prefix), {len(ORDERING) + 1})"

CTES: dict[str, str] = {
    "site_map": """SELECT c.c_custkey AS group_id, r.r_name AS site FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "ev": f"""SELECT s.site, e.user_id AS group_id,
        e.user_id * {WEEK_KEY} + CAST(date_diff('day', DATE '1970-01-01', CAST(date_trunc('week', e.ts) AS DATE)) AS BIGINT) AS subject_id,
        e.event_id, e.ts, e.event_type, e.value FROM events e JOIN site_map s ON e.user_id = s.group_id""",
    "subjects": "SELECT site, group_id, subject_id, min(ts) AS start_time, max(ts) AS end_time FROM ev GROUP BY site, group_id, subject_id",
    "ref": f"""SELECT s.*, c.c_mktsegment, c.c_acctbal, {split_sql('s.group_id')} AS split
        FROM subjects s LEFT JOIN customer c ON s.group_id = c.c_custkey""",
    "evl0": f"""SELECT site, group_id, subject_id, start_time AS time, 'SEG' AS prefix, c_mktsegment AS code,
            CAST(NULL AS DOUBLE) AS numeric_value, CAST(NULL AS VARCHAR) AS text_value, CAST(NULL AS BIGINT) AS event_id FROM ref
        UNION ALL SELECT site, group_id, subject_id, start_time, 'BAL', 'acctbal', c_acctbal, NULL, NULL FROM ref
        UNION ALL SELECT site, group_id, subject_id, ts, 'VAL', event_type, value, NULL, event_id FROM ev
        UNION ALL SELECT site, group_id, subject_id, min(ts), 'LABEL', 'purchase_init', NULL, NULL, NULL FROM ev
            WHERE event_type = 'purchase' GROUP BY site, group_id, subject_id
        UNION ALL SELECT site, group_id, subject_id, min(ts), 'LABEL', 'error_init', NULL, NULL, NULL FROM ev
            WHERE event_type = 'error' GROUP BY site, group_id, subject_id
        UNION ALL SELECT site, group_id, subject_id, min(ts), 'LABEL', 'highval_init', NULL, NULL, NULL FROM ev
            WHERE value >= {HIGH_VALUE} GROUP BY site, group_id, subject_id""",
    "evl": f"SELECT *, {split_sql('group_id')} AS split FROM evl0",
    "breaks": f"""SELECT prefix, code, quantile_cont(numeric_value, {PROBS}) AS breaks FROM evl
        WHERE site = '{FIT_SITE}' AND split = 'train' AND numeric_value IS NOT NULL AND NOT isnan(numeric_value)
        GROUP BY prefix, code""",
    "binned": """SELECT e.*, CASE WHEN e.numeric_value IS NOT NULL AND b.breaks IS NOT NULL
            THEN CAST(len(list_filter(b.breaks, lambda x: x <= e.numeric_value)) AS INTEGER) END AS bin
        FROM evl e LEFT JOIN breaks b ON e.prefix = b.prefix AND e.code = b.code""",
    "tok0": """SELECT *, CASE WHEN bin IS NOT NULL THEN concat_ws('//', prefix, lower(code)) || '_Q' || CAST(bin AS VARCHAR)
            ELSE concat_ws('//', prefix, lower(code)) END AS token FROM binned""",
    "tok": """SELECT site, group_id, subject_id, time, prefix, code, numeric_value, event_id, split, bin, token FROM tok0
        UNION ALL SELECT site, group_id, subject_id, start_time, 'BOS', NULL, NULL, NULL, split, NULL, 'BOS' FROM ref
        UNION ALL SELECT site, group_id, subject_id, end_time, 'EOS', NULL, NULL, NULL, split, NULL, 'EOS' FROM ref""",
    "vocab": f"""SELECT 'UNK' AS token, 0 AS token_id
        UNION ALL SELECT token, CAST(row_number() OVER (ORDER BY token) AS INTEGER) FROM
        (SELECT DISTINCT token FROM tok WHERE site = '{FIT_SITE}' AND split = 'train' AND token IS NOT NULL AND token <> 'UNK')""",
    "ids": """SELECT t.* REPLACE (CASE WHEN v.token_id IS NULL THEN 'UNK' ELSE t.token END AS token),
            coalesce(v.token_id, 0) AS token_id FROM tok t LEFT JOIN vocab v ON t.token = v.token""",
    "timelines": f"""SELECT site, subject_id, split,
            list(token_id ORDER BY time, {RANK}, token, event_id NULLS FIRST) AS tokens,
            list(time ORDER BY time, {RANK}, token, event_id NULLS FIRST) AS times
        FROM ids GROUP BY site, subject_id, split""",
    "n_tl": "SELECT site, count(*) AS n_timelines FROM subjects GROUP BY site",
    "tstats": """SELECT c.site, c.token, c.n_occurrences, c.n_timelines_with_token,
            CAST(c.n_timelines_with_token AS DOUBLE) / n.n_timelines AS prevalence,
            CAST(c.n_occurrences AS DOUBLE) / sum(c.n_occurrences) OVER (PARTITION BY c.site) AS frequency
        FROM (SELECT site, token, count(*) AS n_occurrences, count(DISTINCT subject_id) AS n_timelines_with_token
              FROM ids GROUP BY site, token) c JOIN n_tl n ON c.site = n.site""",
    "qtok": """SELECT site, token, frequency, regexp_extract(token, '^(.+)_Q[0-9]$', 1) AS grp
        FROM tstats WHERE regexp_matches(token, '_Q[0-9]$')""",
    "qgrid": """SELECT b.grp, b.token, g.site, coalesce(q.frequency, 0.0) AS v
        FROM (SELECT DISTINCT grp, token FROM qtok) b
        JOIN (SELECT DISTINCT grp, site FROM qtok) g ON b.grp = g.grp
        LEFT JOIN qtok q ON q.grp = b.grp AND q.site = g.site AND q.token = b.token
        WHERE b.grp IN (SELECT grp FROM qtok GROUP BY grp
                        HAVING count(DISTINCT site) = (SELECT count(DISTINCT site) FROM tstats))""",
    "qcum": """SELECT *, sum(v / tot) OVER (PARTITION BY grp, site ORDER BY token
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
        FROM (SELECT *, sum(v) OVER (PARTITION BY grp, site) AS tot FROM qgrid)""",
    "divergence": """SELECT grp, avg(w1) AS w1 FROM (
            SELECT a.grp, a.site, b.site, sum(abs(a.cum - b.cum)) AS w1 FROM qcum a JOIN qcum b
            ON a.grp = b.grp AND a.token = b.token AND a.site < b.site GROUP BY a.grp, a.site, b.site)
        GROUP BY grp HAVING min(w1) IS NOT NULL""",
    "stays": """SELECT o.o_custkey AS patient_id, o.o_orderkey AS stay_id, o.o_orderdate AS start_time, e.end_time
        FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS end_time FROM lineitem GROUP BY l_orderkey) e
        ON o.o_orderkey = e.l_orderkey""",
    "units": """SELECT l_orderkey AS stay_id, CASE WHEN l_returnflag = 'R' THEN 'icu' ELSE lower(l_linestatus) END AS location,
        l_shipdate AS in_time FROM lineitem""",
    "scores": """SELECT site, model, subject_id, outcome, past, future, score FROM (
        SELECT d.lang AS site, d.doc_id AS subject_id, l.quality, l.toxic, d.n_chars,
               least(CAST(d.n_chars AS DOUBLE) / 20000.0::DOUBLE, 1.0::DOUBLE) AS s_chars,
               CAST(len(string_split(d.text, ' ')) AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 1.0::DOUBLE) AS s_words,
               CAST(substr(d.source, 4, 8) AS DOUBLE) / 50.0::DOUBLE AS s_source
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id) j,
        (VALUES ('chars'), ('words'), ('source')) m(model), (VALUES ('quality'), ('toxic')) o(outcome),
        LATERAL (SELECT CASE WHEN model = 'chars' THEN s_chars WHEN model = 'words' THEN s_words ELSE s_source END AS score,
                        CASE WHEN outcome = 'quality' THEN false ELSE (toxic = 1 AND n_chars < 1000) END AS past,
                        CASE WHEN outcome = 'quality' THEN quality = 1 ELSE toxic = 1 END AS future)""",
}


def _deps(body: str) -> list[str]:
    names = set(re.findall(r"\b([a-z_][a-z0-9_]*)\b", body))
    return [n for n in CTES if n in names]


def sql(body: str, *extra: str) -> str:
    """``WITH`` every CTE the body (transitively) names, then the body."""
    order: list[str] = []

    def visit(name: str, seen: set):
        if name in order:
            return
        if name in seen:
            raise ValueError(f"cycle at {name}")
        seen.add(name)
        for d in _deps(CTES[name]):
            if d != name:
                visit(d, seen)
        order.append(name)

    for n in list(_deps(body)) + list(extra):
        visit(n, set())
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body


# ---------------------------------------------------------------- later stages
from timeloom.functions.scalar import glob_to_regex  # noqa: E402
from timeloom.plans.driver import OUTCOMES, WINNOW_SECONDS  # noqa: E402

OUT_RE = "|".join(f"(?:{glob_to_regex(p)})" for p in OUTCOMES)
ORD = f"time, {RANK}, token"

CTES.update({
    "wn": f"""SELECT *, time <= min(time) OVER (PARTITION BY site, subject_id) + INTERVAL {WINNOW_SECONDS} SECOND AS past
        FROM ids""",
    "outs": f"SELECT token AS outcome FROM vocab WHERE regexp_matches(token, '{OUT_RE}')",
    "flags": """SELECT s.site, s.subject_id, o.outcome,
            coalesce(max(CASE WHEN w.past THEN 1 END) = 1, false) AS past,
            coalesce(max(CASE WHEN NOT w.past THEN 1 END) = 1, false) AS future
        FROM subjects s CROSS JOIN outs o
        LEFT JOIN wn w ON w.site = s.site AND w.subject_id = s.subject_id AND w.token = o.outcome
        GROUP BY s.site, s.subject_id, o.outcome""",
    "infr": f"""SELECT w.site, w.subject_id, r.split, list(token_id ORDER BY {ORD}) AS tokens,
            list(token_id ORDER BY {ORD}) FILTER (WHERE past) AS tokens_past
        FROM wn w JOIN ref r ON w.site = r.site AND w.subject_id = r.subject_id GROUP BY w.site, w.subject_id, r.split""",
    "fs": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY patient_id
            ORDER BY start_time ASC NULLS FIRST, stay_id) AS rn FROM stays) WHERE rn = 1""",
    "fu": "SELECT stay_id, min(in_time) AS first_unit_in FROM units WHERE lower(location) = 'icu' GROUP BY stay_id",
    "cohort": """SELECT f.patient_id, f.stay_id, u.first_unit_in FROM fs f JOIN fu u ON f.stay_id = u.stay_id
        WHERE f.end_time - f.start_time >= INTERVAL 1 DAY AND u.first_unit_in <= f.start_time + INTERVAL 1 DAY""",
})
