"""Relational and scalar queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeloom.functions import scalar as S
from timeloom.operators import relational as R
from timeloom.sources import io
from timeloom.plans.catalog import D, query, r9
from timeloom.plans.oracle import hash_unit_sql, sql


def T(spark, sf, name):
    return D(spark, sf).t(name)


# ---------------------------------------------------------------- sources
@query("scan_parquet", "SELECT * FROM nation")
def scan_parquet(spark, sf):
    return io.scan_parquet(spark, sf, "nation")


@query("scan_projected", "SELECT o_orderkey, o_totalprice FROM orders")
def scan_projected(spark, sf):
    return io.scan_projected(spark, sf, "orders", ["o_orderkey", "o_totalprice"])


@query("scan_glob", "SELECT n_nationkey AS k, n_name AS name FROM nation")
def scan_glob(spark, sf):
    return io.scan_glob(spark, f"{sf}/nation*.parquet").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))


@query("scan_optional", """SELECT 'nation' AS tbl, count(*) AS n_rows FROM nation
    UNION ALL SELECT 'orders', count(*) FROM orders""")
def scan_optional(spark, sf):
    """The inputs that exist; the missing one is left out."""
    found = io.scan_optional(spark, {"nation": f"{sf}/nation.parquet", "orders": f"{sf}/orders.parquet", "none": f"{sf}/no_such_table.parquet"})
    return R.union_all([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("tbl"), "n_rows") for k, df in found.items()])


@query("schema_discover", """SELECT 'cut' AS outcome, count(*) FILTER (WHERE l_discount > 0.05) AS n FROM lineitem
    UNION ALL SELECT 'big', count(*) FILTER (WHERE l_quantity > 40) FROM lineitem""")
def schema_discover(spark, sf):
    """Outcomes found by the suffix of boolean columns, counted."""
    li = T(spark, sf, "lineitem").select("l_orderkey", (F.col("l_discount") > 0.05).alias("cut_past"),
                                         (F.col("l_quantity") > 40).alias("big_past"), F.col("l_linestatus").alias("note_past"))
    names = io.schema_discover(li)
    return li.agg(*[F.count(F.when(F.col(f"{n}_past"), 1)).alias(n) for n in names]).unpivot([], names, "outcome", "n")


@query("cast_key", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey FROM orders")
def cast_key(spark, sf):
    return io.cast_key(T(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "o_custkey")


@query("drop_optional", "SELECT * EXCLUDE (s_acctbal) FROM supplier")
def drop_optional(spark, sf):
    return io.drop_optional(T(spark, sf, "supplier"), "s_acctbal", "no_such_column")


@query("join_guard", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_guard(spark, sf):
    """Many nations to one region: the right side is checked to be unique."""
    region = T(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return R.checked_join(T(spark, sf, "nation"), region, "n_regionkey", "inner", "m:1", in_plan=True).select("n_name", "r_name")


@query("subset_tables", """
    WITH stays AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
         pats AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT 'lineitem' AS tbl, count(*) AS n_rows FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM stays)
    UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM pats)
    UNION ALL SELECT 'region', count(*) FROM region""")
def subset_tables(spark, sf):
    """lineitem has the stay key → by stay; orders only the patient key → by
    patient; region neither → copied."""
    o = T(spark, sf, "orders")
    cohort = (o.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("stay")))
    pats = T(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("patient"))
    tables = {"lineitem": T(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "stay"),
              "orders": o.withColumnRenamed("o_custkey", "patient"),
              "region": T(spark, sf, "region")}
    by_stay = io.subset_tables({"lineitem": tables["lineitem"]}, cohort, "stay", "patient")
    by_pat = io.subset_tables({"orders": tables["orders"], "region": tables["region"]},
                              pats, "stay", "patient")
    parts = {**by_stay, **by_pat}
    return R.union_all([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(k).alias("tbl"), "n_rows")
                        for k, df in parts.items()])


@query("combine_sites", """SELECT 'customer' AS site, c_nationkey AS nationkey, round(sum(c_acctbal), 6) AS bal, count(*) AS n FROM customer GROUP BY 2
    UNION ALL SELECT 'supplier', s_nationkey, round(sum(s_acctbal), 6), count(*) FROM supplier GROUP BY 2""")
def combine_sites(spark, sf):
    c = T(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("bal"))
    s = T(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("bal"))
    both = io.combine_sites({"customer": c, "supplier": s})
    return both.groupBy("site", "nationkey").agg(F.round(F.sum("bal"), 6).alias("bal"),
                                                 F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- projections
@query("project_alias", """SELECT l_orderkey AS stay, l_linenumber AS line,
    round(l_extendedprice * (1 - l_discount), 6) AS revenue, l_shipdate AS at FROM lineitem""")
def project_alias(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("stay"), F.col("l_linenumber").alias("line"),
                     F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 6).alias("revenue"),
                     F.col("l_shipdate").alias("at"))


@query("with_literal", "SELECT o_orderkey, 'age' AS code, 1 AS one FROM orders")
def with_literal(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", F.lit("age").alias("code"), F.lit(1).alias("one"))


@query("rename_columns", "SELECT n_nationkey AS nationkey, n_name AS name, n_regionkey AS regionkey FROM nation")
def rename_columns(spark, sf):
    n = T(spark, sf, "nation")
    return n.withColumnsRenamed({c: c[2:] for c in n.columns}).withColumnRenamed("nationkey", "nationkey")


@query("filter_all", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity >= 30 AND l_discount < 0.05""")
def filter_all(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.filter(R.and_all(["l_returnflag = 'R'", "l_quantity >= 30", "l_discount < 0.05"])) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_compound", """SELECT event_id FROM events
    WHERE (event_type = 'click' AND value >= 200) OR (event_type = 'error' AND value < 5)""")
def filter_compound(spark, sf):
    e = T(spark, sf, "events")
    return e.filter(((F.col("event_type") == "click") & (F.col("value") >= 200))
                    | ((F.col("event_type") == "error") & (F.col("value") < 5))).select("event_id")


# The six thresholds of the labelling rules (≥ 6.5, < 2.5, < 7,
# < 120, ≥ 160, ≥ 130), applied to event values per event type.
THRESHOLDS = [("click", ">=", 6.5), ("view", "<", 2.5), ("signup", "<", 7.0),
              ("error", "<", 120.0), ("purchase", ">=", 160.0), ("click", ">=", 130.0)]


def _thr_sql():
    return " UNION ALL ".join(
        f"SELECT '{t}{op}{v}' AS rule, count(*) AS n FROM events WHERE event_type = '{t}' AND value {op} {v}"
        for t, op, v in THRESHOLDS)


@query("filter_threshold", _thr_sql())
def filter_threshold(spark, sf):
    e = T(spark, sf, "events")
    parts = [e.filter((F.col("event_type") == t) & F.expr(f"value {op} {v}"))
             .agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{t}{op}{v}").alias("rule"), "n")
             for t, op, v in THRESHOLDS]
    return R.union_all(parts)


@query("filter_null", """SELECT d.doc_id, l.quality IS NULL AS unlabeled FROM documents d
    LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.toxic IS NOT NULL""")
def filter_null(spark, sf):
    d, lab = T(spark, sf, "documents"), T(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.filter(F.col("quality").isNull() | F.col("toxic").isNotNull()) \
        .select("doc_id", F.col("quality").isNull().alias("unlabeled"))


_SETTING = """CASE WHEN event_type = 'error' THEN 'NaN'::DOUBLE WHEN event_type = 'view' AND value > 300 THEN 'inf'::DOUBLE
    WHEN event_type = 'signup' AND value > 300 THEN NULL ELSE value END"""


@query("filter_finite", f"""SELECT event_type, count(*) AS n, round(sum(s), 6) AS total FROM
    (SELECT event_type, {_SETTING} AS s FROM events) WHERE NOT isnan(s) AND abs(s) < 'inf'::DOUBLE GROUP BY event_type""")
def filter_finite(spark, sf):
    e = T(spark, sf, "events")
    s = (F.when(F.col("event_type") == "error", F.lit(float("nan")))
         .when((F.col("event_type") == "view") & (F.col("value") > 300), F.lit(float("inf")))
         .when((F.col("event_type") == "signup") & (F.col("value") > 300), F.lit(None).cast("double"))
         .otherwise(F.col("value")))
    return (e.select("event_type", s.alias("s")).filter(S.finite("s"))
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("s"), 6).alias("total")))


@query("filter_in", """SELECT 'in' AS side, count(*) AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
    UNION ALL SELECT 'not_in', count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def filter_in(spark, sf):
    c = T(spark, sf, "customer")
    keep = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    a = c.filter(keep).agg(F.count(F.lit(1)).alias("n")).select(F.lit("in").alias("side"), "n")
    b = c.filter(~keep).agg(F.count(F.lit(1)).alias("n")).select(F.lit("not_in").alias("side"), "n")
    return a.unionByName(b)


@query("filter_status_complement", """SELECT 'converted' AS part, count(*) AS n FROM documents d LEFT JOIN labels l
        ON d.doc_id = l.doc_id WHERE l.quality = 1
    UNION ALL SELECT 'unconverted', count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE NOT (l.quality = 1)
    UNION ALL SELECT 'all', count(*) FROM documents""")
def filter_status_complement(spark, sf):
    """``==`` and ``~(==)`` both drop null status: unlabelled documents land in
    neither part (S4)."""
    j = T(spark, sf, "documents").join(T(spark, sf, "labels"), "doc_id", "left")
    ok = F.col("quality") == 1
    cnt = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return R.union_all([cnt(j.filter(ok), "converted"), cnt(j.filter(~ok), "unconverted"),
                        cnt(T(spark, sf, "documents"), "all")])


@query("filter_case_insensitive", "SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = 'building'")
def filter_case_insensitive(spark, sf):
    return T(spark, sf, "customer").filter(F.lower("c_mktsegment") == "building").select("c_custkey")


@query("filter_duration", sql("""SELECT stay_id FROM stays
    WHERE end_time - start_time >= INTERVAL 1 DAY"""))
def filter_duration(spark, sf):
    st = D(spark, sf).stays()
    return st.filter(F.col("end_time") - F.col("start_time") >= F.expr("INTERVAL 1 DAY")).select("stay_id")


@query("case_map", """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN
        CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'O' THEN 'No' ELSE NULL END
    ELSE o_orderstatus END AS status FROM orders""")
def case_map(spark, sf):
    o = T(spark, sf, "orders")
    inner = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "No")
    return o.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", inner)
                    .otherwise(F.col("o_orderstatus")).alias("status"))


# Site labels recognised in names, checked in this order.
SITE_LABELS = ["ucmc", "nu", "mimic", "all"]


@query("case_extract_site", """SELECT p_partkey, CASE
        WHEN contains(lower(p_name), 'ucmc') THEN 'UCMC' WHEN contains(lower(p_name), 'nu') THEN 'NU'
        WHEN contains(lower(p_name), 'mimic') THEN 'MIMIC' WHEN contains(lower(p_name), 'all') THEN 'ALL'
        ELSE upper(split_part(p_name, ' ', -1)) END AS label FROM part""")
def case_extract_site(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", S.site_label("p_name", SITE_LABELS, suffix_sep=" ").alias("label"))


@query("sort_table", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def sort_table(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey")


@query("round_shard_contiguous", "SELECT vec_id, CAST(ntile(4) OVER (ORDER BY vec_id) AS BIGINT) AS shard FROM embeddings")
def round_shard_contiguous(spark, sf):
    """Four stretches of the ordered table."""
    e = T(spark, sf, "embeddings").select("vec_id")
    return R.contiguous_shards(e, "vec_id", 4).withColumn("shard", F.col("shard").cast("long"))


@query("round_shard", f"""SELECT vec_id, CAST(floor({hash_unit_sql('vec_id', 0)} * 4) AS BIGINT) + 1 AS shard
    FROM embeddings""")
def round_shard(spark, sf):
    e = T(spark, sf, "embeddings").select("vec_id")
    parts = [R.round_shard(e, "vec_id", r, 4).withColumn("shard", F.lit(r).cast("long")) for r in range(1, 5)]
    return R.union_all(parts)


@query("truncate_sequence", """SELECT doc_id, len(w) AS n_words,
        len(w[1:4096]) AS n_head, CASE WHEN len(w) > 4096 THEN len(w[-4096:]) ELSE len(w) END AS n_tail,
        w[1] AS first_word, CASE WHEN len(w) > 4096 THEN w[-4096] ELSE w[1] END AS tail_first
    FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""")
def truncate_sequence(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", F.split("text", " ", -1).alias("w"))
    head, tail = S.list_slice("w", 4096), S.list_tail("w", 4096)
    return d.select("doc_id", F.array_size("w").cast("long").alias("n_words"),
                    F.array_size(head).cast("long").alias("n_head"),
                    F.array_size(tail).cast("long").alias("n_tail"),
                    S.list_first("w").alias("first_word"), F.element_at(tail, 1).alias("tail_first"))


# ---------------------------------------------------------------- scalar
@query("f_lower", "SELECT c_custkey, lower(c_name) AS name, lower(c_mktsegment) AS seg FROM customer")
def f_lower(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", F.lower("c_name").alias("name"),
                                           F.lower("c_mktsegment").alias("seg"))


@query("f_fill", """SELECT d.doc_id, coalesce(l.quality, 0) AS quality,
    CASE WHEN isnan(x) THEN 0.0 ELSE x END AS x FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id,
    LATERAL (SELECT CASE WHEN l.toxic = 1 THEN 'NaN'::DOUBLE ELSE CAST(d.n_chars AS DOUBLE) END AS x)""")
def f_fill(spark, sf):
    j = T(spark, sf, "documents").join(T(spark, sf, "labels"), "doc_id", "left")
    x = F.when(F.col("toxic") == 1, F.lit(float("nan"))).otherwise(F.col("n_chars").cast("double"))
    return j.select("doc_id", F.coalesce("quality", F.lit(0)).alias("quality"),
                    F.nanvl(x, F.lit(0.0)).alias("x"))


@query("f_bool_int", "SELECT doc_id, CAST(quality = 1 AS INTEGER) AS q, CAST(toxic = 1 AS INTEGER) AS t FROM labels")
def f_bool_int(spark, sf):
    lab = T(spark, sf, "labels")
    return lab.select("doc_id", S.bool_int(F.col("quality") == 1).alias("q"),
                      S.bool_int(F.col("toxic") == 1).alias("t"))


@query("f_concat_cast", """SELECT event_id, 'cv-' || CAST(CAST(floor(value / 100) AS BIGINT) AS VARCHAR) AS code,
    'v-' || CAST(round(value) AS VARCHAR) AS vcode FROM events""")
def f_concat_cast(spark, sf):
    e = T(spark, sf, "events")
    return e.select("event_id", S.concat_cast("cv-", F.floor(F.col("value") / 100).cast("long")).alias("code"),
                    S.concat_cast("v-", F.round("value")).alias("vcode"))


@query("f_cosine_rate", """SELECT r, round(0.1 * 0.5 * (1 + cos(pi() * (r - 1) / 10)), 9) AS lr
    FROM (SELECT DISTINCT label + 1 AS r FROM embeddings)""")
def f_cosine_rate(spark, sf):
    r = T(spark, sf, "embeddings").select((F.col("label") + 1).alias("r")).distinct()
    return r.select("r", r9(S.cosine_rate(F.lit(0.1), F.col("r"), F.lit(10))).alias("lr"))
