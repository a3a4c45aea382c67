"""Collation: wide source tables → one long event table, from a declared list
of entries (the YAML entries of the source, as dataclasses).

Expressions in entries are Spark SQL text (``F.expr``); nothing is ``eval``-ed.
Plain entries over the same table are fused into one scan: each row becomes
an array of the events it yields (``filter(array(…))``) and is exploded.
First-occurrence (aggregated) entries on one table share one scan and one
``groupBy``."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.functions.scalar import hash_unit
from timeloom.operators.relational import and_all, checked_join

__all__ = ["Entry", "Reference", "EVENT_COLUMNS", "reference_frame", "collate_entry",
           "collate", "subject_split", "pass_through", "SPLITS"]

EVENT_COLUMNS = ["site", "group_id", "subject_id", "time", "prefix", "code", "numeric_value",
                 "text_value", "event_id"]


@dataclass
class Entry:
    """One collation entry. ``code``/``time``/``numeric_value``/``text_value``
    name columns (after ``with_col_expr``); ``filter_expr`` is SQL text or a
    list AND-ed; ``with_col_expr`` maps a new column name to SQL text;
    ``agg_expr`` switches to one row per subject: ``"first"`` means first
    occurrence (code of the earliest row, min time), or give SQL aggregates.
    ``reference_key``: the table is keyed by group and fans out to every
    subject of the group through the reference frame."""
    table: str
    prefix: str
    code: str
    time: str
    numeric_value: str | None = None
    text_value: str | None = None
    filter_expr: str | list | None = None
    with_col_expr: dict | None = None
    agg_expr: str | list | None = None
    reference_key: str | None = None
    event_id: str | None = None


@dataclass
class Reference:
    """The subject table: one row per subject with start/end times, joined
    m:1 to augmentation tables."""
    table: str
    subject_id: str
    group_id: str
    start_time: str
    end_time: str
    augment: list = field(default_factory=list)  # (table, key)


def _as_list(x):
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def reference_frame(tables: dict, ref: Reference, validate: bool = True) -> DataFrame:
    """Reference rows left-joined m:1 to each augmentation table; the m:1
    promise is checked, and the join keeps every reference row."""
    df = tables[ref.table]
    for name, key in ref.augment:
        other = tables[name]
        keep = [c for c in other.columns if c == key or c not in df.columns]
        df = checked_join(df, other.select(*keep), key, "left", "m:1" if validate else None, in_plan=True)
    return df


def _c(e: Entry, name: str) -> Column:
    """A column of the entry: one defined by ``with_col_expr`` or a source
    column. Resolving per entry lets entries on one table share a scan."""
    w = e.with_col_expr or {}
    return F.expr(w[name]) if name in w else F.col(name)


def _cond(e: Entry) -> Column:
    return and_all(_as_list(e.filter_expr)) if e.filter_expr else F.lit(True)


def _event_struct(e: Entry) -> Column:
    num = _c(e, e.numeric_value).cast("double") if e.numeric_value else F.lit(None).cast("double")
    txt = _c(e, e.text_value).cast("string") if e.text_value else F.lit(None).cast("string")
    eid = _c(e, e.event_id).cast("long") if e.event_id else F.lit(None).cast("long")
    return F.struct(_c(e, e.time).alias("time"), F.lit(e.prefix).alias("prefix"),
                    _c(e, e.code).cast("string").alias("code"), num.alias("numeric_value"),
                    txt.alias("text_value"), eid.alias("event_id"))


def _with_subjects(df: DataFrame, e: Entry, ref_df: DataFrame, ref: Reference) -> DataFrame:
    """Rows keyed by group only fan out to every subject of the group."""
    if e.reference_key:
        subj = ref_df.select(F.col(ref.group_id).alias(e.reference_key), ref.subject_id, "site",
                             *[c for c in [ref.start_time] if c not in df.columns])
        return df.join(subj, e.reference_key).withColumn(ref.group_id, F.col(e.reference_key))
    return df


def collate_entry(tables: dict, ref_df: DataFrame, ref: Reference, e: Entry) -> DataFrame:
    """One entry → events (EVENT_COLUMNS)."""
    return collate(tables, ref_df, ref, [e])


def _plain_group(df: DataFrame, entries, ref: Reference) -> DataFrame:
    """Several plain entries over one table in one pass."""
    items = [F.when(_cond(e), _event_struct(e)) for e in entries]
    arr = F.filter(F.array(*items), lambda x: x.isNotNull())
    return (df.select("site", F.col(ref.group_id).alias("group_id"),
                      F.col(ref.subject_id).alias("subject_id"), F.explode(arr).alias("ev"))
            .select("site", "group_id", "subject_id", "ev.*"))


def _first_group(df: DataFrame, entries, ref: Reference) -> DataFrame:
    """First-occurrence entries over one table: one scan, one group-by on
    (site, subject, prefix, code). The code is one literal per entry, so the
    earliest row's code is that literal; time is the minimum (a subject whose
    times are all null keeps its code with a null time)."""
    items = [F.when(_cond(e), F.struct(_c(e, e.time).alias("time"), F.lit(e.prefix).alias("prefix"),
                                       _c(e, e.code).cast("string").alias("code")))
             for e in entries]
    arr = F.filter(F.array(*items), lambda x: x.isNotNull())
    ex = (df.select("site", F.col(ref.group_id).alias("group_id"),
                    F.col(ref.subject_id).alias("subject_id"), F.explode(arr).alias("ev"))
          .select("site", "group_id", "subject_id", "ev.*"))
    return (ex.groupBy("site", "group_id", "subject_id", "prefix", "code")
            .agg(F.min("time").alias("time"))
            .withColumns({"numeric_value": F.lit(None).cast("double"),
                          "text_value": F.lit(None).cast("string"),
                          "event_id": F.lit(None).cast("long")}))


def _custom_agg(df: DataFrame, e: Entry, ref: Reference) -> DataFrame:
    """An entry with its own SQL aggregates, e.g. ``["max(v) AS v", "min(t) AS t"]``."""
    for name, sql in (e.with_col_expr or {}).items():
        df = df.withColumn(name, F.expr(sql))
    if e.filter_expr:
        df = df.filter(and_all(_as_list(e.filter_expr)))
    aggs = [F.expr(a) for a in _as_list(e.agg_expr)]
    g = df.groupBy("site", ref.group_id, ref.subject_id).agg(*aggs)
    plain = Entry(**{**e.__dict__, "filter_expr": None, "with_col_expr": None, "agg_expr": None})
    return _plain_group(g, [plain], ref)


def collate(tables: dict, ref_df: DataFrame, ref: Reference, entries) -> DataFrame:
    """All entries stacked into one long event table (EVENT_COLUMNS).

    ``tables`` must carry ``site`` and the subject key (or, for entries with
    ``reference_key``, the group key). ``REFERENCE`` names the reference frame."""
    parts = []
    by_table: dict = {}
    for e in entries:
        kind = "plain" if e.agg_expr is None else ("first" if e.agg_expr == "first" else "custom")
        by_table.setdefault((e.table, e.reference_key, kind), []).append(e)
    for (table, rkey, kind), es in by_table.items():
        src = ref_df if table == "REFERENCE" else tables[table]
        src = _with_subjects(src, es[0], ref_df, ref)
        if kind == "plain":
            parts.append(_plain_group(src, es, ref))
        elif kind == "first":
            parts.append(_first_group(src, es, ref))
        else:
            parts.extend(_custom_agg(src, e, ref) for e in es)
    out = reduce(lambda a, b: a.unionByName(b), [p.select(*EVENT_COLUMNS) for p in parts])
    return out


# Split shares (train 0.7, tuning 0.1, rest held-out).
SPLITS = (("train", 0.7), ("tuning", 0.1))


def subject_split(df: DataFrame, group: str, seed: int = 7, splits=SPLITS,
                  out: str = "split") -> DataFrame:
    """Split label from a hash of the *group* id (ours), so every subject of a
    group lands in the same split. Stateless: no shuffle, no driver state."""
    u = hash_unit(group, seed)
    expr, lo = None, 0.0
    for name, share in splits:
        hi = round(lo + share, 12)
        cond = u < F.lit(hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
        lo = hi
    return df.withColumn(out, expr.otherwise(F.lit("held_out")))


def pass_through(rows: DataFrame, ref_df: DataFrame, key: str, columns) -> DataFrame:
    """Copy reference columns onto split / inference rows (m:1 on the key)."""
    return rows.join(ref_df.select(key, *columns), key, "left")
