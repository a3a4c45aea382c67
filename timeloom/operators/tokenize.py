"""Events (long form) → tokens → timelines.

Long event schema used throughout:
    site, subject_id, time, prefix, code, numeric_value (double, nullable),
    text_value (string, nullable), event_id (long, nullable tie-break)

Definitions marked (ours) are not visible in the source and are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions.scalar import micros
from timeloom.operators.numbering import number_rows
from timeloom.operators.order_stats import exact_quantiles, merge_sketches, numbers, sketch_quantiles
from timeloom.operators.scans import null_safe_join
from timeloom.operators.sizing import Fitted

__all__ = [
    "DEFAULT_ORDERING", "SPACERS", "CLOCKS", "quantile_fit", "quantile_fit_sketch", "quantile_apply",
    "token_build", "vocab_fit", "vocab_apply", "prefix_rank", "add_bounds",
    "event_order", "timeline_chunks", "join_chunks", "timeline_build", "gap_spacers", "clock_tokens", "time_positions",
    "timeline_decode", "UNK",
]

UNK = "UNK"
#: Tokens of a timeline that one group decodes.
DECODE_ROWS = 10_000
#: Tokens of a vocabulary that may stand in a plan.
LITERAL_ROWS = 4096

# Order of prefixes for events at the same time (BOS first,
# EOS last), as in the tokenization config.
DEFAULT_ORDERING = [
    "BOS", "TIME", "CLCK", "AGE", "SEX", "RACE", "ETHN", "ADMN", "XFR-OUT",
    "XFR-IN", "MED-CTS", "MED-INT", "LAB-ORD", "LAB-RES", "CODE", "VTL", "ASMT",
    "RESP", "POSN", "CRRT", "SOFA", "DSCG", "LABEL", "EOS",
]

# Gap spacer tokens, name → lower bound in minutes.
SPACERS = [
    ("5m-15m", 5), ("15m-1h", 15), ("1h-2h", 60), ("2h-6h", 120),
    ("6h-12h", 360), ("12h-1d", 720), ("1d-3d", 1440), ("3d-1w", 4320),
    ("1w-2w", 10080), ("2w-1mt", 20160), ("1mt-3mt", 43200),
    ("3mt-6mt", 131490), ("6mt+", 262980),
]

# Clock tokens, hours of the day.
CLOCKS = ["00", "04", "08", "12", "16", "20"]


def _probs(n_bins: int):
    return [i / n_bins for i in range(1, n_bins)]


def quantile_fit(events: DataFrame, n_bins: int = 10, by=("prefix", "code"),
                 value: str = "numeric_value", exact: bool = True,
                 accuracy: int = 100_000, materialize: bool = False):
    """Break points per (prefix, code): the n_bins−1 inner quantiles.

    ``exact`` finds the ranks by rounds of narrowing (linear interpolation,
    the same as ``quantile_cont``). ``exact=False`` uses ``percentile_approx``
    (bounded memory per group, one pass). ``quantile_fit_sketch`` reads the
    breaks from stored sketches instead."""
    if exact:
        df = exact_quantiles(events, by, value, _probs(n_bins)).drop("n")
    else:
        v = numbers(value)
        df = (events.where(v.isNotNull()).groupBy(*by)
              .agg(F.percentile_approx(v, F.array(*[F.lit(p) for p in _probs(n_bins)]), accuracy).cast("array<double>").alias("breaks")))
    return Fitted.materialize(df) if materialize else df


def quantile_fit_sketch(sketches: DataFrame, n_bins: int = 10, by=("prefix", "code"), materialize: bool = False):
    """Break points from a stored ``sketch_table``, merged to ``by``: for any
    choice of sites, without the events."""
    df = sketch_quantiles(merge_sketches(sketches, by), _probs(n_bins)).select(*by, "breaks")
    return Fitted.materialize(df) if materialize else df


def quantile_apply(events: DataFrame, breaks, by=("prefix", "code"),
                   value: str = "numeric_value", out: str = "bin") -> DataFrame:
    """bin = number of break points ≤ value (ours): 0 … n_bins−1; null when
    the event has no value or its (prefix, code) was not fitted."""
    fitted = breaks if isinstance(breaks, Fitted) else Fitted(breaks, 0)
    if not isinstance(breaks, Fitted):
        joined = events.join(breaks, list(by), "left")
    else:
        joined = fitted.join_to(events, list(by), "left")
    v = F.col(value)
    b = F.when(v.isNotNull() & F.col("breaks").isNotNull(),
               F.size(F.filter("breaks", lambda x: x <= v)))
    return joined.withColumn(out, b).drop("breaks")


def token_build(events: DataFrame, fused: bool = True, lower_code: bool = True,
                bin_col: str = "bin", out: str = "token") -> DataFrame:
    """``PREFIX//code[_Qk]``. Codes are lower-cased (S25). The non-fused
    variant emits ``PREFIX//code`` and a separate ``Qk`` token (ours), with
    ``sub`` keeping their order."""
    code = F.lower(F.col("code")) if lower_code else F.col("code")
    base = F.concat_ws("//", F.col("prefix"), code)
    has_bin = bin_col in events.columns
    if fused:
        tok = F.concat(base, F.lit("_Q"), F.col(bin_col).cast("string")) if has_bin else base
        if has_bin:
            tok = F.when(F.col(bin_col).isNotNull(), tok).otherwise(base)
        return events.withColumn(out, tok).withColumn("sub", F.lit(0))
    parts = F.array(base)
    if has_bin:
        parts = F.when(F.col(bin_col).isNotNull(),
                       F.array(base, F.concat(F.lit("Q"), F.col(bin_col).cast("string")))).otherwise(parts)
    return events.select("*", F.posexplode(parts).alias("sub", out))


def vocab_fit(tokens: DataFrame, token: str = "token", materialize: bool = False):
    """(token, token_id): ``UNK`` is 0, then every distinct token in sorted
    order from 1. Learned on one site and shared by all.

    Numbered by range partitions and their counts, so no task sees the whole
    vocabulary."""
    spark = tokens.sparkSession
    distinct = (tokens.select(F.col(token).alias("token"))
                .filter(F.col("token").isNotNull() & (F.col("token") != UNK)).distinct())
    numbered = number_rows(distinct, [], ["token"], "_n").select("token", (F.col("_n") + 1).cast("int").alias("token_id"))
    unk = spark.createDataFrame([(UNK, 0)], "token string, token_id int")
    df = unk.unionByName(numbered)
    return Fitted.materialize(df) if materialize else df


def vocab_apply(tokens: DataFrame, vocab, token: str = "token") -> DataFrame:
    """token_id for each token; unseen → the ``UNK`` id 0 (ours)."""
    v = vocab.df if isinstance(vocab, Fitted) else vocab
    v = v.withColumnRenamed("token", token)
    joined = vocab.join_to(tokens, token, "left") if isinstance(vocab, Fitted) \
        else tokens.join(v, token, "left")
    return joined.withColumn("token_id", F.coalesce(F.col("token_id"), F.lit(0)))


def prefix_rank(prefix: Column | str = "prefix", ordering=DEFAULT_ORDERING) -> Column:
    """1-based position in the ordering list; prefixes that are not listed come
    after all listed ones, but before a closing EOS."""
    p = F.col(prefix) if isinstance(prefix, str) else prefix
    pos = F.array_position(F.array(*[F.lit(x) for x in ordering]), p)
    last = F.lit(bool(ordering) and ordering[-1] == "EOS") & (p == "EOS")
    return F.when(last, F.lit(len(ordering) + 2)).when(pos == 0, F.lit(len(ordering) + 1)).otherwise(pos).cast("int")


def add_bounds(tokens: DataFrame, ref: DataFrame, start: str = "start_time",
               end: str = "end_time", keys=("site", "subject_id")) -> DataFrame:
    """Add a BOS row at the subject's start time and an EOS row at its end;
    reference columns that the token rows also have (group, split) carry over."""
    cols = tokens.columns
    carry = [c for c in ref.columns if c in cols and c not in ("time", "prefix", "token")]
    keys = list(dict.fromkeys(list(keys) + carry))
    bos = ref.select(*keys, F.col(start).alias("time")).withColumns(
        {"prefix": F.lit("BOS"), "token": F.lit("BOS")})
    eos = ref.select(*keys, F.col(end).alias("time")).withColumns(
        {"prefix": F.lit("EOS"), "token": F.lit("EOS")})
    return tokens.unionByName(bos, allowMissingColumns=True) \
        .unionByName(eos, allowMissingColumns=True).select(*cols)


def day(time: str = "time") -> Column:
    """The default chunk of a timeline: any column that grows with time (and is
    null where it is) serves."""
    return F.date_trunc("DAY", F.col(time))


def event_order(tokens: DataFrame, ordering=DEFAULT_ORDERING, keys=("site", "subject_id"), chunk: Column | None = None,
                out: str = "pos") -> DataFrame:
    """``tokens`` with ``out``, an event's place from 1 in its timeline (time,
    prefix rank, token). Places are counted inside (subject, chunk); the counts
    of a subject's earlier chunks, one row per chunk, come on top."""
    keys = list(keys)
    rows = tokens.withColumn("_chunk", day() if chunk is None else chunk)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_c")).select(
        *keys, "_chunk", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy("time", prefix_rank("prefix", ordering), "token")
    return (null_safe_join(rows.withColumn("_in", F.row_number().over(inside)), base, [*keys, "_chunk"])
            .withColumn(out, F.col("_base") + F.col("_in")).drop("_chunk", "_base", "_in"))


def _field(name: str):
    return lambda x: x[name]


def timeline_chunks(tokens: DataFrame, fields, ordering=DEFAULT_ORDERING, keys=("site", "subject_id"), tie: str = "token",
                    chunk: Column | None = None) -> DataFrame:
    """(keys…, chunk, one array per field): events sorted by (time, prefix
    rank, token text, sub-position, event id) inside each chunk of a timeline.
    ``collect_list`` has no order, so the structs carry the full sort key. A
    subject with very many events is many rows, in as many tasks."""
    sub = F.col("sub") if "sub" in tokens.columns else F.lit(0)
    eid = F.col("event_id") if "event_id" in tokens.columns else F.lit(None).cast("long")
    s = F.struct(F.col("time").alias("_t"), prefix_rank("prefix", ordering).alias("_r"), F.col(tie).cast("string").alias("_k"),
                 sub.alias("_s"), eid.alias("_e"), *[F.col(f).alias(f"v{i}") for i, f in enumerate(fields)])
    at = (day() if chunk is None else chunk).alias("chunk")
    g = tokens.groupBy(*keys, at).agg(F.array_sort(F.collect_list(s)).alias("_ev"))
    return g.select(*keys, "chunk", *[F.transform("_ev", _field(f"v{i}")).alias(f) for i, f in enumerate(fields)])


def join_chunks(chunks: DataFrame, fields, keys=("site", "subject_id"), chunk: str = "chunk") -> DataFrame:
    """(keys…, one array per field): the chunks' arrays put together in order.
    Only whole arrays move; the array of a subject is the output row itself."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(chunk).alias("_c"), *fields))).alias("_p")
    return chunks.groupBy(*keys).agg(parts).select(*keys, *[F.flatten(F.transform("_p", _field(f))).alias(f) for f in fields])


def timeline_build(tokens: DataFrame, ordering=DEFAULT_ORDERING,
                   keys=("site", "subject_id"), value: str = "token",
                   tie: str = "token", chunk: Column | None = None) -> DataFrame:
    """(keys…, tokens[], times[]) in event order, from sorted chunks. Where a
    whole array per subject is not needed, ``timeline_chunks`` is the better
    output; statistics run on the long form."""
    rows = tokens.select("*", F.col(value).alias("tokens"), F.col("time").alias("times"))
    return join_chunks(timeline_chunks(rows, ["tokens", "times"], ordering, keys, tie, chunk), ["tokens", "times"], keys)


def gap_spacers(tokens: DataFrame, keys=("site", "subject_id"), spacers=SPACERS,
                ordering=DEFAULT_ORDERING, chunk: Column | None = None) -> DataFrame:
    """A ``TIME//<range>`` row before each event that follows a gap of at least
    5 minutes; the spacer carries the later event's time. Consecutive events
    at the same time never get one. Rows get ``prefix = 'TIME'``.

    The event before is looked up inside (subject, chunk); a chunk's first
    event gets the last time of the chunk before it, handed over in a table of
    one row per chunk."""
    keys = list(keys)
    rows = tokens.select(*keys, "time", "prefix", "token", (day() if chunk is None else chunk).alias("_chunk"))
    # the last event of a chunk has its latest time: nulls come first
    last = rows.groupBy(*keys, "_chunk").agg(F.max("time").alias("_last"))
    handed = last.select(*keys, "_chunk", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_before"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy("time", prefix_rank("prefix", ordering), "token")
    rows = rows.withColumn("_lag", F.lag("time").over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    rows = null_safe_join(rows, handed, [*keys, "_chunk"])
    gap_min = (micros("time") - F.when(F.col("_first"), micros("_before")).otherwise(micros("_lag"))) / F.lit(60_000_000.0)
    label = F.lit(None).cast("string")
    for name, lo in spacers:
        label = F.when(gap_min >= lo, F.lit(f"TIME//{name}")).otherwise(label)
    sp = (rows.withColumn("_gap", label).filter(F.col("_gap").isNotNull())
          .select(*keys, "time", F.lit("TIME").alias("prefix"), F.col("_gap").alias("token")))
    return tokens.unionByName(sp, allowMissingColumns=True)


def clock_tokens(ref: DataFrame, start: str = "start_time", end: str = "end_time",
                 keys=("site", "subject_id"), hours: int = 4) -> DataFrame:
    """``CLCK//HH`` rows at every 4-hour mark inside each subject's span
    (ours: marks strictly after start and at or before end)."""
    first = F.expr(f"date_trunc('HOUR', {start}) + make_dt_interval(0, "
                   f"cast({hours} - hour({start}) % {hours} as int), 0, 0)")
    seq = F.sequence(first, F.col(end), F.expr(f"INTERVAL {hours} HOURS"))
    return (ref.filter(first <= F.col(end))
            .select(*keys, F.explode(seq).alias("time"))
            .withColumns({"prefix": F.lit("CLCK"),
                          "token": F.concat(F.lit("CLCK//"), F.date_format("time", "HH"))}))


def time_positions(timelines: DataFrame, unit_s: int = 300, times: str = "times",
                   out: str = "positions") -> DataFrame:
    """Whole ``unit_s``-second units since the first time in each timeline."""
    t0 = F.col(times)[0]
    return timelines.withColumn(out, F.transform(times, lambda t: F.floor(
        F.timestamp_diff("MICROSECOND", t0, t) / F.lit(unit_s * 1_000_000.0)).cast("int")))


def timeline_decode(timelines: DataFrame, vocab, keys=("site", "subject_id"),
                    col: str = "tokens") -> DataFrame:
    """ids → token strings, order kept. Unknown ids raise (S10); null ids stay
    null. A vocabulary of up to ``LITERAL_ROWS`` tokens goes into the plan and
    every list is decoded as a whole; a larger one is joined: posexplode →
    join → ordered re-collect, by stretches of ``DECODE_ROWS`` tokens."""
    v = vocab.df if isinstance(vocab, Fitted) else vocab
    few = [(r[0], r[1]) for r in v.select("token_id", "token").where("token_id is not null").limit(LITERAL_ROWS + 1).collect()]
    names = dict(few)
    if len(names) == len(few) <= LITERAL_ROWS and all(0 <= i < LITERAL_ROWS for i in names):
        listed = F.array(*[F.lit(names.get(i)).cast("string") for i in range(max(names, default=0) + 1)])
        text_of = lambda i: F.when(i.isNotNull(), F.coalesce(F.get(listed, i.cast("int")), F.raise_error(F.concat(
            F.lit("unknown token id "), i.cast("string")))))
        # lists of the same keys are merged by position, as below
        lists = timelines.groupBy(*keys).agg(F.collect_list(col).alias("_p")).select(*keys, F.transform("_p", lambda ids: F.transform(ids, text_of)).alias("_d"))
        at = F.flatten(F.transform("_d", lambda x: F.transform(x, lambda t, i: F.struct(i.alias("p"), t.alias("t")))))
        merged = F.transform(F.array_sort(at), lambda x: x["t"])
        return lists.select(*keys, F.when(F.size("_d") == 1, F.get("_d", F.lit(0))).otherwise(merged).alias(col))
    ex = timelines.select(*keys, F.posexplode_outer(col).alias("pos", "token_id"))
    j = ex.join(v, "token_id", "left")
    tok = F.when(F.col("token_id").isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.col("token"), F.raise_error(F.concat(
            F.lit("unknown token id "), F.col("token_id").cast("string")))))
    # stretches of a timeline first, then the stretches
    part = F.floor(F.col("pos") / DECODE_ROWS).alias("chunk")
    parts = j.groupBy(*keys, part).agg(F.array_sort(F.collect_list(
        F.when(F.col("pos").isNotNull(), F.struct(F.col("pos").alias("p"), tok.alias("t"))))).alias("_x"))
    return join_chunks(parts.select(*keys, "chunk", F.transform("_x", lambda x: x["t"]).alias(col)), [col], keys)
