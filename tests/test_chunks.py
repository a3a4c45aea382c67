"""Chunked timelines, split scans and in-plan checks against one-window forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from timeloom.operators import harmonize, tokenize as tkz, winnow
from timeloom.operators.relational import checked_join, contiguous_shards, split_table_parts, unique_rows

KEYS = ["site", "subject_id"]


@pytest.fixture(scope="module")
def events(spark):
    """One subject holds a third of the events, over many days and within one;
    gaps of all sizes, equal times, null times and a null site."""
    rnd, rows, t0 = random.Random(7), [], dt.datetime(2024, 1, 1)
    for i in range(900):
        who = ("A", 1) if i % 3 == 0 else (None if i % 7 == 0 else "B", rnd.randrange(2, 9))
        t = None if i % 97 == 0 else t0 + dt.timedelta(minutes=rnd.choice([0, 3, 7, 200, 3000]) * rnd.randrange(40))
        rows.append((*who, t, rnd.choice(["LAB-RES", "MED-CTS", "ZZZ"]), f"t{rnd.randrange(30)}_{i}", i))
    df = spark.createDataFrame(rows, "site string, subject_id int, time timestamp, prefix string, token string, event_id long")
    return df.withColumn("time", F.col("time").cast("timestamp_ntz")).repartition(5)


def whole(events):
    return Window.partitionBy(*KEYS).orderBy("time", tkz.prefix_rank("prefix"), "token")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("chunk", [None, "HOUR", "YEAR"])
def test_order_spacers_and_arrays(events, chunk):
    at = None if chunk is None else F.date_trunc(chunk, "time")
    got = tkz.event_order(events, chunk=at).select(*KEYS, "event_id", F.col("pos").cast("int"))
    assert rows(got) == rows(events.select(*KEYS, "event_id", F.row_number().over(whole(events)).alias("pos")))
    base = events.select(*KEYS, "time", "prefix", "token")
    gap = (tkz.micros("time") - F.lag(tkz.micros("time")).over(whole(events))) / 60_000_000.0
    label = F.lit(None).cast("string")
    for name, lo in tkz.SPACERS:
        label = F.when(gap >= lo, F.lit(f"TIME//{name}")).otherwise(label)
    want = base.select(*KEYS, "time", label.alias("token")).where("token is not null")
    assert rows(tkz.gap_spacers(base, chunk=at).where("prefix = 'TIME'").select(*KEYS, "time", "token")) == rows(want)
    s = F.struct(F.col("time").alias("t"), tkz.prefix_rank("prefix").alias("r"), F.col("token").alias("k"))
    one = events.groupBy(*KEYS).agg(F.array_sort(F.collect_list(s)).alias("e")).select(*KEYS, F.transform("e", lambda x: x["k"]).alias("tokens"),
                                                                                       F.transform("e", lambda x: x["t"]).alias("times"))
    assert rows(tkz.timeline_build(events, chunk=at)) == rows(one)


def test_chunks_spread_a_subject(events):
    chunks = tkz.timeline_chunks(events, ["token"], keys=KEYS, chunk=F.date_trunc("HOUR", "time"))
    assert chunks.where("subject_id = 1").count() > 20
    assert chunks.agg(F.max(F.size("token"))).first()[0] < 150


def test_winnow_without_windows(events):
    w = Window.partitionBy(*KEYS)
    want = events.withColumn("past", F.col("time") <= F.min("time").over(w) + F.expr("INTERVAL 1 DAY"))
    got = winnow.winnow_duration(events)
    assert rows(got.select(want.columns)) == rows(want)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    cut = F.min(F.when(F.col("token").startswith("t3_"), F.col("time"))).over(w)
    marked = events.withColumn("token", F.when(F.col("token").startswith("t3_"), F.lit("stop")).otherwise(F.col("token")))
    want = events.withColumn("past", cut.isNull() | (F.col("time") <= cut)).select(*KEYS, "event_id", "past")
    assert rows(winnow.winnow_first_occurrence(marked, "stop").select(*KEYS, "event_id", "past")) == rows(want)


def test_decode_by_stretches(spark, monkeypatch):
    monkeypatch.setattr(tkz, "DECODE_ROWS", 3)
    vocab = spark.createDataFrame([(f"w{i}", i) for i in range(20)], "token string, token_id int")
    tl = spark.createDataFrame([("A", 1, [i % 20 for i in range(17)]), (None, 2, []), ("B", 3, [4, None])], "site string, subject_id int, tokens array<int>")
    got = {r.subject_id: r.tokens for r in tkz.timeline_decode(tl, vocab).collect()}
    assert got[1] == [f"w{i % 20}" for i in range(17)] and got[2] == [] and got[3] == ["w4", None]


def test_blocks_of_a_hot_patient(spark):
    rnd, t0 = random.Random(1), dt.datetime(2020, 1, 1)
    stays = []
    for i in range(600):
        start = t0 + dt.timedelta(hours=rnd.randrange(20_000))
        stays.append((1 if i % 2 else rnd.randrange(2, 20), i, None if i % 90 == 0 else start,
                      None if i % 50 == 0 else start + dt.timedelta(hours=rnd.choice([1, 30, 2000]))))
    df = spark.createDataFrame(stays, "p int, stay_id int, s timestamp, e timestamp")
    w = Window.partitionBy("p").orderBy(F.col("s").asc_nulls_first(), "stay_id")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = df.withColumn("n", F.when(before.isNull() | (F.col("s") > before + F.expr("INTERVAL 6 HOURS")), 1).otherwise(0))
    want = {r.stay_id: r.b for r in new.withColumn("b", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))).collect()}
    for bucket in (None, F.date_trunc("DAY", "s"), F.date_trunc("YEAR", "s")):
        got = {r.stay_id: r.encounter_block for r in harmonize.encounter_block(df, "p", "s", "e", bucket=bucket).collect()}
        assert got == want


def test_checks_inside_the_plan(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    dup = a.unionByName(spark.createDataFrame([(2, "w")], "k int, v string"))
    assert rows(unique_rows(a, "k")) == rows(a)
    bad = checked_join(a, dup.withColumnRenamed("v", "u"), "k", "left", "m:1", in_plan=True)  # no job yet
    with pytest.raises(Exception, match="not unique"):
        bad.collect()
    with pytest.raises(Exception, match="not unique"):
        unique_rows(dup, "k").select("k").collect()


def test_parts_and_stretches(spark):
    df = spark.range(12).select((F.col("id") * 5 % 12).alias("k"))
    assert rows(split_table_parts(df, "k", 4)) == rows(df.withColumn("part", F.ntile(4).over(Window.orderBy("k"))))
    with pytest.raises(Exception, match="do not split"):
        split_table_parts(df, "k", 5).collect()
    assert rows(contiguous_shards(df, "k", 5)) == rows(df.withColumn("shard", F.ntile(5).over(Window.orderBy("k"))))


def test_vocabulary_without_one_task(spark):
    tok = spark.range(300).select(F.concat(F.lit("t"), F.col("id") % 40).alias("token"))
    v = {r.token: r.token_id for r in tkz.vocab_fit(tok).collect()}
    assert v == {"UNK": 0} | {t: i + 1 for i, t in enumerate(sorted(f"t{i}" for i in range(40)))}
