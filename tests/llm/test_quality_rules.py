import math
import re
from collections import Counter

from pyspark.sql import functions as F

from timeloom.llm import rules


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def brute_ratios(spark, rows, trusted):
    """Ratio per row, from plain counting over hashes that Spark gives."""
    grams = {g for _, t in rows for w in [re.findall(r"[^\x20\x09-\x0D]+", t or "")] for g in [(x,) for x in w] + list(zip(w, w[1:]))}
    one = spark.createDataFrame([(g[0], g[1] if len(g) > 1 else None) for g in grams], "a string, b string")
    h = F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b"))
    cell = {(r.a,) if r.b is None else (r.a, r.b): r.c for r in one.select("a", "b", F.pmod(h, F.lit(rules.BUCKETS)).alias("c")).collect()}
    raw, target = Counter(), Counter()
    cells = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        cells.append([cell[g] for g in [(x,) for x in w] + list(zip(w, w[1:]))])
        raw.update(cells[-1])
        if i in trusted:
            target.update(cells[-1])
    nr, nt = sum(raw.values()) + rules.BUCKETS, sum(target.values()) + rules.BUCKETS
    return [sum(math.log((target[c] + 1) / nt) - math.log((raw[c] + 1) / nr) for c in cs) / len(cs) if cs else 0.0 for cs in cells]


def test_documents_against_brute_force(spark, docs):
    trusted = spark.createDataFrame([(5,), (5,), (8,), (None,), (99_999,)], "doc_id long")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted([(i, *brute_counts(t), round(x, 9), not brute_counts(t)[-1] and x >= rules.THRESHOLD)
                   for (i, t), x in zip(rows, brute_ratios(spark, rows, {5, 8}), strict=True)], key=repr)
    got = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, round(r.ratio, 9), r.kept)
                  for r in rules.judge(docs, trusted).collect()], key=repr)
    assert [g[:7] + g[8:] for g in got] == [w[:7] + w[8:] for w in want]
    assert all(abs(g[7] - w[7]) < 1e-6 for g, w in zip(got, want, strict=True))


def test_target_covers_every_trusted_document(spark):
    """More trusted ids than any sample of 20,000, a hot id and rows without
    id: every trusted row counts, and no other."""
    docs = spark.range(30_000).select("id", F.concat(F.lit("w"), F.col("id") % 7).alias("text"))
    docs = docs.unionByName(spark.range(500).select(F.lit(3).cast("long").alias("id"), F.lit("hot").alias("text")))
    docs = docs.unionByName(spark.range(40).select(F.lit(None).cast("long").alias("id"), F.lit("nobody").alias("text")))
    counts = rules.cell_counts(docs, spark.range(25_000).select(F.col("id").alias("_id")), "id", "text").collect()
    assert sum(r.raw for r in counts) == 30_540 and sum(r.target for r in counts) == 25_500
    cell = spark.range(1).select(F.pmod(F.xxhash64(F.lit("nobody")), F.lit(rules.BUCKETS)).alias("c")).first().c
    assert [r.target for r in counts if r.cell == cell] == [0]
    # judged as the contract says: mean log ratio over all 25,500 trusted rows
    got = rules.judge(docs, spark.range(25_000), "id").where("id = 29999").first().ratio
    trusted = sum(1 for i in range(25_000) if i % 7 == 29_999 % 7)
    whole = sum(1 for i in range(30_000) if i % 7 == 29_999 % 7)
    want = math.log((trusted + 1) / (25_500 + rules.BUCKETS)) - math.log((whole + 1) / (30_540 + rules.BUCKETS))
    assert abs(got - want) < 1e-9


def test_no_trusted_documents_and_empty_table(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long")
    assert {r.ratio for r in rules.judge(docs, none).collect()} == {0.0}
    assert rules.judge(no_docs, none).count() == 0


def test_verdict_tells_junk_from_prose(spark):
    from timeloom.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op4_quality_rules"](spark, sf).collect()}
    marks = [(r.quality, got[r.doc_id]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if not got[r.doc_id].base_failed]
    good, bad = [g.kept for q, g in marks if q == 1], [g.kept for q, g in marks if q == 0]
    assert all(good) and sum(bad) <= 0.2 * len(bad)
