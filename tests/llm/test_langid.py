import math
from collections import Counter

from pyspark.sql import functions as F

from timeloom.llm import langid
from timeloom.llm.queries import QUERIES


def brute_counts(rows):
    """{lang: {order: Counter of (context, byte)}} over whole texts."""
    out = {}
    for lang, text in rows:
        if lang is not None and text is not None:
            b = b"\0\0\0" + text.lower().encode()
            for i in range(3, len(b)):
                for o in range(4):
                    out.setdefault(lang, {k: Counter() for k in range(4)})[o][b[i - o:i], b[i]] += 1
    return out


def brute_bits(counts, text):
    b, bits = b"\0\0\0" + text.lower().encode(), 0.0
    after = {o: {} for o in range(4)}
    for o in range(4):
        for (ctx, s), n in counts[o].items():
            after[o].setdefault(ctx, {})[s] = n
    for i in range(3, len(b)):
        for o in range(3, -1, -1):
            if (seen := after[o].get(b[i - o:i])) is not None:
                whole = sum(seen.values()) + len(seen)
                if b[i] in seen:
                    bits -= math.log2(seen[b[i]] / whole)
                    break
                bits -= math.log2(len(seen) / whole)
        else:
            bits += 8
    return bits


def test_code_lengths_against_brute_force(spark, docs):
    rows = [(r.lang, r.text) for r in docs.collect()]
    want = brute_counts([(a, None if t is None else t[:100_000]) for a, t in rows])
    trees = langid.Trees(langid.train(docs))
    assert trees.langs == sorted(want)
    probe = ["", "alpha beta", "Unseen ζ bytes \x00\x01 zzz", "ß", "x y z " * 50]
    got = trees.lengths([t.lower().encode() for t in probe])
    for line, lang in zip(got, trees.langs, strict=True):
        for bits, text in zip(line, probe, strict=True):
            assert abs(bits - brute_bits(want[lang], text)) < 1e-6


def test_undecided_texts_and_no_languages(docs, no_docs):
    out = langid.predict(docs, langid.train(docs)).collect()
    texts = docs.collect()
    assert len(out) == len(texts) and all(0 <= r.score <= 1 for r in out)
    letterless = sum(1 for r in texts if not any(map(str.isalpha, r.text or "")))
    assert sum(r.lang_pred == "und" for r in out) == letterless
    assert {r.lang_pred for r in langid.predict(docs, langid.train(no_docs)).collect()} == {"und"}
    assert langid.predict(no_docs, {}).count() == 0


def test_trees_are_cut_to_their_bound(docs):
    small = langid.train(docs, nodes=80)
    assert all(len(keys) <= 80 // (len(small) * 4) for orders in small.values() for keys, _ in orders)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("i"), "lang")
    got = QUERIES["op7_langid"](spark, sf).where("held_out").join(docs, F.col("doc_id") == F.col("i")).collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
