"""The cross-site loss against direct computation."""

from collections import Counter
from math import log

import pytest

from timeloom.operators.sequence import bigram_counts, cross_site_loss, words

DOCS = [("a", "the cat  sat on The mat"), ("a", "the cat sat"), ("b", "the dog sat on the cat"), ("b", ""), ("b", None),
        ("c", "one"), ("c", "word"), (None, "the cat sat on it"), ("d", "x y"), ("a", "the cat  sat on The mat")]


def brute(alpha=1.0):
    grams, vocab = {}, {}
    for s, t in DOCS:
        ws = t.lower().split(" ") if t is not None else []
        if s is not None and len(ws) > 1:
            grams.setdefault(s, Counter()).update(zip(ws, ws[1:]))
            vocab.setdefault(s, set()).update(ws)
    out = {}
    for m, cm in grams.items():
        prev = Counter()
        for (p, _), c in cm.items():
            prev[p] += c
        for e, ce in grams.items():
            n = sum(ce.values())
            out[m, e] = (-sum(c * log((cm[g] + alpha) / (prev[g[0]] + alpha * len(vocab[m]))) for g, c in ce.items()) / n, n)
    return out


@pytest.mark.parametrize("alpha", [1.0, 0.5])
def test_loss_of_every_pair(spark, alpha):
    docs = spark.createDataFrame(DOCS, "lang string, text string")
    got = {(r.model_site, r.eval_site): (r.loss, r.n_bigrams) for r in cross_site_loss(docs, "lang", "text", alpha).collect()}
    want = brute(alpha)
    assert got.keys() == want.keys()
    assert all(got[k] == (pytest.approx(want[k][0]), want[k][1]) for k in want)


def test_no_sites_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), ("s", "a")], "lang string, text string")
    assert cross_site_loss(docs, "lang", "text").collect() == []
    assert cross_site_loss(docs.where("lang is null"), "lang", "text").collect() == []


def test_a_bigram_is_one_row_for_all_sites(spark):
    docs = spark.createDataFrame(DOCS, "lang string, text string").where("lang is not null")
    got = {(r.prev, r.nxt): (r.c0, r.c1) for r in bigram_counts(words(docs, "lang", "text"), ["a", "b"]).collect()}
    assert got["the", "cat"] == (3, 1) and got["x", "y"] == (0, 0) and len(got) == len({g for s, t in DOCS if s and t for g in zip(t.lower().split(" "), t.lower().split(" ")[1:])})
