import re

import numpy as np
import pytest

from timeloom.llm import mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while left > 1e-9 and free:
        w = sum(weight[s] for s in free)
        share, left = left, 0.0
        for s in sorted(free, key=repr):
            target[s] += share * weight[s] / w
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                free.discard(s)
    return target


def test_documents(docs):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = [(r.doc_id, r.source, count(r.text)) for r in docs.collect()]
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = brute_targets(sizes)
    placed, taken = mixing.mix(docs)
    got = mixing.taken_per_document(placed, taken).collect()
    assert sorted(((r.doc_id, r.source, r["size"]) for r in got), key=repr) == sorted(rows, key=repr)
    by = {}
    for r in got:
        assert r.taken <= 2 * r["size"] and r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        by[r.source] = by.get(r.source, 0) + r.taken
    assert all(abs(by[s] - want[s]) <= 0.5 for s in sizes)
    again = mixing.taken_per_document(*mixing.mix(docs)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_passes_take_no_word_twice(docs):
    placed, taken = mixing.mix(docs)
    total = sum(r.words for r in taken.collect())
    seen = 0
    for r in mixing.passes(placed, taken).collect():
        words = [k for s in r.spans for k in range(s["at"], s["at"] + s["words"])]
        assert len(words) == len(set(words)) and words == sorted(words) and max(words) < r["size"]
        seen += len(words)
    assert seen == total


def test_cut_words(spark):
    df = spark.createDataFrame([(" a b\nc\td e ",)], "text string")
    out = df.selectExpr("text", "array(named_struct('at', 0L, 'words', 2L), named_struct('at', 3L, 'words', 2L)) AS spans")
    assert out.select(mixing.cut_words(out["text"], out["spans"])).first()[0] == "a b d e"


def test_permutations():
    for n in (1, 2, 3, 17, 1000):
        image = mixing.permute(np.arange(n), n, 99)
        assert sorted(image) == list(range(n))
        assert (mixing.permute(image, n, 99, forward=False) == np.arange(n)).all()


def test_empty_table(no_docs):
    placed, taken = mixing.mix(no_docs)
    assert mixing.taken_per_document(placed, taken).count() == 0 and taken.count() == 0
