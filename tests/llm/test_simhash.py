import itertools

import numpy as np
import xxhash

from timeloom.llm import simhash


def brute_print(text, shingle=3):
    words = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, radius=3):
    """rows: (id, fingerprint); smallest id reachable, per row."""
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(rows)), 2):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= radius and label[i] != label[j]:
                low = min(label[i], label[j])
                label = [low if x in (label[i], label[j]) else x for x in label]
                changed = True
    return [min((rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None), default=None) for i in range(len(rows))]


def test_documents_against_brute_force(docs):
    rows = [(r.doc_id, brute_print(r.text)) for r in docs.collect()]
    want = sorted(zip(rows, brute_components(rows), strict=True), key=repr)
    got = sorted((((r.doc_id, r.fingerprint & (1 << 64) - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == want


def test_links_are_complete_on_crowded_fingerprints(spark):
    """Fingerprints that share most bits, chains of 3 bits and random ones."""
    rng = np.random.default_rng(5)
    prints = {0, (1 << 64) - 1}
    for center in rng.integers(0, 1 << 63, 3):
        for _ in range(60):
            x = int(center)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    shared = int(rng.integers(0, 1 << 63)) & ~0xFFFF
    prints |= {shared | int(v) for v in rng.integers(0, 1 << 16, 80)}  # 48 bits in common
    prints |= {int(v) for v in rng.integers(0, 1 << 63, 60)}
    nodes = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in sorted(prints)], "fingerprint long")
    got = {(r.a, r.b) for r in simhash.links(nodes).collect()}
    signed = sorted(int(np.uint64(p).astype(np.int64)) for p in prints)
    want = {(a, b) for a, b in itertools.combinations(signed, 2) if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    assert got == want and len(want) > 100


def test_allotment_is_the_cheapest_that_covers():
    rng = np.random.default_rng(2)
    costs = [np.concatenate([np.zeros((1, 5)), np.cumsum(rng.random((4, 5)) * 9, axis=0)]) for _ in range(4)]
    got = simhash.allot(costs, 3)
    assert (got.sum(axis=0) == 3 - 4 + 1).all() and (got >= -1).all()
    for q in range(5):
        best = min(sum(costs[i][t + 1, q] for i, t in enumerate(ts)) for ts in itertools.product(range(-1, 4), repeat=4) if sum(ts) == 0)
        assert abs(sum(costs[i][got[i, q] + 1, q] for i in range(4)) - best) < 1e-9


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
