import numpy as np

from timeloom.llm import ann


def brute(rows, queries, k):
    out = {}
    for qid, q in queries:
        s = sorted((-float((np.asarray(q, np.float64) * np.asarray(v, np.float64)).sum()), i) for i, v in rows if i != qid)[:k]
        out[qid] = [(i, -x) for x, i in s]
    return out


def searched(vectors, queries, k=20):
    got = {}
    for r in sorted(ann.nearest(vectors, queries, k).collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_recall_of_clusters_norms_and_copies(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(20, 24))
    x = np.concatenate([centers[rng.integers(0, 20, 900)] + 0.3 * rng.normal(size=(900, 24)), rng.normal(size=(500, 24))])
    x *= rng.uniform(0.5, 2.0, (len(x), 1))  # inner product is not the angle here
    x[600:760] = x[600]  # a large group of copies
    rows = [(int(i), v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    bad = [(5000, None), (5001, [0.0] * 24), (5002, [float("nan")] * 24), (5003, [float("inf")] + [0.0] * 23), (5004, [None] + [1.0] * 23),
           (5005, [1.0, 2.0]), (None, [1.0] * 24), rows[3]]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows + bad], "vec_id long, embedding array<float>, id string")
    queries = [r for r in rows if r[0] % 10 == 0]
    got = searched(df, df.where("vec_id % 10 = 0"))
    want = brute(rows, queries, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.95
    exact = dict(rows)
    for q, found in got.items():
        for i, s in found:
            assert abs(s - float((np.asarray(exact[q]) * np.asarray(exact[i])).sum())) < 1e-9
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
    assert got[600] == want[600]  # copies tie: the smaller ids


def test_few_rows_give_all(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, -1.0])], "vec_id long, embedding array<float>")
    assert searched(df, df.where("vec_id % 20 = 0")) == {0: [(1, 0.5), (20, 0.0)], 20: [(0, 0.0), (1, -0.5)]}


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df, df).collect() == []


def test_every_code_within_the_radius_is_retrieved():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 16))
    shard = ann.Shard(x, float(np.sqrt((x * x).sum(axis=1)).max()), ann.learn(np.concatenate([x, np.zeros((400, 1))], axis=1)))
    own = shard.codes[7]
    found = set()
    for t in range(4):
        for s in range(shard.m):
            found |= set(shard.rows_at(s, int(own[s]), t).tolist())
        dist = shard.weight[shard.codes ^ own].sum(axis=1)
        assert set(np.flatnonzero(dist <= shard.m * (t + 1) - 1).tolist()) <= found


def test_recall_without_clusters():
    x = np.random.default_rng(5).normal(size=(8000, 64)).astype(np.float32).astype(float)
    norms = np.sqrt((x * x).sum(axis=1))
    wide = np.concatenate([x, np.sqrt(np.maximum(norms.max() ** 2 - norms ** 2, 0))[:, None]], axis=1)
    shard = ann.Shard(x, float(norms.max()), ann.learn(wide[:ann.SAMPLE]))
    want = {i: {(int(j), 0) for j in np.argsort(-(x @ x[i]), kind="stable")[:21]} for i in range(0, 8000, 80)}
    got = {i: {(int(j), 0) for j in shard.search(x[i], 21)[0]} for i in want}
    assert recall(got, want) >= 0.993


def test_query_recall(spark):
    from timeloom.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {}
    for r in QUERIES["op1_ann"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall(got, brute(rows, [r for r in rows if r[0] % 20 == 0], 20)) >= 0.9
