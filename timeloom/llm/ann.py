"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes: signs after learned rotations (iterative quantisation
on a bounded sample). Codes are cut into 16-bit substrings, and every substring
has an index of its own. By the pigeonhole principle a code within radius
``m * (t + 1) - 1`` of a query's agrees with it up to t bits in at least one of
the m substrings; so after the buckets within t bits of each of the query's
substrings have been probed, every code within that radius has been retrieved
(within t bits of the first j and t - 1 of the others: within m * t - 1 + j).
Candidates within the radius are reranked with their float vectors. t grows
until the radius covers the angle of the k-th best vector found, with a margin
for the spread of the codes.

The largest inner product becomes a smallest angle by one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm, which queries have as 0.

Equal vectors are one entry that carries the k + 1 smallest ids, which is all
a top k can need of them; groups of copies stay small that way. The index is
cut into shards by hash and the stated query set into blocks; each (shard,
block) is one task, and the k best of every shard are merged.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.session import stage_table

BITS, SUB = 128, 16
SAMPLE = 8192
SHARD_ROWS, BLOCK_ROWS = 65_536, 256
#: Standard deviations of a code distance that the radius covers beyond the mean.
MARGIN = 1.65


def valid(emb) -> "F.Column":
    """Takes part: no null, no null or non-finite component, not zero."""
    bad = F.exists(emb, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(emb, lambda x: x != 0), F.lit(False))


def learn(sample, bits: int = BITS, rounds: int = 40):
    """[dimension, bits] projection: principal axes turned by rotations that
    iterative quantisation fits, one per set of bits."""
    import numpy as np

    x = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-12)
    d = x.shape[1]
    width = min(64, d)
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :width]
    low = x @ axes
    out = []
    for k in range(math.ceil(bits / width)):
        r = np.linalg.qr(np.random.default_rng(k).normal(size=(width, width)))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(low @ r >= 0, 1.0, -1.0).T @ low)
            r = (u @ vt).T
        out.append(axes @ r)
    return np.concatenate(out, axis=1)[:, :bits]


def codes(x, projection):
    """[rows, substrings] 16-bit values of the sign codes."""
    import numpy as np

    on = (x @ projection >= 0).reshape(len(x), -1, SUB)
    return (on.astype(np.int64) << np.arange(SUB)).sum(axis=2)


class Shard:
    """Substring indexes over the codes of one shard, and the search."""

    def __init__(self, vectors, biggest: float, projection):
        import numpy as np

        self.np, self.x, self.biggest, self.projection = np, vectors, biggest, projection
        extra = np.sqrt(np.maximum(biggest ** 2 - (vectors ** 2).sum(axis=1), 0))
        self.codes = codes(np.concatenate([vectors, extra[:, None]], axis=1), projection)
        self.m = self.codes.shape[1]
        self.packed = self.codes.astype(np.uint16).view(np.uint64)
        self.order = [np.argsort(self.codes[:, s], kind="stable") for s in range(self.m)]
        self.starts = [np.concatenate([[0], np.cumsum(np.bincount(self.codes[:, s], minlength=1 << SUB))]) for s in range(self.m)]
        self.values = [np.unique(self.codes[:, s]) for s in range(self.m)]
        every = np.arange(1 << SUB)
        self.weight = np.bitwise_count(every).astype(np.int64)
        self.masks = [every[self.weight == t] for t in range(SUB + 1)]

    def rows_at(self, s: int, value: int, t: int):
        """Rows whose substring s differs from ``value`` in exactly t bits: by
        naming the buckets, or by walking those that exist if they are fewer."""
        np = self.np
        if len(self.masks[t]) <= len(self.values[s]):
            buckets = value ^ self.masks[t]
        else:
            buckets = self.values[s][self.weight[self.values[s] ^ value] == t]
        lo, hi = self.starts[s][buckets], self.starts[s][buckets + 1]
        n = hi - lo
        ends = np.cumsum(n)
        return self.order[s][np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - n), n)]

    def search(self, q, k: int, margin: float = MARGIN):
        """(rows, scores) of the k best found, best first.

        Probing substring after substring at t = 0, 1, .. bits widens the
        radius of complete retrieval by one each time; the round at t stops
        as soon as the radius that the k-th best asks for is reached."""
        np = self.np
        own = codes(np.append(q, 0.0)[None, :], self.projection)[0]
        packed = own.astype(np.uint16).view(np.uint64)
        known = np.zeros(len(self.x), dtype=bool)
        far_rows, far_dist = np.zeros(0, np.int64), np.zeros(0, np.int64)
        best_rows, best = np.zeros(0, np.int64), np.zeros(0)
        bits, norm = self.m * SUB, float(np.sqrt((q * q).sum()))
        radius, needed = -1, bits
        for t in range(SUB + 1):
            asked = min(self.m, needed - radius)
            new = []
            for s in range(asked):
                rows = self.rows_at(s, int(own[s]), t)
                rows = rows[~known[rows]]
                known[rows] = True
                new.append(rows)
            radius += asked
            rows = np.concatenate(new)
            dist = np.bitwise_count(self.packed[rows] ^ packed).sum(axis=1, dtype=np.int64)
            rows, dist = np.concatenate([far_rows, rows]), np.concatenate([far_dist, dist])
            near = dist <= radius
            far_rows, far_dist, rows = rows[~near], dist[~near], rows[near]
            if len(rows):
                # a sum of each row by itself: equal vectors get equal scores
                scores = (self.x[rows] * q).sum(axis=1)
                best_rows, best = np.concatenate([best_rows, rows]), np.concatenate([best, scores])
                keep = np.argsort(-best, kind="stable")[:k]
                best_rows, best = best_rows[keep], best[keep]
            if len(best) >= k:
                p = math.acos(max(-1.0, min(1.0, best[-1] / (self.biggest * norm)))) / math.pi
                needed = min(bits, math.ceil(bits * p + margin * math.sqrt(bits * p * (1 - p))))
            if radius >= needed:
                break
        return best_rows, best


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows of ``vectors`` with the largest inner product to each row of
    ``queries``, its own id left out: query_id, rank (from 1), vec_id, score
    (double). Ties go to the smaller id; fewer candidates give fewer rows.

    Vectors that are null, zero, or hold a null or non-finite component take no
    part on either side; of differing lengths, the most frequent (then longest)
    is used. Repeated (id, vector) rows count once. Rows and queries without an
    id take no part. An empty side gives no rows."""
    import numpy as np

    def clean(df):
        e = F.col(vector_col)
        return df.where(valid(e) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), e.cast("array<float>").alias("v")).distinct()

    spark = vectors.sparkSession
    rows = clean(vectors)
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    # identical vectors: the k + 1 smallest ids are all that a top k can show
    entries = stage_table(rows.withColumn("_r", first).where(F.col("_r") <= k + 1).groupBy("v")
                          .agg(F.array_sort(F.collect_list("id")).alias("ids"))
                          .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))), "ann-entries")
    out_schema = "query_id long, vec_id long, score double"
    sizes = entries.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max("norm").alias("m")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n, biggest = sizes["d"], sizes["n"], sizes["m"]
    entries = entries.where(F.size("v") == d)
    sample = np.array(entries.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").toPandas()["v"].tolist(), dtype=np.float64)
    extra = np.sqrt(np.maximum(biggest ** 2 - (sample ** 2).sum(axis=1), 0))
    projection = learn(np.concatenate([sample, extra[:, None]], axis=1))

    asked = clean(queries).where(F.size("v") == d)
    n_asked = asked.count()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(n_asked / BLOCK_ROWS))
    left = (entries.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("shard", "block", "v", "ids"))
    right = (asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).select("shard", "block", "id", "v"))

    def search(index: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        out = []
        if len(index) and len(block):
            shard = Shard(np.stack(index["v"].to_list()).astype(np.float64), biggest, projection)
            ids = index["ids"].to_list()
            for qid, v in zip(block["id"], block["v"], strict=True):
                found, scores = shard.search(np.asarray(v, dtype=np.float64), k + 1)
                pairs = sorted((-s, i) for r, s in zip(found, scores, strict=True) for i in ids[r] if i != qid)[:k]
                out += [(qid, i, -s) for s, i in pairs]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(search, out_schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
