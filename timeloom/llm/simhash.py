"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``RADIUS`` or fewer differing bits. The bits
are grouped into partitions of 16, correlated bits together, so that a
partition's values are as uneven as they can be and the others' as even. For
each fingerprint a dynamic program over estimated candidate counts allots
every partition its own threshold, -1 (not probed) upwards, with sum
``RADIUS - partitions + 1``: by the pigeonhole principle any fingerprint within
the radius is within the threshold in at least one partition. A partition
whose value is crowded gets -1 or 0, and the even ones make up for it; this is
what keeps hot values from being compared pair by pair. Probes meet the index
in an equi-join on (partition, value) that verifies the distance.

Equal fingerprints are one node from the start, so groups of copies never meet
in pairs; only links between different fingerprints are searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm.common import arrow_slices, connected_components
from timeloom.session import release, stage_table

SHINGLE = 3
RADIUS = 3
PARTITIONS, WIDTH = 4, 16
#: Cost of one probe, in verified candidates, in the allocation.
PROBE_COST = 0.2


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: the id column and ``fingerprint`` (the 64 bits as a long).

    Words are runs of non-space of the text with A-Z lower-cased; a bit is 1 if
    it is set in over half of the XXH64 hashes (seed 42) of the shingles,
    repeats included. Fewer words make one shingle; a null text or one without
    words has fingerprint 0. Whole texts; extra columns are left out."""
    schema = T.StructType([df.schema[id_col], T.StructField("fingerprint", T.LongType(), False)])
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in arrow_slices(batches, 1):
            hashes, counts = [], []
            for text in batch.column(1):
                words = (text.as_py() or "").encode().translate(lower).split()
                n = max(1, len(words) - shingle + 1) if words else 0
                line = b" ".join(words)
                ends = np.cumsum([len(w) + 1 for w in words]) if words else np.zeros(0, np.int64)
                starts = (ends - [len(w) + 1 for w in words]).tolist()[:n]
                stops = (ends - 1).tolist()[min(shingle, len(words)) - 1:] if words else []
                hashes += [digest(line[a:b], 42) for a, b in zip(starts, stops, strict=True)]
                counts.append(n)
            h, counts = np.array(hashes, dtype=np.uint64), np.array(counts)
            bits = np.zeros(len(counts), dtype=np.uint64)
            full = np.flatnonzero(counts)
            if len(full):
                first = (np.cumsum(counts) - counts)[full]
                for b in range(64):
                    set_ = np.add.reduceat((h >> np.uint64(b)) & np.uint64(1), first)
                    bits[full] |= (2 * set_.astype(np.int64) > counts[full]).astype(np.uint64) << np.uint64(b)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=[f.name for f in schema])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def group_bits(nodes: DataFrame) -> list[list[int]]:
    """Partitions of bits, correlated ones together.

    Correlations come from all fingerprints: tasks add up 64 x 64 products, the
    driver gets one matrix per task. Greedy: the most skewed or correlated free
    bit opens a partition, which takes the free bit with the largest sum of
    absolute correlations to it until it is full."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((65, 65), dtype=np.int64)
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            m = ((v[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            m = np.concatenate([m, np.ones((len(m), 1), np.float32)], axis=1)
            total += (m.T @ m).astype(np.int64)
        cells = np.arange(65 * 65)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], names=["cell", "n"])

    sums = nodes.select("fingerprint").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    m = np.zeros(65 * 65)
    m[sums["cell"]] = sums["n"]
    m = m.reshape(65, 65)
    if m[64, 64] < 2:
        return [list(range(i * WIDTH, (i + 1) * WIDTH)) for i in range(PARTITIONS)]
    p = m[64, :64] / m[64, 64]
    cov = m[:64, :64] / m[64, 64] - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    near = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(near, 0)
    skew = np.abs(p - 0.5)  # a near-constant bit tells little, like a correlated one
    free, groups = set(range(64)), []
    for _ in range(PARTITIONS):
        group = [max(free, key=lambda b: (round(near[b, sorted(free)].sum() + 4 * skew[b], 9), -b))]
        free.discard(group[0])
        while len(group) < WIDTH:
            best = max(free, key=lambda b: (round(near[b, group].sum() + 4 * skew[b], 9), -b))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def split_bits(fp, groups: list[list[int]]):
    """[partition][fingerprint] values of the partitions (numpy)."""
    import numpy as np

    out = np.zeros((len(groups), len(fp)), dtype=np.int64)
    for row, group in zip(out, groups, strict=True):
        for k, b in enumerate(group):
            row |= ((fp >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def ball_masks(radius: int) -> list:
    """[t]: the masks of exactly t of the ``WIDTH`` bits."""
    import numpy as np

    return [np.array([sum(1 << b for b in c) for c in combinations(range(WIDTH), t)], dtype=np.int64) for t in range(radius + 1)]


def allot(costs, radius: int):
    """Thresholds [partition][query] of least total cost whose sum is
    ``radius - partitions + 1``; costs[partition][threshold + 1][query].

    f(i, s): least cost of the first i partitions with thresholds adding up to
    s; one step tries every threshold of the next partition for all queries."""
    import numpy as np

    m, n = len(costs), costs[0].shape[1]
    goal = radius + 1  # thresholds count from -1, so their steps add up to radius + 1
    best = np.full((goal + 1, n), np.inf)
    best[0] = 0
    choice = np.zeros((m, goal + 1, n), dtype=np.int8)
    for i in range(m):
        new = np.full_like(best, np.inf)
        for s in range(goal + 1):
            for t in range(min(s, radius + 1) + 1):
                c = best[s - t] + costs[i][t]
                better = c < new[s]
                new[s] = np.where(better, c, new[s])
                choice[i, s][better] = t
        best = new
    out, left = np.zeros((m, n), dtype=np.int64), np.full(n, goal)
    for i in range(m - 1, -1, -1):
        out[i] = choice[i, left, np.arange(n)]
        left = left - out[i]
    return out - 1


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): every pair of different fingerprints within the radius, a < b,
    from a table of distinct fingerprints."""
    import numpy as np

    spark = nodes.sparkSession
    groups = group_bits(nodes)

    def index(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            parts = split_bits(fp.view(np.uint64), groups)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(PARTITIONS, dtype=np.int64), len(fp)) << WIDTH | parts.ravel()),
                                              pa.array(np.tile(fp, PARTITIONS))], names=["cell", "fp"])

    indexed = stage_table(nodes.select("fingerprint").mapInArrow(index, "cell long, fp long"), "gph-index")
    # how often each value of each partition occurs: 4 x 65,536 numbers at most
    seen = indexed.groupBy("cell").agg(F.count("*").alias("n")).toPandas()
    hist = np.zeros(PARTITIONS << WIDTH, dtype=np.int64)
    hist[seen["cell"]] = seen["n"]
    shared = spark.sparkContext.broadcast(hist.astype(np.int32))

    def probe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        masks = ball_masks(radius)
        values = np.arange(1 << WIDTH)
        # expected candidates of a probe of radius t around every value
        within = np.zeros((PARTITIONS, radius + 2, 1 << WIDTH))
        for i in range(PARTITIONS):
            own = shared.value[i << WIDTH:(i + 1) << WIDTH]
            for t in range(radius + 1):
                within[i, t + 1] = within[i, t] + PROBE_COST * len(masks[t])
                for mask in masks[t]:
                    within[i, t + 1] += own[values ^ mask]
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                fp = batch.column(0).slice(at, 20_000).to_numpy(zero_copy_only=False)
                parts = split_bits(fp.view(np.uint64), groups)
                upto = allot([within[i][:, parts[i]] for i in range(PARTITIONS)], radius)
                for i in range(PARTITIONS):
                    for t in range(radius + 1):
                        on = np.flatnonzero(upto[i] >= t)
                        step = max(1, 200_000 // len(masks[t]))
                        for k in range(0, len(on), step):
                            some = on[k:k + step]
                            cells = (parts[i][some][:, None] ^ masks[t]) | (i << WIDTH)
                            yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), pa.array(np.repeat(fp[some], len(masks[t])))], names=["cell", "q"])

    probes = nodes.select("fingerprint").mapInArrow(probe, "cell long, q long")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius
    # the planner cannot know how many probes a fingerprint makes: no broadcast
    met = probes.hint("merge").join(indexed, (probes["cell"] == indexed["cell"]) & (F.col("q") != F.col("fp")) & near)
    found = stage_table(met.select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b")).distinct(), "gph-links")
    release(indexed)
    return found


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``df``: the id column, ``fingerprint`` (long) and
    ``component_id``, the smallest id reachable over links (its own included).

    Rows without words share fingerprint 0 and link like any others; a null id
    is no candidate for the smallest. An empty table gives an empty one."""
    prints = stage_table(fingerprints(df, id_col, text_col, shingle), "simhash")
    nodes = stage_table(prints.groupBy("fingerprint").agg(F.min(id_col).alias("first_id")), "simhash-nodes")
    # spread: the distinct fingerprints are few bytes, the probes are not
    edges = links(nodes, radius)
    parts = connected_components(edges)
    named = nodes.join(parts, F.col("fingerprint") == F.col("node"), "left").select(
        F.col("fingerprint"), "first_id", F.coalesce("component", "fingerprint").alias("component"))
    named = stage_table(named, "simhash-named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return prints.join(named.join(least, "component").select("fingerprint", "component_id"), "fingerprint").select(
        id_col, "fingerprint", "component_id")
