"""Bootstrap replicates as vectors: one weight per replicate, packed in one
binary value, never one row per replicate.

1. ``poisson_cells`` or ``multinomial_cells`` give every scored row the vector
   of how often each replicate draws it, and sum the vectors of equal (key,
   score, label) inside the task, so a score that many rows share is one cell
   per task before anything is shuffled.
2. ``cell_runs`` range-partitions the cells by (key, score) and reduces the
   cells of each rounded score to three vectors, in runs of a bounded number
   of rounded scores: drawn positives, drawn negatives, and the part of the
   ROC numerator that lies inside. A rounded score that holds very many rows
   may spread over partitions.
3. Running sums over the runs (few rows) give each run its offsets, and
   ``run_areas`` gives its share of both areas; shares are summed by key.

Draws. Poisson(1) weights come from splitmix64 over (hash of the draw key,
replicate): no state, any order, the same numbers in any engine with 64-bit
integers. Exact draws (n rows with replacement) are a multinomial, split down
a tree of row ranges by binomials: each node's generator is seeded by the
node, so a block of rows follows its own path from the root and needs no other
task's result; replicates of one group add up to n exactly."""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.functions.scalar import round_even
from timeloom.operators.numbering import number_rows
from timeloom.session import stage_table

# task functions travel with their helpers
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["poisson_cuts", "replicate", "poisson_cells", "multinomial_cells", "split_draws", "replicate_areas"]

#: Rows of a block of the exact draw, and rounded scores of a run.
BLOCK_ROWS = 256
RUN_SCORES = 128
#: Rows whose weights are made at a time.
SLICE_ROWS = 2048

# The constants of splitmix64.
GAMMA, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
MASK = (1 << 64) - 1


def poisson_cuts(lam: float = 1.0, bits: int = 53) -> list[int]:
    """Cumulative Poisson(λ) probabilities P(X ≤ k), k = 0, 1, …, times
    2^bits, as integers, up to the last below 2^bits: a uniform integer draw u
    gives X = #{k : u ≥ cut_k}."""
    cuts, p, c, k = [], math.exp(-lam), 0.0, 0
    while (cut := round((c := c + p) * (1 << bits))) < 1 << bits and (not cuts or cut > cuts[-1]):
        cuts.append(cut)
        k += 1
        p *= lam / k
    return cuts


def poisson_weights(seeds, n_rep: int):
    """(rows × replicates) Poisson(1) counts of 64-bit row seeds; replicates
    are numbered from 1."""
    import numpy as np

    with np.errstate(over="ignore"):
        z = seeds.astype(np.uint64)[:, None] + np.arange(1, n_rep + 1, dtype=np.uint64) * np.uint64(GAMMA)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(MIX_1)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(MIX_2)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.int64)
    out = np.zeros(u.shape, np.uint8)
    for cut in poisson_cuts():
        more = u >= cut
        if not more.any():
            break
        out += more
    return out


def draw_seed(seed, *keys) -> F.Column:
    """64 bits (binary, most significant byte first) of the draw key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.unhex(F.substring(F.md5(text), 1, 16))


def replicate(rows: DataFrame, n_rep: int, seed, draw_keys) -> DataFrame:
    """Hook for metrics of the caller's own: rows × replicates (``rep`` from 1)
    with their weight ``w`` > 0, the draws that the interval functions make
    too. The result is n_rep / 1.58 times the input; what sums per score should
    use the vectors."""
    schema = T.StructType([*rows.schema.fields, T.StructField("rep", T.IntegerType()), T.StructField("w", T.IntegerType())])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                drawn = poisson_weights(np.array([int.from_bytes(x, "big") for x in part.column(part.num_columns - 1).to_pylist()], dtype=np.uint64), n_rep)
                row, rep = np.nonzero(drawn)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns[:-1], pa.array(rep + 1, pa.int32()), pa.array(drawn[row, rep], pa.int32())],
                                                 names=[f.name for f in schema])

    return rows.select("*", draw_seed(seed, *draw_keys).alias("_seed")).mapInArrow(run, schema)


def _pack(vector) -> bytes:
    """Counts in the narrowest of 1, 2, 4 or 8 bytes each."""
    import numpy as np

    top = int(vector.max()) if len(vector) else 0
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(k).max)
    return vector.astype(kind).tobytes()


def _unpack(raw: bytes, n_rep: int):
    import numpy as np

    return np.frombuffer(raw, f"<u{len(raw) // n_rep}").astype(np.int64)


CELLS = "_k string, _s double, _y boolean, _w binary"


def _cells(keys: list, scores, labels, weights) -> tuple:
    """Sums the weight rows of equal (key, score, label): (keys, scores,
    labels, packed vectors)."""
    import numpy as np

    names, code = np.unique(np.array(keys, dtype=object), return_inverse=True)
    order = np.lexsort((labels, scores, code))
    code, scores, labels = code[order], scores[order], labels[order]
    new = np.concatenate([[True], (np.diff(code) != 0) | (np.diff(scores) != 0) | (labels[1:] != labels[:-1])])
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(weights[order].astype(np.int64), starts, axis=0)
    return names[code[starts]].tolist(), scores[starts], labels[starts], [_pack(w) for w in sums]


def _cell_batch(cells):
    import pyarrow as pa

    keys, scores, labels, weights = cells
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(scores, pa.float64()), pa.array(labels, pa.bool_()),
                                       pa.array(weights, pa.binary())], names=["_k", "_s", "_y", "_w"])


def poisson_cells(scores: DataFrame, keys, n_rep: int, seed, draw_keys, label: str = "future", score: str = "score") -> DataFrame:
    """(_k, _s, _y, _w): the summed weight vectors of every (key, score,
    label), partial per task; ``_k`` holds ``keys`` as JSON. Rows that agree in
    ``draw_keys`` have equal weights, so models scored on the same subjects
    share draws. Rows without label take no part."""
    rows = scores.where(F.col(label).isNotNull()).select(F.to_json(F.struct(*keys)).alias("_k"), F.col(score).cast("double").alias("_s"),
                                                         F.col(label).cast("boolean").alias("_y"), draw_seed(seed, *draw_keys).alias("_seed"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                seeds = np.array([int.from_bytes(x, "big") for x in part.column(3).to_pylist()], dtype=np.uint64)
                yield _cell_batch(_cells(part.column(0).to_pylist(), part.column(1).to_numpy(zero_copy_only=False),
                                         part.column(2).to_numpy(zero_copy_only=False), poisson_weights(seeds, n_rep)))

    return rows.mapInArrow(run, CELLS)


def _generator(*key):
    import numpy as np

    return np.random.Generator(np.random.Philox(int.from_bytes(hashlib.md5("|".join(map(str, key)).encode()).digest(), "little")))


def block_draws(group: str, n: int, block: int, n_rep: int, seed, block_rows: int = BLOCK_ROWS):
    """How many of each replicate's n draws fall on the rows of a block: the
    path from the root of the tree of row ranges, halved by blocks. Every
    node's split is drawn by a generator of its own, so all blocks of a group
    see the same splits and their draws add up to n."""
    import numpy as np

    low, high = 0, -(-n // block_rows)
    drawn = np.full(n_rep, n, dtype=np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        rows, left = min(high * block_rows, n) - low * block_rows, (mid - low) * block_rows
        to_left = _generator(seed, group, low, high).binomial(drawn, left / rows)
        drawn, low, high = (to_left, low, mid) if block < mid else (drawn - to_left, mid, high)
    return drawn


def split_draws(blocks: DataFrame, n_rep: int, seed, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The split table: ``blocks`` (_g group, _n its rows, _block) with
    ``draws`` array<long>, the draws of every replicate that fall on the
    block."""
    schema = T.StructType([*blocks.schema.fields, T.StructField("draws", T.ArrayType(T.LongType()))])
    at = [blocks.columns.index(c) for c in ("_g", "_n", "_block")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            drawn = [block_draws(g, n, b, n_rep, seed, block_rows).tolist() for g, n, b in zip(*(batch.column(i).to_pylist() for i in at), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.list_(pa.int64()))], names=[f.name for f in schema])

    return blocks.mapInArrow(run, schema)


def numbered_subjects(scores: DataFrame, group, subject: str, keys, label: str = "future", score: str = "score") -> DataFrame:
    """One row per (group, subject): ``_g``, ``_pos`` (number from 0 in its
    group, by a hash of the subject), ``_n`` (rows of the group) and ``_m``,
    the (key, score, label) of every model's row."""
    told = F.struct(F.to_json(F.struct(*keys)).alias("k"), F.col(score).cast("double").alias("s"), F.col(label).cast("boolean").alias("y"))
    rows = scores.where(F.col(label).isNotNull()).select(F.to_json(F.struct(*group)).alias("_g"), F.col(subject).alias("_subject"), told.alias("_m"))
    one = rows.groupBy("_g", "_subject").agg(F.collect_list("_m").alias("_m")).withColumn("_h", F.xxhash64("_subject"))
    return number_rows(one, ["_g"], ["_h", "_subject"], "_pos", "_n")


def multinomial_cells(scores: DataFrame, keys, n_rep: int, seed, group, subject: str, label: str = "future", score: str = "score",
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Like ``poisson_cells`` with exact draws: in every ``group`` each
    replicate draws as many subjects as there are, with replacement. All
    models' rows of a subject share its draws (a subject is one row per key)."""
    rows = numbered_subjects(scores, group, subject, keys, label, score).withColumn("_block", F.floor(F.col("_pos") / block_rows))
    # a block's rows in one task, in order; blocks have a fixed size
    rows = rows.select("_g", "_block", "_pos", "_n", "_m").repartition("_g", "_block").sortWithinPartitions("_g", "_block", "_pos")

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        def whole(block):
            group, number, _, n, _ = block[0]
            drawn = block_draws(group, n, number, n_rep, seed, block_rows)
            dealt = _generator(seed, group, number).multinomial(drawn, np.full(len(block), 1 / len(block)))
            told = [(m, i) for i, row in enumerate(block) for m in row[4]]
            scores = np.array([np.nan if m["s"] is None else m["s"] for m, _ in told], dtype=np.float64)
            return _cell_batch(_cells([m["k"] for m, _ in told], scores, np.array([m["y"] for m, _ in told], dtype=bool),
                                      dealt.T[[i for _, i in told]]))

        held: list = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:2] != row[:2]:
                    yield whole(held)
                    held = []
                held.append(row)
        if held:
            yield whole(held)

    return rows.mapInArrow(run, CELLS)


RUNS = "_k string, _run long, r array<double>, pos array<binary>, neg array<binary>, inside array<binary>, P array<long>, N array<long>"


def cell_runs(cells: DataFrame, n_rep: int, places: int = 4, run_scores: int = RUN_SCORES) -> DataFrame:
    """Cells, by key and descending score, reduced per rounded score: vectors
    of drawn positives and negatives, and ``inside``, twice the number of pairs
    in which the positive scores higher (a tie counts one). ``_run`` numbers
    runs in order; ``P`` and ``N`` are a run's sums."""
    rows = cells
    keys = [F.asc("_k"), F.desc_nulls_last("_s")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("_k", round_even("_s", places).alias("_r"), "_s", "_y", "_w")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        none = np.zeros(n_rep, np.int64)

        def told(key, groups):
            nonlocal number
            number += 1
            cols = [[key], [number], [[g[0] for g in groups]], *([[_pack(g[i]) for g in groups]] for i in (1, 2, 3)),
                    [sum((g[1] for g in groups), none).tolist()], [sum((g[2] for g in groups), none).tolist()]]
            kinds = [pa.string(), pa.int64(), pa.list_(pa.float64()), *[pa.list_(pa.binary())] * 3, *[pa.list_(pa.int64())] * 2]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                              names=["_k", "_run", "r", "pos", "neg", "inside", "P", "N"])

        key, groups, at = None, [], None  # at: the score whose cells are being summed
        pos, neg = none, none  # of that score

        def settle():
            """The score is complete: into its rounded score's vectors."""
            g = groups[-1]
            g[3] = g[3] + neg * (2 * g[1] + pos)
            g[1], g[2] = g[1] + pos, g[2] + neg

        for batch in batches:
            for k, r, s, y, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at is not None and (k != key or s != at):
                    settle()
                    pos, neg = none, none
                    if k != key or (r != groups[-1][0] and len(groups) >= run_scores):
                        yield told(key, groups)
                        groups = []
                if not groups or groups[-1][0] != r:
                    groups.append([r, none, none, none])
                key, at = k, s
                if y:
                    pos = pos + _unpack(w, n_rep)
                else:
                    neg = neg + _unpack(w, n_rep)
        if at is not None:
            settle()
            yield told(key, groups)

    return rows.mapInArrow(run, RUNS)


def _offsets(runs: DataFrame) -> DataFrame:
    """(_run, p0, n0): drawn positives and negatives of the key's earlier runs,
    as arrays in the order of the replicates. One row per run and replicate,
    windows by (key, replicate)."""
    each = runs.select("_k", "_run", F.posexplode(F.arrays_zip("P", "N")).alias("rep", "x")).select("_k", "_run", "rep", "x.P", "x.N")
    before = Window.partitionBy("_k", "rep").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("_run", "rep", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("P", "N")])
    vectors = each.groupBy("_run").agg(F.array_sort(F.collect_list(F.struct("rep", "P", "N"))).alias("_v"))
    return vectors.select("_run", F.col("_v.P").alias("p0"), F.col("_v.N").alias("n0"))


AREAS = "_k string, pairs array<double>, area array<double>, P array<long>, N array<long>, ends array<struct<r: double, at: array<bigint>>>"


def run_areas(runs: DataFrame, n_rep: int) -> DataFrame:
    """Per run: ``pairs`` (its part of twice the ROC numerator, pairs with
    earlier runs' positives included), ``area`` (its rounded scores' part of
    the PR area, times the key's positives; the first and the last one left
    out, because they may go on in another run), and these two as ``ends``:
    the four running sums before and after them, replicate by replicate."""
    rows = runs.join(_offsets(runs), "_run").select("_k", "r", "pos", "neg", "inside", "P", "N", "p0", "n0")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def part(precision_of, tp0, fp0, tp1, fp1):
            return (tp1 - tp0) * (precision_of(tp1, fp1) + precision_of(tp0, fp0, 1.0)) / 2

        def precision(tp, fp, empty=0.0):
            both = tp + fp
            return np.where(both > 0, tp / np.maximum(both, 1), empty)

        for batch in batches:
            out: list = [[] for _ in range(6)]
            for row in batch.to_pylist():
                tp, fp = np.array(row["p0"], np.int64), np.array(row["n0"], np.int64)
                pairs, area, ends = np.zeros(n_rep), np.zeros(n_rep), []
                last = len(row["r"]) - 1
                for i, r in enumerate(row["r"]):
                    pos, neg = _unpack(row["pos"][i], n_rep), _unpack(row["neg"][i], n_rep)
                    pairs += neg * (2.0 * tp) + _unpack(row["inside"][i], n_rep)
                    tp1, fp1 = tp + pos, fp + neg
                    if 0 < i < last:
                        area += part(precision, tp, fp, tp1, fp1)
                    else:
                        ends.append({"r": r, "at": np.concatenate([tp, fp, tp1, fp1]).tolist()})
                    tp, fp = tp1, fp1
                for held, x in zip(out, (row["_k"], pairs.tolist(), area.tolist(), row["P"], row["N"], ends), strict=True):
                    held.append(x)
            ends_type = pa.list_(pa.struct([("r", pa.float64()), ("at", pa.list_(pa.int64()))]))
            kinds = [pa.string(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()), ends_type]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["_k", "pairs", "area", "P", "N", "ends"])

    return rows.mapInArrow(run, AREAS)


def replicate_areas(cells: DataFrame, keys_schema: T.StructType, n_rep: int, places: int = 4) -> DataFrame:
    """(keys…, rep, roc_auc, pr_auc), replicates from 1: null where a key has
    one label only (PR: no positives). The only rows per replicate are those
    of runs and keys."""
    runs = stage_table(cell_runs(cells, n_rep, places), "replicate-runs")
    shares = stage_table(run_areas(runs, n_rep), "replicate-shares")
    each = shares.select("_k", F.posexplode(F.arrays_zip("pairs", "area", "P", "N")).alias("rep", "x")).select("_k", "rep", "x.*")
    sums = each.groupBy("_k", "rep").agg(*[F.sum(c).alias(c) for c in ("pairs", "area", "P", "N")])
    at = [F.slice("e.at", 1 + i * n_rep, n_rep).alias(c) for i, c in enumerate(("tp0", "fp0", "tp1", "fp1"))]
    ends = shares.select("_k", F.explode("ends").alias("e")).select("_k", "e.r", F.arrays_zip(*at).alias("z"))
    ends = ends.select("_k", "r", F.posexplode("z").alias("rep", "z")).select("_k", "r", "rep", "z.*")
    ends = ends.toDF("_k", "r", "rep", "tp0", "fp0", "tp1", "fp1")
    # sums only grow, so a rounded score that several runs hold begins at the least and ends at the greatest
    ends = ends.groupBy("_k", "r", "rep").agg(F.min("tp0").alias("tp0"), F.min("fp0").alias("fp0"), F.max("tp1").alias("tp1"), F.max("fp1").alias("fp1"))
    before = F.when(F.col("tp0") + F.col("fp0") > 0, F.try_divide("tp0", F.col("tp0") + F.col("fp0"))).otherwise(F.lit(1.0))
    after = F.coalesce(F.try_divide("tp1", F.col("tp1") + F.col("fp1")), F.lit(0.0))
    rest = ends.groupBy("_k", "rep").agg(F.sum((F.col("tp1") - F.col("tp0")) * (before + after) / 2).alias("rest"))
    out = sums.join(rest, ["_k", "rep"], "left").withColumn("area", F.col("area") + F.coalesce("rest", F.lit(0.0)))
    return out.select(F.from_json("_k", keys_schema).alias("k"), (F.col("rep") + 1).alias("rep"),
                      F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("pairs") / (2.0 * F.col("P") * F.col("N"))).alias("roc_auc"),
                      F.when(F.col("P") > 0, F.col("area") / F.col("P")).alias("pr_auc")).select("k.*", "rep", "roc_auc", "pr_auc")
