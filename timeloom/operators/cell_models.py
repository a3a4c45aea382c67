"""Many baseline models in one job: logistic regression and boosted trees.

A *cell* is one model, e.g. (outcome, training site); the pooled model of an
outcome is one more cell. A row carries its sparse features once and the list
of the cells that it belongs to, with its label in each. All cells advance
together: a job evaluates every cell's trial point, or every cell's open
leaves, over all rows; partial sums per task, then per (cell, feature). Only
values of model size (weights; one best split per leaf) reach the driver.

Logistic regression minimizes ½‖w‖² + C · Σ log-loss with a free intercept.
Up to ``NEWTON_DIM`` weights by Newton steps: the job that gives the gradients
gives the curvature matrices too, and the number of jobs hardly grows with the
rows, whose gradients (sums over rows) are held to an absolute tolerance. With
more weights by L-BFGS, one history per cell, scaled by the diagonal of the
curvature. A cell whose trial point does not lower its objective halves its
step in the next job, while the others go on.

Boosted trees grow leaf-wise: each round builds the histograms (gradient sums
per feature bin) of the leaves that the round before made, all cells' in one
job, and splits the open leaves of largest gain until the tree has its leaves.
A cell whose tree is done starts its next one without waiting for the others.
Only the best split of each leaf comes back; nothing is kept between rounds."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.session import release, stage_table

# task functions travel with their helpers
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["sparse_rows", "with_cells", "fit_logistic_cells", "score_logistic_cells", "fit_boosted_cells", "score_boosted_cells"]

#: Weights that one broadcast may hold, in bytes; more cells are fitted in groups.
MODEL_BYTES = 256 << 20
#: Weights up to which a cell's whole curvature matrix is summed.
NEWTON_DIM = 256
#: Numbers in the dense matrix that a task makes of some rows at a time.
DENSE = 1 << 22


def sparse_rows(rows: DataFrame, keys, col: str = "tokens_past", binary: bool = False) -> DataFrame:
    """(keys…, idx array<int>, val array<double>): different token ids of a
    row's list, ascending, and how often each occurs (``binary``: 1). A null
    list has no features."""
    ids = F.sort_array(F.array_distinct(F.coalesce(F.col(col).cast("array<int>"), F.array().cast("array<int>"))))
    long = rows.select(*keys, ids.alias("idx"), F.col(col).cast("array<int>").alias("_all"))
    ones = F.transform("idx", lambda _: F.lit(1.0))
    if binary:
        return long.select(*keys, "idx", ones.alias("val"))
    # one pass over the sorted list: ends of equal stretches, differenced
    srt = F.sort_array(F.coalesce(F.col("_all"), F.array().cast("array<int>")))
    long = long.select(*keys, "idx", srt.alias("_s"))
    first = F.transform("idx", lambda x: F.array_position("_s", x))
    sizes = F.zip_with("_at", F.concat(F.slice("_at", 2, F.greatest(F.size("_at"), F.lit(1))), F.array(F.size("_s").cast("long") + 1)),
                       lambda a, b: (b - a).cast("double"))
    return long.select(*keys, "idx", "_s", first.alias("_at")).select(
        *keys, "idx", F.when(F.size("idx") == 0, F.array().cast("array<double>")).otherwise(sizes).alias("val"))


def with_cells(features: DataFrame, labels: DataFrame, keys, cells: dict, cell_cols, pooled: str | None = None) -> DataFrame:
    """``features`` with ``cells`` array<int> and ``labels`` array<double>:
    from ``labels`` (keys…, cell columns…, label), by ``cells``, the number of
    each combination of the cell columns' values; ``pooled`` names the value
    that stands for all values of the first cell column."""
    rows = [(*k, n) for k, n in cells.items()]
    spark = features.sparkSession
    names = ["_c" + c for c in cell_cols]
    table = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names) + ", _cell int")
    at = labels.select(*keys, "label", *[F.col(c).cast("string").alias(n) for c, n in zip(cell_cols, names, strict=True)])
    own = at.join(F.broadcast(table), names)
    if pooled is not None:
        everywhere = table.where(F.col(names[0]) == pooled).drop(names[0])
        own = own.select(*keys, "label", "_cell").unionAll(at.join(F.broadcast(everywhere), names[1:]).select(*keys, "label", "_cell"))
    lists = own.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_cell", "label"))).alias("_l"))
    return features.join(lists, list(keys)).select(*features.columns, F.col("_l._cell").alias("cells"), F.col("_l.label").cast("array<double>").alias("labels"))


def _batch(batch, at):
    """(row of every entry, feature, value, row of every membership, cell, label)"""
    import numpy as np

    idx, val, cells, labels = (batch.column(i) for i in at)
    sizes, members = np.diff(np.asarray(idx.offsets)), np.diff(np.asarray(cells.offsets))
    n = np.arange(batch.num_rows)
    return (np.repeat(n, sizes), idx.flatten().to_numpy(zero_copy_only=False), val.flatten().to_numpy(zero_copy_only=False),
            np.repeat(n, members), cells.flatten().to_numpy(zero_copy_only=False), labels.flatten().to_numpy(zero_copy_only=False))


@dataclass
class _State:
    """One cell's descent: its point, objective, gradient and curvature matrix
    (none: L-BFGS), and the trial."""
    w: object
    scale: object
    f: float = float("inf")
    g: object = None
    curve: object = None
    trial: object = None
    step: float = 1.0
    direction: object = None
    history: list = field(default_factory=list)
    rounds: int = 0
    done: bool = False
    residual: float = float("inf")

    def propose(self):
        import numpy as np

        self.step = 1.0
        if self.curve is not None:
            self.direction = -np.linalg.solve(self.curve, self.g)
            self.trial = self.w + self.direction
            return
        q, alphas = self.g.copy(), []
        for s, y, rho in reversed(self.history):
            a = rho * (s @ q)
            alphas.append(a)
            q -= a * y
        gamma = 1.0
        if self.history:
            s, y, _ = self.history[-1]
            gamma = (s @ y) / (y @ (y / self.scale))
        q = gamma * q / self.scale
        for (s, y, rho), a in zip(self.history, reversed(alphas), strict=True):
            q += s * (a - rho * (y @ q))
        self.direction = -q
        self.trial = self.w + self.direction

    def seen(self, f, g, curve, tol, max_iter):
        """The objective, gradient and curvature at the trial point have come
        in. What the sums round off is no rise of the objective."""
        import numpy as np

        self.rounds += 1
        if self.g is None or f <= self.f + 1e-4 * self.step * (self.g @ self.direction) + 1e-13 * abs(self.f):
            if self.g is not None and curve is None:
                s, y = self.trial - self.w, g - self.g
                if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
                    self.history = [*self.history[-9:], (s, y, 1.0 / (s @ y))]
            self.w, self.f, self.g, self.curve = self.trial, f, g, curve
            self.residual = float(np.abs(g).max())
            self.done = self.residual <= tol or self.rounds >= max_iter
            if not self.done:
                self.propose()
        else:
            self.step /= 2
            self.trial = self.w + self.step * self.direction
            self.done = self.step < 1e-9 or self.rounds >= max_iter


def _entries(starts, sizes, who):
    """(place of every entry of the rows ``who``, its row's place in ``who``)"""
    import numpy as np

    n = sizes[who]
    of = np.repeat(np.arange(len(who)), n)
    return np.arange(len(of)) + (starts[who] - np.cumsum(n) + n)[of], of


def _sums(rows: DataFrame, weights: dict, dim: int, curvature: str = "none") -> dict:
    """{cell: (loss, gradient, curvature, members)} at ``weights``, in one job.
    ``curvature``: "none", "bound" (the diagonal at zero, its largest) or
    "matrix" (the whole one at the weights)."""
    import numpy as np

    at = [rows.columns.index(c) for c in ("idx", "val", "cells", "labels")]
    held = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total: dict = {}
        step = max(1, DENSE // (dim + 1)) if curvature == "matrix" else 1 << 30
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            er, ef, ev, mr, mc, ml = _batch(batch, at)
            n = batch.num_rows
            sizes = np.bincount(er, minlength=n)
            starts = np.cumsum(sizes) - sizes
            if curvature == "matrix":
                dense = np.bincount(er * (dim + 1) + ef, ev, minlength=n * (dim + 1)).reshape(n, dim + 1)
                dense[:, dim] = 1.0
            for c in np.unique(mc):
                w = held.value.get(int(c))
                if w is None:
                    continue
                y = np.full(n, np.nan)
                y[mr[mc == c]] = ml[mc == c]
                who = np.flatnonzero(~np.isnan(y))
                t = y[who]
                sums = total.setdefault(int(c), [0.0, np.zeros(dim + 1), np.zeros((dim + 1, dim + 1) if curvature == "matrix" else dim + 1), 0])
                if curvature == "matrix":
                    x = dense[who]
                    z = x @ w
                else:
                    e, of = _entries(starts, sizes, who)
                    z = np.bincount(of, ev[e] * w[ef[e]], minlength=len(who)) + w[dim]
                p = 1.0 / (1.0 + np.exp(-z))
                sums[0] += np.sum(np.logaddexp(0.0, z) - t * z)
                if curvature == "matrix":
                    sums[1] += x.T @ (p - t)
                    x *= np.sqrt(p * (1.0 - p))[:, None]
                    sums[2] += x.T @ x
                else:
                    sums[1][:dim] += np.bincount(ef[e], ev[e] * (p - t)[of], minlength=dim)
                    sums[1][dim] += (p - t).sum()
                    if curvature == "bound":
                        sums[2][:dim] += np.bincount(ef[e], ev[e] * ev[e], minlength=dim) / 4
                        sums[2][dim] += len(who) / 4
                sums[3] += len(who)
        upper = np.triu_indices(dim + 1)
        for c, (loss, g, h, n) in total.items():
            # positions: -1 loss and members, then the gradient, then the curvature
            values = np.concatenate([g, h[upper] if curvature == "matrix" else h])
            j = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j) + 2, c, np.int32)), pa.array(np.concatenate([j, [-1, -2]]).astype(np.int32)),
                                              pa.array(np.concatenate([values[j], [loss, float(n)]]))], names=["cell", "pos", "v"])

    got = rows.mapInArrow(run, "cell int, pos int, v double").groupBy("cell", "pos").agg(F.sum("v").alias("v")).toArrow()
    held.unpersist()
    cell, pos, v = (got.column(i).to_numpy() for i in range(3))
    out = {}
    upper = np.triu_indices(dim + 1)
    for c in np.unique(cell):
        p, x = pos[cell == c], v[cell == c]
        values = np.zeros(dim + 1 + (len(upper[0]) if curvature == "matrix" else dim + 1))
        values[p[p >= 0]] = x[p >= 0]
        curve = values[dim + 1:]
        if curvature == "matrix":
            curve = np.zeros((dim + 1, dim + 1))
            curve[upper] = values[dim + 1:]
            curve = curve + np.triu(curve, 1).T
        out[int(c)] = (float(x[p == -1][0]), values[:dim + 1], curve, int(round(x[p == -2][0])))
    return out


def fit_logistic_cells(rows: DataFrame, n_cells: int, dim: int, c: float = 1.0, tol: float = 1e-4, max_iter: int = 200) -> DataFrame:
    """(cell, n, objective, residual, rounds, weights array<double>): all cells'
    models, the intercept last. ``residual`` is the largest component of the
    gradient of ½‖w‖² + C · Σ log-loss at the result (0 at the optimum).
    ``rows`` (idx, val, cells, labels) should be a stage table, it is read once
    a round; cells without rows have no result."""
    import numpy as np

    spark, out = rows.sparkSession, []
    newton = dim < NEWTON_DIM
    size = max(1, MODEL_BYTES // (8 * (dim + 1) * (dim + 1 if newton else 1)))
    ridge = np.append(np.ones(dim), 0.0)

    def whole(h):
        return c * h + np.diag(ridge + 1e-9) if newton else None

    for first in range(0, n_cells, size):
        cells = range(first, min(first + size, n_cells))
        start = _sums(rows, {k: np.zeros(dim + 1) for k in cells}, dim, "matrix" if newton else "bound")
        states, members = {}, {}
        for k, (loss, g, h, n) in start.items():
            s = states[k] = _State(np.zeros(dim + 1), None if newton else c * h + ridge + 1e-9)
            members[k] = n
            s.trial = s.w
            s.seen(c * loss, c * g, whole(h), tol, max_iter)
        while todo := {k: s.trial for k, s in states.items() if not s.done}:
            for k, (loss, g, h, _) in _sums(rows, todo, dim, "matrix" if newton else "none").items():
                w = todo[k] * ridge
                states[k].seen(c * loss + 0.5 * (w @ w), c * g + w, whole(h), tol, max_iter)
        out += [(k, members[k], float(s.f), s.residual, s.rounds, [float(x) for x in s.w]) for k, s in sorted(states.items())]
    return stage_table(spark.createDataFrame(out, "cell int, n long, objective double, residual double, rounds int, weights array<double>"), "logistic-cells")


def _model_groups(models: dict, size: int) -> list[dict]:
    keys = sorted(models)
    return [{k: models[k] for k in keys[i:i + size]} for i in range(0, len(keys), size)]


def _score(rows: DataFrame, models: dict, predict, size: int) -> DataFrame:
    """``rows`` (with idx, val and ``for_cells`` array<int>), one per wanted
    cell that has a model: every column but these three, ``cell`` and
    ``score``."""
    kept = [c for c in rows.columns if c not in ("idx", "val", "for_cells")]
    at = [rows.columns.index(c) for c in ("idx", "val", "for_cells", "for_cells")]
    keep_at = [rows.columns.index(c) for c in kept]
    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept] + ["cell int", "score double"])
    out = None
    for group in _model_groups(models, size) or [{}]:
        held = rows.sparkSession.sparkContext.broadcast(group)

        def run(batches: Iterator, held=held) -> Iterator:
            import numpy as np
            import pyarrow as pa

            for batch in batches:
                er, ef, ev, mr, mc, _ = _batch(batch, at)
                for c in np.unique(mc):
                    model = held.value.get(int(c))
                    if model is not None:
                        who = mr[mc == c]
                        z = predict(model, batch.num_rows, er, ef, ev)[who]
                        cols = [batch.column(i).take(pa.array(who)) for i in keep_at]
                        yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(who), c, np.int32)), pa.array(1.0 / (1.0 + np.exp(-z)))],
                                                         names=[*kept, "cell", "score"])

        one = rows.mapInArrow(run, schema)
        out = one if out is None else out.unionAll(one)
    return out


def _margin(w, n, er, ef, ev):
    import numpy as np

    known = ef < len(w) - 1
    return np.bincount(er[known], ev[known] * w[ef[known]], minlength=n) + w[-1]


def score_logistic_cells(rows: DataFrame, models: DataFrame) -> DataFrame:
    """Scores of ``rows`` (idx, val, for_cells) under the models of their cells."""
    held = {r.cell: _array(r.weights) for r in models.select("cell", "weights").toLocalIterator()}
    size = max(1, MODEL_BYTES // (8 * max((len(w) for w in held.values()), default=1)))
    return _score(rows, held, _margin, size)


def _array(x):
    import numpy as np

    return np.array(x, dtype=np.float64)


# ---------------------------------------------------------------- boosted trees
# A tree is a list of nodes; node 0 is the root. A split node is (feature,
# least value that goes right, left, right), a leaf its value.

#: Least value of the first bin: every nonzero value is above it.
SMALLEST = 1e-300


def _columns(trees, er, ef, ev, n):
    """({feature: column}, matrix) of the features that the trees split by;
    −inf where a row has no value."""
    import numpy as np

    used = sorted({node[0] for tree in trees for node in tree if isinstance(node, tuple)})
    out = np.full((n, len(used)), -np.inf)
    if used and len(ef):
        slot = np.full(max(used[-1], int(ef.max())) + 1, -1)
        slot[used] = np.arange(len(used))
        col = slot[ef]
        known = col >= 0
        out[er[known], col[known]] = ev[known]
    return {f: i for i, f in enumerate(used)}, out


def leaves_of(tree, columns, matrix, who):
    """Node in which each of the rows ``who`` of the matrix ends."""
    import numpy as np

    at = np.zeros(len(who), np.int32)
    # children come after their parents
    for i, node in enumerate(tree):
        if isinstance(node, tuple):
            feature, value, left, right = node
            here = np.flatnonzero(at == i)
            at[here] = np.where(matrix[who[here], columns[feature]] >= value, right, left)
    return at


def _steps(trees, columns, matrix, who):
    """What the trees add to the rows' margins."""
    import numpy as np

    out = np.zeros(len(who))
    for tree in trees:
        out += np.array([0.0 if isinstance(x, tuple) else x for x in tree])[leaves_of(tree, columns, matrix, who)]
    return out


def _boosted(model, n, er, ef, ev):
    import numpy as np

    base, trees = model
    return base + _steps(trees, *_columns(trees, er, ef, ev, n), np.arange(n))


def feature_bins(rows: DataFrame, max_bins: int = 16) -> DataFrame:
    """(feature, ends array<double>): ascending distinct values at which a bin
    of a feature's nonzero values begins, at most ``max_bins``."""
    each = rows.select(F.explode(F.arrays_zip("idx", "val")).alias("e")).select(F.col("e.idx").alias("feature"), F.col("e.val").alias("v"))
    probs = F.array(*[F.lit(i / max_bins) for i in range(max_bins)])
    return each.groupBy("feature").agg(F.array_distinct(F.percentile_approx("v", probs)).alias("ends"))


def fit_boosted_cells(rows: DataFrame, n_cells: int, trees: int = 20, leaves: int = 8, rate: float = 0.1, l2: float = 1.0,
                      min_rows: int = 20, max_bins: int = 16) -> dict:
    """{cell: (base margin, trees)} for ``rows`` (idx, val, cells, labels);
    cells without both labels have no model. A leaf's value is the Newton step
    −G / (H + l2) times ``rate``; a split needs ``min_rows`` rows on each side
    and a positive gain G²/(H + l2), left plus right minus whole."""
    import numpy as np

    bins = {r.feature: np.array(sorted(r.ends)) for r in feature_bins(rows, max_bins).toLocalIterator()}
    start = (rows.select(F.explode(F.arrays_zip("cells", "labels")).alias("m")).groupBy(F.col("m.cells").alias("cell"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("m.labels").alias("p")).collect())
    models = {r.cell: (float(np.log(r.p / (r.n - r.p))), []) for r in start if r.cell < n_cells and 0 < r.p < r.n}
    bases = {c: m[0] for c, m in models.items()}
    # margins of a row, in the order of its cells
    known = F.create_map(*[x for c, b in sorted(bases.items()) for x in (F.lit(c), F.lit(b))]) if bases else F.create_map(F.lit(-1), F.lit(0.0))
    state = stage_table(rows.select("idx", "val", "cells", "labels", F.transform("cells", lambda c: F.coalesce(F.try_element_at(known, c), F.lit(0.0))).alias("margins")), "boost-rows")
    pending: dict = {c: [] for c in models}  # trees that the stored margins do not hold yet
    growing = {c: _Tree() for c in models} if trees else {}
    while growing:
        wanted = {c: t.fresh for c, t in growing.items()}
        found = best_splits(histograms(state, {c: t.nodes for c, t in growing.items()}, pending, wanted, bins), l2, min_rows).collect()  # one row per new leaf
        for c in list(growing):
            tree = growing[c]
            tree.split({r.leaf: r for r in found if r.cell == c}, bins, leaves)
            if not tree.fresh:  # a cell goes on with its next tree while others still grow theirs
                models[c][1].append(tree.finished(rate, l2))
                pending[c].append(models[c][1][-1])
                growing[c] = _Tree()
                if len(models[c][1]) == trees:
                    del growing[c]
        if growing and max(len(pending[c]) for c in growing) >= ADVANCE:
            before, state = state, stage_table(_advance(state, pending), "boost-rows")
            release(before)
            pending = {c: [] for c in models}
    release(state)
    return models


def _advance(state: DataFrame, pending: dict) -> DataFrame:
    """The rows with their margins moved by the new trees."""
    at = [state.columns.index(c) for c in ("idx", "val", "cells", "margins")]
    held = state.sparkSession.sparkContext.broadcast(pending)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            er, ef, ev, mr, mc, mm = _batch(batch, at)
            mm = mm.copy()
            known = _columns([t for c in np.unique(mc) for t in held.value.get(int(c), [])], er, ef, ev, batch.num_rows)
            for c in np.unique(mc):
                mm[mc == c] += _steps(held.value.get(int(c), []), *known, mr[mc == c])
            cells = batch.column(at[2])
            offsets = pa.array(np.asarray(cells.offsets) - np.asarray(cells.offsets)[0], pa.int32())
            cols = list(batch.columns)
            cols[at[3]] = pa.ListArray.from_arrays(offsets, pa.array(mm, pa.float64()))
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return state.mapInArrow(run, state.schema)


def histograms(state: DataFrame, trees: dict, pending: dict, wanted: dict, bins: dict) -> DataFrame:
    """(cell, leaf, feature, bin, g, h, n) summed over the rows that end in a
    wanted leaf (``{cell: set of leaves}``) of its cell's tree, at the stored
    margins and the ``pending`` trees; feature −1 holds the leaf's sums. Bins
    count from 0; rows where a feature is 0 are in none."""
    at = [state.columns.index(c) for c in ("idx", "val", "cells", "labels")]
    at_margin = state.columns.index("margins")
    held = state.sparkSession.sparkContext.broadcast((trees, pending, wanted, bins))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        trees, pending, wanted, bins = held.value
        features = np.array(sorted(bins), dtype=np.int64)
        widest = max((len(b) for b in bins.values()), default=1)
        ends = np.full((len(features), widest), np.inf)
        for i, f in enumerate(features.tolist()):
            ends[i, :len(bins[f])] = bins[f]
        width = len(features) * widest
        total: dict = {}
        for batch in batches:
            er, ef, ev, mr, mc, ml = _batch(batch, at)
            mm = batch.column(at_margin).flatten().to_numpy(zero_copy_only=False)
            n, slot = batch.num_rows, np.searchsorted(features, ef)
            code = slot * widest + np.maximum((ends[slot] <= ev[:, None]).sum(axis=1) - 1, 0)
            sizes = np.bincount(er, minlength=n)
            starts = np.cumsum(sizes) - sizes
            here = [c for c in np.unique(mc).tolist() if c in wanted]
            known = _columns([t for c in here for t in (trees[c], *pending.get(c, []))], er, ef, ev, n)
            for c in here:
                of_cell = mc == c
                who, y, z = mr[of_cell], ml[of_cell], mm[of_cell]
                p = 1.0 / (1.0 + np.exp(-(z + _steps(pending.get(c, []), *known, who))))
                leaves = sorted(wanted[c])
                place = np.full(len(trees[c]), -1)
                place[leaves] = np.arange(len(leaves))
                at_leaf = place[leaves_of(trees[c], *known, who)]
                inside = at_leaf >= 0
                who, at_leaf, p, y = who[inside], at_leaf[inside], p[inside], y[inside]
                e, of = _entries(starts, sizes, who)
                cell_code = at_leaf[of] * width + code[e]
                sums = total.setdefault(c, {})
                for leaf in leaves:
                    sums.setdefault(leaf, np.zeros((3, width + 1)))
                for k, x in enumerate((p - y, p * (1 - p), None)):
                    parts = np.bincount(cell_code, None if x is None else x[of], minlength=len(leaves) * width).reshape(len(leaves), width)
                    whole = np.bincount(at_leaf, x, minlength=len(leaves))
                    for i, leaf in enumerate(leaves):
                        sums[leaf][k, :-1] += parts[i]
                        sums[leaf][k, -1] += whole[i]
        for c, leaf, sums in ((c, leaf, x) for c, by_leaf in total.items() for leaf, x in by_leaf.items()):
            j = np.flatnonzero(sums[2])
            last = j == sums.shape[1] - 1
            feature = np.where(last, -1, np.append(features, 0)[np.minimum(j // widest, len(features))])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), c, np.int32)), pa.array(np.full(len(j), leaf, np.int32)),
                                              pa.array(feature.astype(np.int32)), pa.array(np.where(last, 0, j % widest).astype(np.int32)),
                                              *[pa.array(sums[k, j]) for k in range(3)]], names=["cell", "leaf", "feature", "bin", "g", "h", "n"])

    return (state.mapInArrow(run, "cell int, leaf int, feature int, bin int, g double, h double, n double")
            .groupBy("cell", "leaf", "feature", "bin").agg(*[F.sum(x).alias(x) for x in ("g", "h", "n")]))


def best_splits(hist: DataFrame, l2: float, min_rows: int) -> DataFrame:
    """(cell, leaf, g, h, n, split): the leaf's sums, and the split of largest
    gain: struct (gain, feature, bin, and the right side's g, h, n); null if
    none has a gain. Right are the rows whose value is in the bin or a later
    one; ties go to the smaller feature, then the smaller bin."""
    leaf = Window.partitionBy("cell", "leaf")
    later = Window.partitionBy("cell", "leaf", "feature").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    own = F.col("feature") == -1
    # one exchange by (cell, leaf); a leaf has at most features × bins rows
    at = hist.select("*", *[F.max(F.when(own, F.col(x))).over(leaf).alias(f"all_{x}") for x in ("g", "h", "n")],
                     *[F.sum(x).over(later).alias(f"right_{x}") for x in ("g", "h", "n")])
    g, h, n, all_g, all_h, all_n = (F.col(x) for x in ("right_g", "right_h", "right_n", "all_g", "all_h", "all_n"))
    score = lambda g, h: g * g / (h + l2)
    gain = score(g, h) + score(all_g - g, all_h - h) - score(all_g, all_h)
    fits = ~own & (n >= min_rows) & (all_n - n >= min_rows) & (gain > 1e-9)
    best = F.max(F.when(fits, F.struct(F.round(gain, 9).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"),
                                       g.alias("g"), h.alias("h"), n.alias("n"))))
    return at.groupBy("cell", "leaf", "all_g", "all_h", "all_n").agg(best.alias("s")).select(
        "cell", "leaf", all_g.alias("g"), all_h.alias("h"), all_n.alias("n"),
        F.when(F.col("s").isNotNull(), F.struct(F.col("s.gain").alias("gain"), (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"),
                                                F.col("s.g").alias("g"), F.col("s.h").alias("h"), F.col("s.n").alias("n"))).alias("split"))


#: Trees after which the rows' margins are written anew.
ADVANCE = 5


@dataclass
class _Tree:
    """A tree that grows: its nodes, and the leaves whose sums are wanted."""
    nodes: list = field(default_factory=lambda: [0.0])
    fresh: set = field(default_factory=lambda: {0})
    known: dict = field(default_factory=dict)  # {leaf: its sums and best split}
    sums: dict = field(default_factory=dict)  # {leaf: (g, h)}

    def split(self, found: dict, bins: dict, leaves: int):
        """The rows of the fresh leaves have come in: the open leaves of
        largest gain are split, as many as the tree may have."""
        self.known |= found
        self.sums |= {leaf: (r.g, r.h) for leaf, r in found.items()}
        self.fresh = set()
        free = leaves - sum(not isinstance(x, tuple) for x in self.nodes)
        able = sorted((r for leaf, r in self.known.items() if r.split is not None and not isinstance(self.nodes[leaf], tuple)),
                      key=lambda r: (-r.split.gain, r.leaf))
        for r in able[:max(0, free)]:
            s, left, right = r.split, len(self.nodes), len(self.nodes) + 1
            self.nodes[r.leaf] = (s.feature, float(bins[s.feature][s.bin]) if s.bin else SMALLEST, left, right)
            self.nodes += [0.0, 0.0]
            self.sums[right], self.sums[left] = (s.g, s.h), (r.g - s.g, r.h - s.h)
            self.fresh |= {left, right}
        if free <= len(able):  # the tree has its leaves: no histogram is needed for the last ones
            self.fresh = set()

    def finished(self, rate: float, l2: float) -> list:
        return [x if isinstance(x, tuple) else -rate * self.sums[leaf][0] / (self.sums[leaf][1] + l2) for leaf, x in enumerate(self.nodes)]


def score_boosted_cells(rows: DataFrame, models: dict) -> DataFrame:
    """Scores of ``rows`` (idx, val, for_cells) under the trees of their cells."""
    return _score(rows, models, _boosted, max(1, len(models)))
