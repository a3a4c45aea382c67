"""Model averaging across sites, with weights as tables.

Weights are long rows (client, pos, value) with an example count n per
client. Averaging is a group-by on the position; server update rules that
carry state across rounds (momentum, Adam) are a fold over the (few) rounds
of each position with the ``aggregate`` higher-order function, JVM-side.

Update rules: FedAvgM (Hsu et al. 2019) and FedAdam (Reddi et al. 2020,
without bias correction); constants are parameters."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.functions.scalar import hash_unit
from timeloom.session import stage_table

__all__ = ["client_means", "fed_avg", "fed_avg_momentum", "fed_adam", "STRATEGIES",
           "subset_memberships", "FedRun", "fed_train", "fed_train_runs", "weighted_mean"]

# task functions travel with their helpers
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def weighted_mean(df: DataFrame, keys, value: str = "value", n: str = "n", out: str = "value") -> DataFrame:
    """Σ value·n / Σ n per key (clients report (value, n))."""
    return df.groupBy(*keys).agg((F.sum(F.col(value) * F.col(n)) / F.sum(n)).alias(out))


def client_means(rows: DataFrame, client: str, vec: str, by=()) -> DataFrame:
    """A client's local model in the simplest form: the mean of its vectors.
    (keys…, client, pos, value, n)."""
    by = list(by)
    ex = rows.select(*by, client, F.posexplode(vec).alias("pos", "x"))
    n = rows.groupBy(*by, client).agg(F.count(F.lit(1)).alias("n"))
    m = ex.groupBy(*by, client, "pos").agg(F.avg(F.col("x").cast("double")).alias("value"))
    return m.join(n, by + [client])


def fed_avg(weights: DataFrame, by=("pos",), value: str = "value", n: str = "n") -> DataFrame:
    """Example-weighted mean of client weights per position (full
    participation)."""
    return weighted_mean(weights, list(by), value, n)


def _fold(avg: DataFrame, by, init: Column, step, final) -> DataFrame:
    """Per position: fold ``step`` over the rounds in order, starting at
    ``init``; ``avg`` holds (by…, round, a)."""
    g = avg.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("round", "a"))).alias("_r"))
    return g.select(*by, F.aggregate("_r", init, step, final).alias("value"))


def fed_avg_momentum(avg: DataFrame, by=("pos",), lr: float = 1.0, momentum: float = 0.5,
                     x0: float = 0.0) -> DataFrame:
    """FedAvgM: g = x − a (pseudo-gradient), v ← β·v + g (v = g in round 1),
    x ← x − η·v. ``avg`` is the per-round FedAvg result (by…, round, a)."""
    init = F.struct(F.lit(x0).cast("double").alias("x"), F.lit(0.0).alias("v"), F.lit(0).alias("t"))

    def step(acc, r):
        g = acc["x"] - r["a"]
        v = F.when(acc["t"] == 0, g).otherwise(F.lit(momentum) * acc["v"] + g)
        return F.struct((acc["x"] - F.lit(lr) * v).alias("x"), v.alias("v"), (acc["t"] + 1).alias("t"))

    return _fold(avg, list(by), init, step, lambda acc: acc["x"])


def fed_adam(avg: DataFrame, by=("pos",), eta: float = 0.1, beta_1: float = 0.9,
             beta_2: float = 0.99, tau: float = 1e-9, x0: float = 0.0) -> DataFrame:
    """FedAdam: Δ = a − x, m ← β₁m + (1−β₁)Δ, v ← β₂v + (1−β₂)Δ²,
    x ← x + η·m / (√v + τ)."""
    init = F.struct(F.lit(x0).cast("double").alias("x"), F.lit(0.0).alias("m"), F.lit(0.0).alias("v"))

    def step(acc, r):
        d = r["a"] - acc["x"]
        m = F.lit(beta_1) * acc["m"] + F.lit(1 - beta_1) * d
        v = F.lit(beta_2) * acc["v"] + F.lit(1 - beta_2) * d * d
        return F.struct((acc["x"] + F.lit(eta) * m / (F.sqrt(v) + F.lit(tau))).alias("x"),
                        m.alias("m"), v.alias("v"))

    return _fold(avg, list(by), init, step, lambda acc: acc["x"])


def _server_avg(x, m, v, a):
    return a, m, v


def _server_momentum(x, m, v, a, lr: float = 1.0, momentum: float = 0.5):
    step = F.lit(momentum) * m + (x - a)
    return x - F.lit(lr) * step, step, v


def _server_adam(x, m, v, a, eta: float = 0.1, beta_1: float = 0.9, beta_2: float = 0.99, tau: float = 1e-9):
    d = a - x
    m2 = F.lit(beta_1) * m + F.lit(1 - beta_1) * d
    v2 = F.lit(beta_2) * v + F.lit(1 - beta_2) * d * d
    return x + F.lit(eta) * m2 / (F.sqrt(v2) + F.lit(tau)), m2, v2


#: Server rules by name: from a position's weight x, its two state values m
#: and v (0 before the first round) and the clients' average a to the new x, m, v.
STRATEGIES = {"fedavg": _server_avg, "fedavgm": _server_momentum, "fedadam": _server_adam}


def subset_memberships(clients: list, size: int = 2) -> list[tuple[str, list]]:
    """Federations over every ``size``-subset of a (short) client list."""
    from itertools import combinations
    return [("+".join(map(str, c)), list(c)) for c in combinations(clients, size)]


@dataclass(frozen=True)
class FedRun:
    """One federation: its number of rounds, the clients' gradient steps a
    round, the first rate (then a cosine down to 0) and the server's rule."""
    n_rounds: int = 3
    local_steps: int = 2
    base_lr: float = 0.5
    strategy: str = "fedavg"


def fed_train(rows: DataFrame, client: str, features: str, label: str, dim: int,
              n_rounds: int = 3, local_steps: int = 2, base_lr: float = 0.5,
              seed: int = 0, key: str = "id", strategy: str = "fedavg"):
    """Federated logistic regression; see ``fed_train_runs``. Returns
    (weights, per-round (round, lr, loss))."""
    w, rounds = fed_train_runs(rows, client, features, label, dim, {"run": FedRun(n_rounds, local_steps, base_lr, strategy)}, seed, key)
    return w.drop("run"), rounds.drop("run")


def fed_train_runs(rows: DataFrame, client: str, features: str, label: str, dim: int, runs: dict[str, FedRun],
                   seed: int = 0, key: str = "id"):
    """Federated logistic regression of many runs side by side, one job per
    local step for all of them.

    In round r of a run every client takes its gradient steps, full batch, on
    shard r of its rows (a seeded hash splits rows into the run's number of
    rounds), starting from the global weights; the server averages the client
    weights by example count and updates the global weights by the run's
    strategy, whose state (m, v) it keeps from round to round. Clients without
    rows in a shard take no part in that round; rows without features or label
    in none. After each round the logistic
    loss over all rows is taken, in the next round's first job.

    A task adds its rows' gradients up to one vector per (run, client); these
    are summed by position. Weights of clients and server (runs × clients ×
    (dim + 1) numbers) are the driver's, as the server's are; they do not grow
    with the rows. Returns ((run, pos, value), (run, round, lr, loss))."""
    for run in runs.values():
        if run.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {run.strategy!r}; known: {sorted(STRATEGIES)}")
    import numpy as np

    spark = rows.sparkSession
    rows = rows.where(F.col(features).isNotNull() & F.col(label).isNotNull())
    base = stage_table(rows.select(F.col(client).cast("string").alias("client"), F.col(features).cast("array<double>").alias("x"),
                                   F.col(label).cast("double").alias("y"), hash_unit(key, seed).alias("u")), "fed-rows")
    # global weights and server state: rows x, m, v
    state = {name: np.zeros((3, dim + 1)) for name in runs}
    done, due = [], {}  # due: weights whose loss the next job takes
    for r in range(1, max(run.n_rounds for run in runs.values()) + 1):
        now = {name: run for name, run in runs.items() if r <= run.n_rounds}
        rate = {name: run.base_lr * 0.5 * (1 + math.cos(math.pi * (r - 1) / run.n_rounds)) for name, run in now.items()}
        local: dict = {}
        for step in range(max(run.local_steps for run in now.values())):
            going = {name: run for name, run in now.items() if step < run.local_steps}
            work = {name: (run.n_rounds, r, state[name][0], {c: w for (n, c), (_, w) in local.items() if n == name}) for name, run in going.items()}
            got, losses = _fed_sums(base, work, due, dim)
            done += [(name, at, lr, losses[name]) for name, (at, lr, _) in due.items()]
            due = {}
            for (name, c), (n, g) in got.items():
                w = local[name, c][1] if (name, c) in local else state[name][0]
                local[name, c] = n, w - rate[name] * g / n
        averages = {}
        for name in now:
            mine = [x for (n, _), x in local.items() if n == name]
            if mine:
                averages[name] = sum(n * w for n, w in mine) / sum(n for n, _ in mine)
        state |= _serve(spark, {name: (runs[name].strategy, state[name], a) for name, a in averages.items()})
        due = {name: (r, rate[name], state[name][0]) for name in now}
    _, losses = _fed_sums(base, {}, due, dim)
    done += [(name, at, lr, losses[name]) for name, (at, lr, _) in due.items()]
    weights = [(name, i, float(x)) for name, s in state.items() for i, x in enumerate(s[0])]
    return (spark.createDataFrame(weights, "run string, pos int, value double"),
            spark.createDataFrame(sorted(done), "run string, round int, lr double, loss double"))


def _fed_sums(base: DataFrame, work: dict, due: dict, dim: int):
    """({(run, client): (rows, gradient)}, {run: mean loss}) in one job: ``work``
    is {run: (rounds, round, global weights, {client: weights})}, ``due``
    {run: (round, rate, weights)}."""
    import numpy as np

    held = base.sparkSession.sparkContext.broadcast((work, {name: w for name, (_, _, w) in due.items()}))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        work, due = held.value
        sums: dict = {}

        def add(key, n, v):
            old = sums.get(key)
            sums[key] = (n, v) if old is None else (old[0] + n, old[1] + v)

        for batch in batches:
            if not batch.num_rows:
                continue
            client = np.array(batch.column(0).to_pylist(), dtype=object)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            y, u = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False)
            for name, (rounds, r, w0, own) in work.items():
                shard = np.floor(u * rounds) + 1 == r
                for c in set(client[shard].tolist()):
                    mine = shard & (client == c)
                    w = own.get(c, w0)
                    err = 1.0 / (1.0 + np.exp(-(x[mine] @ w[:dim] + w[dim]))) - y[mine]
                    add((name, c, False), int(mine.sum()), np.append(x[mine].T @ err, err.sum()))
            for name, w in due.items():
                p = np.clip(1.0 / (1.0 + np.exp(-(x @ w[:dim] + w[dim]))), 1e-12, 1 - 1e-12)
                add((name, "", True), len(y), np.array([-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()]))
        for (name, c, loss), (n, v) in sums.items():
            yield pa.RecordBatch.from_pydict({"run": [name], "client": pa.array([c], pa.string()), "loss": [loss], "n": [n], "v": pa.array([v.tolist()], pa.list_(pa.float64()))})

    parts = base.mapInArrow(run, "run string, client string, loss boolean, n long, v array<double>")
    got = (parts.select("run", "client", "loss", "n", F.posexplode("v").alias("pos", "g")).groupBy("run", "client", "loss", "pos")
           .agg(F.sum("n").alias("n"), F.sum("g").alias("g")).collect())
    held.unpersist()
    sums, losses = {}, {name: None for name in due}
    for x in got:
        if x.loss:
            losses[x.run] = x.g / x.n
        else:
            sums.setdefault((x.run, x.client), (x.n, np.zeros(dim + 1)))[1][x.pos] = x.g
    return sums, losses


def _serve(spark, steps: dict) -> dict:
    """The servers' new states: {run: (strategy, state, clients' average)}
    through the strategies' rules, one small job for all runs."""
    import numpy as np

    rows = [(name, how, i, *map(float, s[:, i]), float(a[i])) for name, (how, s, a) in steps.items() for i in range(len(a))]
    if not rows:
        return {}
    df = spark.createDataFrame(rows, "run string, how string, pos int, x double, m double, v double, a double")
    cols = [F.col(c) for c in ("x", "m", "v", "a")]
    new = reduce(lambda a, b: a.unionAll(b), [
        df.where(F.col("how") == how).select("run", "pos", *[c.alias(n) for c, n in zip(STRATEGIES[how](*cols), ("x", "m", "v"), strict=True)])
        for how in sorted({how for how, _, _ in steps.values()})])
    out = {name: np.zeros_like(s) for name, (_, s, _) in steps.items()}
    for r in new.collect():
        out[r.run][:, r.pos] = r.x, r.m, r.v
    return out
