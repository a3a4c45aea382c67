"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of about ``PASSAGE`` bytes that cover the whole
text. Each passage is encoded by a learned layer over its counts of character
classes, class pairs and repeated words; gated attention (tanh gate times
sigmoid gate, a softmax over the document) weighs the passages, and a logistic
unit scores the weighted sum. Labels are known for documents only; encoder,
attention and classifier are learned together from them.

The fit takes a bounded sample of labelled rows: the ``FIT_DOCS`` rows with the
smallest hash of (document, label), at most ``FIT_BYTES`` of text together.
Scoring reads every text in full.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm.common import arrow_slices

PASSAGE = 600
FIT_DOCS = 6000
FIT_BYTES = 24 << 20
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY = 32, 16, 30, 128, 3e-3, 1e-4
#: Character classes: one per byte value that tells texts from junk apart.
N_CLASSES = 24
PAIRS = N_CLASSES * N_CLASSES
EXTRA = 3
FEATURES = PAIRS + EXTRA


def byte_classes():
    """Class of every byte: vowels, consonants, capitals, digits, white space,
    bytes of multi-byte characters, and the common signs one by one."""
    import numpy as np

    of = np.full(256, 0, dtype=np.int64)  # 0: rare signs and controls
    of[128:] = 1
    for c in range(26):
        of[ord("a") + c], of[ord("A") + c] = 2, 3
    for c in b"aeiouy":
        of[c] = 4
    of[ord("0"):ord("9") + 1] = 5
    of[ord(" ")], of[ord("\n")] = 6, 7
    for k, c in enumerate(b".,!?:;'\"-|#*$%&<"):
        of[c] = 8 + k
    return of


def encode_bags(texts: list[bytes]):
    """(features per passage, passages per text). Every text has at least one
    passage; an empty one gives a passage of zeros."""
    import numpy as np

    of = byte_classes()
    feats, counts = [], []
    for text in texts:
        n = max(1, round(len(text) / PASSAGE))
        counts.append(n)
        x = np.zeros((n, FEATURES), dtype=np.float32)
        if text:
            cls = of[np.frombuffer(text, dtype=np.uint8)]
            part = np.arange(len(cls)) * n // len(cls)
            pair = cls[:-1] * N_CLASSES + cls[1:]
            np.add(x[:, :PAIRS], np.bincount(part[1:] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS), out=x[:, :PAIRS])
            cuts = [len(text) * k // n for k in range(n + 1)]
            for k in range(n):
                words = text[cuts[k]:cuts[k + 1]].split()
                if words:
                    kinds = len(set(words))
                    x[k, PAIRS] = 1 - kinds / len(words)
                    x[k, PAIRS + 1] = sum(map(bytes.__eq__, words, words[1:])) / len(words)
                    x[k, PAIRS + 2] = min(2.0, len(b"".join(words)) / len(words) / 10)
        feats.append(x)
    out = np.concatenate(feats) if feats else np.zeros((0, FEATURES), np.float32)
    total = out[:, :PAIRS].sum(axis=1, keepdims=True)
    out[:, :PAIRS] = np.sqrt(out[:, :PAIRS] / np.maximum(total, 1))
    return out, np.array(counts, dtype=np.int64)


def forward(p: dict, x, counts):
    """Scores of all bags and what the gradient needs."""
    import numpy as np

    starts = np.cumsum(counts) - counts
    h = np.tanh(x @ p["We"] + p["be"])
    t, g = np.tanh(h @ p["Wt"]), 1 / (1 + np.exp(-(h @ p["Wg"])))
    a = (t * g) @ p["wa"]
    a = np.exp(a - np.repeat(np.maximum.reduceat(a, starts), counts))
    a /= np.repeat(np.add.reduceat(a, starts), counts)
    z = np.add.reduceat(h * a[:, None], starts)
    return 1 / (1 + np.exp(-(z @ p["w"] + p["b"]))), (h, t, g, a, z, starts)


def fit_bags(x, counts, labels, seed: int = 1) -> dict:
    """Parameters by Adam on the logistic loss; repeatable for the same bags
    in the same order. ``x`` may be float16: rows become float32, scaled, batch
    by batch, so the sample is held once and small."""
    import numpy as np

    rng = np.random.default_rng(seed)
    n, starts = len(counts), np.cumsum(counts) - counts
    mean = x.mean(axis=0, dtype=np.float64).astype(np.float32)
    square = sum((x[i:i + 1024].astype(np.float64) ** 2).sum(axis=0) for i in range(0, len(x), 1024)) / len(x)
    std = (np.sqrt(np.maximum(square - mean.astype(np.float64) ** 2, 0)) + 1e-3).astype(np.float32)
    p = {"We": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "be": np.zeros(HIDDEN),
         "Wt": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "Wg": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "wa": rng.normal(0, GATE ** -0.5, GATE), "w": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "b": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m1, m2, step = {k: 0 * v for k, v in p.items()}, {k: 0 * v for k, v in p.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            bags = order[at:at + BATCH]
            c = counts[bags]
            rows = np.arange(c.sum()) + np.repeat(starts[bags] - (np.cumsum(c) - c), c)
            xb = (x[rows].astype(np.float32) - mean) / std
            s, (h, t, g, a, z, first) = forward(p, xb, c)
            dz1 = ((s - labels[bags]) / len(bags)).astype(np.float32)
            dz = dz1[:, None] * p["w"]
            da = (h * np.repeat(dz, c, axis=0)).sum(axis=1)
            de = a * (da - np.repeat(np.add.reduceat(a * da, first), c))
            dtg = de[:, None] * p["wa"]
            dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
            dh = (np.repeat(dz, c, axis=0) * a[:, None] + dt @ p["Wt"].T + dg @ p["Wg"].T) * (1 - h * h)
            grad = {"We": xb.T @ dh, "be": dh.sum(axis=0), "Wt": h.T @ dt, "Wg": h.T @ dg, "wa": (t * g).T @ de,
                    "w": z.T @ dz1, "b": dz1.sum(keepdims=True)}
            step += 1
            for k, v in grad.items():
                v = v + DECAY * p[k]
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.999 * m2[k] + 0.001 * v * v
                p[k] -= RATE * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    # fold the scaling into the encoder
    p["be"] = p["be"] - (mean / std) @ p["We"]
    p["We"] = p["We"] / std[:, None]
    return {k: v.astype(np.float32) for k, v in p.items()}


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_docs: int = FIT_DOCS) -> dict | None:
    """Model from labelled documents (label 0 or 1; other labels and nulls are
    ignored). None if no row is labelled; with one label only, a constant."""
    import numpy as np

    marks = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"))
    # the sample is chosen on ids alone, so texts of other rows are not moved
    pick = (documents.select(id_col).join(marks, F.col(id_col) == F.col("_id"))
            .select("_id", "_y").distinct().orderBy(F.xxhash64(F.lit(11), "_id", "_y"), "_id", "_y").limit(max_docs))
    taken = (documents.select(id_col, text_col).join(F.broadcast(pick), F.col(id_col) == F.col("_id"))
             .select(F.xxhash64(F.lit(11), "_id", "_y").alias("_h"), F.col("_id"), F.col("_y"),
                     F.coalesce(text_col, F.lit("")).alias("_t")))
    bytes_upto = F.sum(F.octet_length("_t")).over(_by_hash())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in arrow_slices(batches, 3):
            x, c = encode_bags([(t.as_py() or "").encode() for t in batch.column(3)])
            cuts = np.cumsum(c)[:-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                              pa.array([b.astype(np.float16).tobytes() for b in np.split(x, cuts)], pa.binary())],
                                             names=["h", "id", "y", "bag"])

    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("id", taken.schema["_id"].dataType),
                           T.StructField("y", taken.schema["_y"].dataType), T.StructField("bag", T.BinaryType())])
    kept = taken.withColumn("_n", bytes_upto).where(F.col("_n") <= FIT_BYTES).select("_h", "_id", "_y", "_t").mapInArrow(run, schema)
    rows = kept.toPandas().sort_values(["h", "id", "y", "bag"])
    if not len(rows):
        return None
    counts = np.array([len(b) // (2 * FEATURES) for b in rows["bag"]], dtype=np.int64)
    ys = rows["y"].to_numpy(np.int64)
    x, at = np.empty((counts.sum(), FEATURES), dtype=np.float16), 0
    for bag, n in zip(rows["bag"], counts, strict=True):
        x[at:at + n] = np.frombuffer(bag, dtype=np.float16).reshape(-1, FEATURES)
        at += n
    del rows
    y = np.array(ys, dtype=np.float32)
    if y.min() == y.max():
        return {"constant": float(y[0]) * 0.98 + 0.01}
    return fit_bags(x, counts, y)


def _by_hash():
    from pyspark.sql import Window

    return Window.orderBy("_h", "_id", "_y", F.xxhash64("_t")).rowsBetween(Window.unboundedPreceding, 0)


def add_score(df: DataFrame, model: dict | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """``df`` with a column ``name`` in 0 .. 1 (1: good), in one pass without a
    shuffle. A null text counts as empty; without a model every score is 0.5."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType(), False)])
    at = df.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in arrow_slices(batches, at, 1 << 20):
            if model is None or "constant" in model:
                s = np.full(batch.num_rows, 0.5 if model is None else model["constant"])
            else:
                s = forward(model, *encode_bags([(t.as_py() or "").encode() for t in batch.column(at)]))[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s.astype(np.float64))], names=[f.name for f in schema])

    return df.mapInArrow(run, schema)


def score(df: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: the id column and ``score``; see ``add_score``.
    Extra columns are left out, repeated rows are scored alike."""
    return add_score(df.select(id_col, text_col), model, text_col).select(id_col, "score")
