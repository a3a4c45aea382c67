"""Language identification by prediction by partial matching (PPM).

Each language has a context tree of bytes: for contexts of 0 to 3 bytes, how
often each byte followed. A text's code length under a language is the sum over
its bytes of the cost in the longest known context; where the byte was not seen
there, the escape cost is paid and the next shorter context is asked, down to
256 equally likely bytes. Escapes follow method C: with T occurrences and d
different bytes after a context, a byte seen c times costs -log2(c / (T + d))
and an escape -log2(d / (T + d)). The counts are frozen after training, so code
lengths are exact and add up. The language with the shortest code wins.

Counts cover every training text in full and are combined by Spark. The trees
are cut to ``NODES`` (context, byte) nodes in all, shared equally by languages
and orders, the most frequent first and ties to the smaller key; that bounds
what is sent to the tasks, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm.common import arrow_slices

ORDER = 3
NODES = 1_000_000
#: Bits of the lookup table of known four-byte keys.
TABLE_BITS = 20


def _keys(texts: list[bytes]):
    """(order-3 keys of all bytes, number of bytes per text): the byte under
    the three before it, zeros before the first."""
    import numpy as np

    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.frombuffer(b"".join(b"\0\0\0" + t for t in texts), dtype=np.uint8).astype(np.uint32)
    if not len(flat):
        return np.zeros(0, np.uint32), sizes
    keys = flat.copy()
    for back in range(1, 4):
        keys[back:] |= flat[:-back] << np.uint32(8 * back)
    ends = np.cumsum(sizes + 3)
    lead = (ends - sizes - 3)[:, None] + np.arange(3)
    inside = np.ones(len(flat), dtype=bool)
    inside[lead.ravel()] = False
    return keys[inside], sizes


def count_contexts(training: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, order, key, n) over whole texts; key holds the context's bytes
    and, lowest, the byte that followed. Null texts and languages add nothing.
    Tasks combine their own counts first."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: dict[str, list] = {}

        def merged(parts):
            keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

        for batch in arrow_slices(batches, 1):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if (t := text.as_py()) is not None:
                    by.setdefault(lang, []).append(t.lower().encode())
            for lang, texts in by.items():
                parts = held.setdefault(lang, [])
                parts.append(np.unique(_keys(texts)[0], return_counts=True))
                if len(parts) >= 8:
                    held[lang] = [merged(parts)]
        for lang, parts in held.items():
            keys, n = merged(parts)
            for at in range(0, len(keys), 100_000):
                some = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys[some]), pa.string()), pa.array(keys[some].astype(np.int64)),
                                                  pa.array(n[some])], names=["lang", "key", "n"])

    rows = training.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string"), text_col)
    longest = (rows.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")))
    orders = F.explode(F.array(*[F.struct(F.lit(o).alias("order"), F.col("key").bitwiseAND(F.lit((1 << 8 * (o + 1)) - 1)).alias("k"))
                                 for o in range(ORDER + 1)])).alias("o")
    return (longest.select("lang", "n", orders).groupBy("lang", F.col("o.order").alias("order"), F.col("o.k").alias("key"))
            .agg(F.sum("n").alias("n")))


class Trees:
    """Frozen counts of all languages; ``lengths`` gives code lengths."""

    def __init__(self, counts: dict[str, list[tuple]]):
        """counts: language to, per order, sorted keys and their counts."""
        import numpy as np

        self.langs = sorted(counts)
        self.nodes = []
        for lang in self.langs:
            orders = []
            for keys, n in counts[lang]:
                contexts, at = np.unique(keys >> 8, return_inverse=True)
                total, kinds = np.bincount(at, n), np.bincount(at)
                both = total + kinds
                orders.append((keys, np.log2(both[at] / n) if len(keys) else np.zeros(0), contexts,
                               np.log2(both / kinds) if len(keys) else np.zeros(0)))
            self.nodes.append(orders)
        self.known = None

    def _prepare(self):
        """The lookup table of known keys, built by each task process that
        needs it and not sent with the model."""
        import numpy as np

        self.known = np.unique(np.concatenate([np.zeros(0, np.int64)] + [o[ORDER][0] for o in self.nodes]))
        self.known_bits = self.price(self.known)
        self.slot_key = np.full(1 << TABLE_BITS, -1, dtype=np.int64)
        self.slot_row = np.zeros(1 << TABLE_BITS, dtype=np.int32)
        slots = self._slots(self.known.astype(np.uint32))
        self.slot_key[slots] = self.known
        self.slot_row[slots] = np.arange(len(self.known))

    @staticmethod
    def _slots(keys):
        import numpy as np

        return (keys * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)

    @staticmethod
    def _find(sorted_keys, keys):
        import numpy as np

        if not len(sorted_keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return at, sorted_keys[at] == keys

    def price(self, keys):
        """Bits of each key's last byte after its first three: [lang][key]."""
        import numpy as np

        out = np.zeros((len(self.langs), len(keys)))
        for row, orders in zip(out, self.nodes, strict=True):
            todo = np.arange(len(keys))
            for o in range(ORDER, -1, -1):
                own, bits, contexts, escape = orders[o]
                part = keys[todo] & ((1 << 8 * (o + 1)) - 1)
                at, seen = self._find(own, part)
                row[todo[seen]] += bits[at[seen]] if len(bits) else 0
                todo, part = todo[~seen], part[~seen]
                at, met = self._find(contexts, part >> 8)
                row[todo[met]] += escape[at[met]] if len(escape) else 0
            row[todo] += 8.0
        return out

    def lengths(self, texts: list[bytes]):
        """Code length in bits of each text under each language: [lang][text]."""
        import numpy as np

        if self.known is None:
            self._prepare()
        keys, sizes = _keys(texts)
        slots = self._slots(keys)
        rows = self.slot_row[slots]
        missed = np.flatnonzero(self.slot_key[slots] != keys)
        prices = self.known_bits
        if len(missed):
            others, back = np.unique(keys[missed].astype(np.int64), return_inverse=True)
            rows[missed] = prices.shape[1] + back
            prices = np.concatenate([prices, self.price(others)], axis=1)
        out = np.zeros((len(self.langs), len(texts)))
        full = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[full]
        for line, price in zip(out, prices, strict=True):
            if len(full):
                line[full] = np.add.reduceat(price[rows], starts)
        return out


def train(training: DataFrame, lang_col: str = "lang", text_col: str = "text", nodes: int = NODES) -> dict[str, list[tuple]]:
    """Counts of every language in ``training`` (none: empty), as ``Trees``
    takes them."""
    import numpy as np

    counts = count_contexts(training, lang_col, text_col)
    n_langs = training.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).agg(F.count_distinct(lang_col)).first()[0]
    each = max(1, nodes // max(1, n_langs * (ORDER + 1)))
    rank = F.row_number().over(Window.partitionBy("lang", "order").orderBy(F.desc("n"), "key"))
    kept = counts.withColumn("_r", rank).where(F.col("_r") <= each).select("lang", "order", "key", "n").toPandas()
    out: dict[str, list[tuple]] = {}
    for lang, own in kept.groupby("lang"):
        out[lang] = []
        for o in range(ORDER + 1):
            part = own[own["order"] == o].sort_values("key")
            out[lang].append((part["key"].to_numpy(np.int64), part["n"].to_numpy(np.int64)))
    return out


def predict(df: DataFrame, counts: dict[str, list[tuple]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, lang_pred, score.

    The score is the language's share of 2 ** -length over all languages.
    ``und`` with score 0 if the text is null or has no letter, or if no
    language was learned; equal lengths go to the smaller name. Repeated rows
    are scored alike, extra columns are left out."""
    schema = T.StructType([df.schema[id_col], T.StructField("lang_pred", T.StringType(), False),
                           T.StructField("score", T.DoubleType(), False)])
    shared = df.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        model = Trees(shared.value)
        for batch in arrow_slices(batches, 1):
            langs, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            texts = {i: t.lower().encode() for i, x in enumerate(batch.column(1))
                     if model.langs and (t := x.as_py()) is not None and any(map(str.isalpha, t))}
            if texts:
                bits = model.lengths(list(texts.values()))
                share = np.exp2(bits.min(axis=0) - bits)
                share /= share.sum(axis=0)
                for i, best, s in zip(texts, bits.argmin(axis=0), share.max(axis=0), strict=True):
                    langs[i], scores[i] = model.langs[best], s
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores)], names=[f.name for f in schema])

    return df.select(id_col, text_col).mapInArrow(run, schema)
