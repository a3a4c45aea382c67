"""Alignment of two tokenizations of the same texts, on Arrow tables.

Tokenizer A is byte-level BPE (a file of the tokenizers library) over a space
and the text, B is BPE with byte fallback (a sentencepiece model) over the
text, which adds that space itself. Both cover the same bytes, so byte offsets
tie them together:

1. The tokens of a slice of documents are list columns. Flattened, with parent
   indices, their byte lengths give segmented cumulative sums: the byte offset
   in its document at which every token ends.
2. An Acero hash join (full outer) of A's and B's tokens on the document-end
   key (document, end) gives every offset at which a token ends. Filled
   backward in order, each such row is one overlap of an A and a B token, a
   link; rows found on both sides end a group.
3. ``Table.group_by`` counts each document's links by pair of ids. Documents
   are put into lots of a bounded number of pairs; a lot's pairs are counted
   by ``Table.group_by`` again, and Spark sums these partial counts.
4. The corpus-wide counts go back to the lots that hold the pair: per (lot,
   pair), not per (document, pair). A cogroup by lot joins them (Acero) to the
   documents' links.

No pair that is frequent, and no document that is repeated, makes a large
group: counts are summed within tasks first, and a lot has a bounded size.

Both tokenizers work piece by piece: neither looks across a place where a space
follows a character that is not white space (A's splitter breaks there; no
piece of B has a space after its beginning, which is checked when it is read).
A task therefore encodes every distinct piece once. Plain ASCII pieces go
through A's merge table with tiktoken, in one call for thousands of them,
others through the tokenizers library.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.common import arrow_slices, per_process
from timeloom.llm.words import byte_symbols
from timeloom.session import stage_table

#: White space of the tokenizer's splitter (the Unicode property).
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
#: Pieces that a task remembers before it starts anew.
PIECES_KEPT = 200_000
#: Text of a slice, in bytes, and pairs of a lot.
SLICE_BYTES = 1 << 20
LOT_PAIRS = 1_000_000
SPACE_MARK = "▁"


def piece_bytes(model) -> list[bytes]:
    """Bytes of every id of a sentencepiece model."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
    return out


def pieces_of(text: str) -> list[str]:
    """The pieces of a text, each without the space before it: cut at every
    space that follows a character other than white space; white space at the
    end stays with the last piece."""
    out, held = [], None
    for part in text.split(" "):
        held = part if held is None else f"{held} {part}"
        if part and part[-1] not in WHITE:
            out.append(held)
            held = None
    if held is not None:
        out.append(f"{out.pop()} {held}" if out else held)
    return out


def load(path_a: str, path_b: str) -> tuple:
    """(A's library tokenizer, A's table in tiktoken or None, B, whether B
    needs whole texts, bytes of A's and B's ids as Arrow arrays, their sizes)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import numpy as np
    import pyarrow as pa
    import sentencepiece
    import tiktoken
    import tokenizers

    with open(path_a, encoding="utf-8") as f:
        config = json.load(f)
    special = {t["id"] for t in config["added_tokens"]}
    symbols, vocab = byte_symbols(), config["model"]["vocab"]
    a = tokenizers.Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    bytes_a = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        if i not in special:
            bytes_a[i] = bytes(symbols[c] for c in token)
    pairs = [m if isinstance(m, list) else m.split(" ") for m in config["model"]["merges"]]
    ranked = [vocab[x + y] for x, y in pairs]
    plain = None
    if config["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and ranked == sorted(ranked):
        import public_tokenizers
        plain = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={b: i for i, b in enumerate(bytes_a) if b})
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    bytes_b = piece_bytes(model)
    whole = any(b" " in x.lstrip(b" ") for x in bytes_b)
    return (a, plain, model, whole, pa.array(bytes_a, pa.binary()), pa.array(bytes_b, pa.binary()),
            *(np.array([len(x) for x in t], np.int32) for t in (bytes_a, bytes_b)))


class Coder:
    """Both tokenizers of a task, over distinct pieces."""

    def __init__(self, path_a: str, path_b: str):
        import numpy as np

        self.np = np
        (self.a, self.plain, self.b, self.whole, self.bytes_a, self.bytes_b, self.size_a,
         self.size_b) = per_process(("align", path_a, path_b), lambda: load(path_a, path_b))
        self._forget()

    def _forget(self):
        np = self.np
        self.index: dict[str, int] = {}
        self.held = {k: [np.zeros(0, np.int32), np.zeros(1, np.int64)] for k in "ab"}

    def _encode_a(self, pieces: list[str]):
        np = self.np
        counts = np.zeros(len(pieces), np.int64)
        short = np.array([self.plain is not None and p.isascii() and p != "" and p[-1] not in WHITE for p in pieces], dtype=bool)
        joined = [" " + p for p, s in zip(pieces, short, strict=True) if s]
        got = np.array(self.plain.encode_ordinary("".join(joined)) if joined else [], dtype=np.int32)
        # a token ends at the end of every piece
        ends = np.searchsorted(np.cumsum(self.size_a[got]), np.cumsum([len(p) for p in joined])) + 1
        counts[short] = np.diff(ends, prepend=0)
        rest = [e.ids for e in self.a.encode_batch_fast([" " + p for p, s in zip(pieces, short, strict=True) if not s], add_special_tokens=False)]
        counts[~short] = [len(x) for x in rest]
        out, own = np.zeros(counts.sum(), np.int32), np.repeat(short, counts)
        out[own] = got
        out[~own] = np.array([x for ids in rest for x in ids], dtype=np.int32)
        return out, counts

    def _encode_b(self, pieces: list[str]):
        np = self.np
        got = self.b.encode(pieces, num_threads=1) if pieces else []
        return np.array([x for ids in got for x in ids], dtype=np.int32), np.array([len(x) for x in got], dtype=np.int64)

    def _split(self, texts):
        """(flat numbers of pieces, pieces per text)"""
        import pyarrow as pa
        import pyarrow.compute as pc

        np = self.np
        if self.whole:
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1), pa.int32()), texts)
        else:
            lists = pc.split_pattern(texts, " ")
        parts = lists.flatten().dictionary_encode()
        last = np.asarray(lists.offsets)[1:] - 1
        words = parts.dictionary.to_pylist()
        loose = np.array([w == "" or w[-1] in WHITE for w in words], dtype=bool)
        void = np.array([w == "" for w in words], dtype=bool)
        codes = parts.indices.to_numpy(zero_copy_only=False)
        bad = loose[codes] if len(codes) else np.zeros(0, bool)
        if len(codes):
            bad[last] = void[codes[last]]
        sizes = np.diff(np.asarray(lists.offsets))
        number = lambda w: self.index.setdefault(w, len(self.index))
        if not bad.any() or self.whole:
            at = np.fromiter(map(number, words), np.int64, len(words))
            return at[codes], sizes
        odd = np.zeros(len(texts), dtype=bool)
        odd[np.repeat(np.arange(len(texts)), sizes)[bad]] = True
        used = np.unique(codes[~np.repeat(odd, sizes)])
        at = np.zeros(len(words), np.int64)
        at[used] = [number(words[i]) for i in used]
        out = np.split(at[codes], np.cumsum(sizes)[:-1])
        for i in np.flatnonzero(odd):
            out[i] = np.array([number(p) for p in pieces_of(texts[i].as_py())], dtype=np.int64)
        return np.concatenate(out), np.array([len(x) for x in out])

    def encode(self, texts):
        """List columns of A's and B's ids of an Arrow string array without
        nulls or empty texts."""
        import pyarrow as pa

        np = self.np
        if len(self.index) > PIECES_KEPT:
            self._forget()
        known = len(self.index)
        every, per_text = self._split(texts)
        if len(self.index) > known:
            new = list(self.index)[known:]
            for k, (ids, counts) in (("a", self._encode_a(new)), ("b", self._encode_b(new))):
                held = self.held[k]
                held[0], held[1] = np.concatenate([held[0], ids]), np.concatenate([held[1], held[1][-1] + np.cumsum(counts)])
        out, upto = [], np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
        for ids, starts in self.held.values():
            sizes = np.diff(starts)[every]
            ends = np.cumsum(sizes)
            flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[every] - (ends - sizes), sizes)]
            offsets = np.concatenate([[0], ends])[upto].astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())))
        return out


def align(a, b, size_a, size_b):
    """The aligned ends of two list columns of ids over the same bytes: a table
    in order with ``doc`` (row of the lists), ``a`` and ``b`` (the tokens'
    numbers among all flattened ones) and ``cut`` (both tokens end here). One
    row is one link. ``size_*``: bytes of every id."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def ends(lists, sizes, name):
        parent = pc.list_parent_indices(lists)
        lengths = pc.take(pa.array(sizes), lists.flatten())
        upto = pc.cumulative_sum(lengths.cast(pa.int64()))
        offsets = np.asarray(lists.offsets)
        before = np.concatenate([[0], upto.to_numpy(zero_copy_only=False)])[offsets[:-1] - offsets[0]]
        end = pc.subtract(upto, pc.take(pa.array(before), parent))
        key = pc.bit_wise_or(pc.shift_left(parent.cast(pa.int64()), 32), end)
        return pa.table({"key": key, name: pa.array(np.arange(len(parent), dtype=np.int32))})

    both = ends(a, size_a, "a").join(ends(b, size_b, "b"), keys="key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    return pa.table({"doc": pc.shift_right(both["key"], 32), "a": pc.fill_null_backward(both["a"]), "b": pc.fill_null_backward(both["b"]),
                     "cut": pc.and_(both["a"].is_valid(), both["b"].is_valid())}).combine_chunks()


def _lists(values, counts):
    import numpy as np
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _one(column):
    """A column as one array."""
    import pyarrow as pa

    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def links(docs: DataFrame, path_a: str, path_b: str, lot_pairs: int = LOT_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links,
    ``groups`` (text ``a1,a2|b1;...`` of ids), its lot, and the different pairs
    of ids linked in it (``pairs``, A's id << 32 | B's) with their numbers of
    links (``times``).

    A text that is null or empty, or that one of the tokenizers does not give
    back byte by byte, has no tokens. Repeated rows are documents of their own;
    other columns are ignored. A slice of text of bounded size (or one longer
    text) is in memory at a time."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, lot long, pairs array<long>, times array<int>"

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pa.set_cpu_count(1)
        coder, names = Coder(path_a, path_b), [f.split(" ")[0] for f in schema.split(", ")]
        digits_a, digits_b = (pa.array([str(i) for i in range(len(t))]) for t in (coder.bytes_a, coder.bytes_b))
        lot, in_lot = TaskContext.get().partitionId() << 32, 0
        for batch in arrow_slices(batches, 1, SLICE_BYTES):
            some = np.flatnonzero(pc.greater(pc.fill_null(pc.binary_length(batch.column(1)), 0), 0).to_numpy(zero_copy_only=False))
            texts = batch.column(1).take(pa.array(some, pa.int64()))
            a, b = coder.encode(texts)
            want = pc.binary_join_element_wise("", texts, " ").cast(pa.binary())
            good = np.ones(len(texts), bool)
            for ids, table in ((a, coder.bytes_a), (b, coder.bytes_b)):
                back = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, table.take(ids.values)), b"")
                good &= pc.equal(back, want).to_numpy(zero_copy_only=False)
            rows, n = some[good], batch.num_rows
            a, b = a.filter(pa.array(good)), b.filter(pa.array(good))
            ends = align(a, b, coder.size_a, coder.size_b)
            flat_a, flat_b = a.flatten(), b.flatten()
            doc, cut = ends["doc"].to_numpy(), _one(ends["cut"])
            at_a, at_b = _one(ends["a"]), _one(ends["b"])
            # groups: the tokens up to each cut, as text
            told = []
            for at, flat, digits in ((at_a, flat_a, digits_a), (at_b, flat_b, digits_b)):
                stops = np.concatenate([[0], at.filter(cut).to_numpy() + 1]).astype(np.int32)
                told.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(stops), digits.take(flat)), ","))
            told = pc.binary_join_element_wise(*told, "|")
            n_links = np.bincount(doc, minlength=len(rows))
            n_groups = np.bincount(doc[cut.to_numpy(zero_copy_only=False)], minlength=len(rows))
            told = pc.binary_join(_lists(told, n_groups), ";")
            # links by document and pair
            pair = pc.bit_wise_or(pc.shift_left(flat_a.take(at_a).cast(pa.int64()), 32), flat_b.take(at_b).cast(pa.int64()))
            held = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
            held = held.sort_by([("doc", "ascending"), ("pair", "ascending")]).combine_chunks()
            per_doc = np.bincount(held["doc"].to_numpy(), minlength=len(rows))

            def put(values):
                out = np.zeros(n, np.int64)
                out[rows] = values
                return out

            groups = np.full(n, "", dtype=object)
            groups[rows] = told.to_pylist()
            counts = put(per_doc)
            upto = np.cumsum(counts) + in_lot
            lots = lot + upto // lot_pairs
            lot, in_lot = int(lots[-1]), int(upto[-1]) % lot_pairs
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(put(pc.list_value_length(a).to_numpy(zero_copy_only=False))),
                pa.array(put(pc.list_value_length(b).to_numpy(zero_copy_only=False))), pa.array(put(n_groups)), pa.array(put(n_links)),
                pa.array(groups, pa.string()), pa.array(lots), _lists(_one(held["pair"]), counts),
                _lists(_one(held["count_all"]).cast(pa.int32()), counts)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def lot_counts(linked: DataFrame) -> DataFrame:
    """(lot, pair, n): partial counts of the documents that hold a pair."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                lots, pairs = batch.slice(at, 2000).columns
                flat = pa.table({"lot": lots.take(pc.list_parent_indices(pairs)), "pair": pairs.flatten()})
                got = flat.group_by(["lot", "pair"], use_threads=False).aggregate([([], "count_all")])
                yield from got.rename_columns(["lot", "pair", "n"]).combine_chunks().to_batches()

    return linked.select("lot", "pairs").mapInArrow(run, "lot long, pair long, n long").groupBy("lot", "pair").agg(F.sum("n").alias("n"))


def pair_counts(partial: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold the pair, corpus-wide, and
    whether no other pair of the same A id has more."""
    counts = partial.groupBy("pair").agg(F.sum("n").alias("count"))
    best = counts.groupBy(F.shiftright("pair", 32).alias("_a")).agg(F.max("count").alias("_most"))
    return counts.withColumn("_a", F.shiftright("pair", 32)).join(best, "_a").select("pair", "count", (F.col("count") == F.col("_most")).alias("best"))


def price(linked: DataFrame, counted: DataFrame) -> DataFrame:
    """The documents' columns with n_best (links whose pair is best for its A
    id) and count_sum (sum of the counts over the links), from ``counted``
    (lot, pair, count, best)."""
    kept = [f for f in linked.schema.fields if f.name not in ("lot", "pairs", "times")]
    names = [f.name for f in kept]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + ["n_best long", "count_sum long"])

    def run(docs, known):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        docs = docs.combine_chunks()
        pairs, times = _one(docs["pairs"]), _one(docs["times"])
        held = pa.table({"doc": pc.list_parent_indices(pairs).cast(pa.int64()), "pair": pairs.flatten(), "times": times.flatten().cast(pa.int64())})
        held = held.join(known.select(["pair", "count", "best"]), keys="pair", join_type="inner", use_threads=False)
        held = held.append_column("sum", pc.multiply(held["times"], held["count"])).append_column("hit", pc.multiply(held["times"], held["best"].cast(pa.int64())))
        per = held.group_by("doc", use_threads=False).aggregate([("hit", "sum"), ("sum", "sum")])
        out = docs.select(names)
        for name, column in (("n_best", "hit_sum"), ("count_sum", "sum_sum")):
            values = np.zeros(len(docs), np.int64)
            values[per["doc"].to_numpy()] = per[column].to_numpy()
            out = out.append_column(name, pa.array(values))
        return out

    return linked.groupBy("lot").cogroup(counted.groupBy("lot")).applyInArrow(run, schema)


def cross_align(docs: DataFrame, path_a: str, path_b: str, lot_pairs: int = LOT_PAIRS, digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links,
    groups, n_best and count_sum (see ``links`` and ``price``). With ``digest``
    the groups' sha256 (hex; empty without tokens) takes the text's place
    before anything is stored. An empty table gives an empty one."""
    linked = links(docs, path_a, path_b, lot_pairs)
    if digest:
        linked = linked.withColumn("groups", F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256)))
    linked = stage_table(linked, "align-links")
    partial = stage_table(lot_counts(linked), "align-partial")
    counts = stage_table(pair_counts(partial), "align-counts")
    return price(linked, partial.select("lot", "pair").join(counts, "pair"))
