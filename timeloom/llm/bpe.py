"""Byte-level BPE encoding and decoding with DuckDB recursive queries.

Each task cuts its texts into pieces with the tokenizer's pattern, and encodes
every distinct piece once: the piece's bytes become token-position rows, a
recursive query joins the adjacent pairs with the merge table and contracts
each piece's leftmost pair of least rank, until no pair is left. An ordered
aggregation over the ids gives the bytes back.

The merge table holds, for every vocabulary entry, each of its two-part splits
whose parts are entries too; a contraction is therefore exactly a step of the
rank-based encoder. One pair per piece is contracted in a round, because in a
public vocabulary a merged token can form a pair of a *lower* rank with its
neighbour. A piece longer than ``LONG_PIECE`` bytes would need as many rounds
as it has tokens, each over all its rows; such pieces are contracted with a
heap over a linked list instead, in the same order.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from timeloom.llm.common import arrow_slices

#: Bytes of a piece from which the heap is used; below, positions fit 16 bits.
LONG_PIECE = 128
#: Rows that one recursive query may build: a piece of n bytes counts n * n.
ROWS_A_QUERY = 2_000_000
#: Ids that one ordered aggregation decodes (a longer piece is taken alone).
IDS_A_QUERY = 400_000
#: Pieces that a task remembers before it starts its index anew.
PIECES_KEPT = 300_000

ENCODE_SQL = """
WITH RECURSIVE step(it, piece, pos, tok, next_tok, next_pos) AS (
  SELECT 0, piece, pos, tok, next_tok, next_pos FROM bytes_in
  UNION ALL
  (WITH best AS (
     SELECT s.piece, min((m.merged::BIGINT << 32) | (s.pos << 16) | s.next_pos) AS packed
     FROM step s JOIN merges m ON m.pair = ((s.tok::BIGINT << 20) | s.next_tok)
     GROUP BY s.piece),
   hit AS (
     SELECT piece, (packed >> 32)::INT AS merged, ((packed >> 16) & 65535)::INT AS at_pos,
            (packed & 65535)::INT AS gone_pos
     FROM best)
   SELECT s.it + 1, s.piece,
          CASE WHEN s.pos = h.gone_pos THEN h.at_pos ELSE s.pos END,
          CASE WHEN s.pos = h.gone_pos THEN h.merged ELSE s.tok END,
          CASE WHEN s.next_pos = h.at_pos THEN h.merged ELSE s.next_tok END,
          s.next_pos
   FROM step s JOIN hit h USING (piece)
   WHERE s.pos <> h.at_pos)
)
SELECT s.piece, s.pos, s.tok
FROM step s JOIN (SELECT piece, max(it) AS it FROM step GROUP BY piece) f
  ON s.piece = f.piece AND s.it = f.it
ORDER BY s.piece, s.pos
"""

DECODE_SQL = """
SELECT t.piece, from_hex(string_agg(v.hex, '' ORDER BY t.pos)) AS bytes
FROM ids_in t JOIN vocab v USING (tok)
GROUP BY t.piece ORDER BY t.piece
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file (fixed size, some 800 KB): read by the driver,
    sent with the task."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PieceCoder:
    """The vocabulary as DuckDB tables of one task, and the two queries."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb
        import numpy as np
        import pyarrow as pa

        self.ranks, self.np, self.pa = ranks, np, pa
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.db = duckdb.connect(":memory:")
        self.db.execute("SET threads=1; SET memory_limit='250MB'; SET enable_progress_bar=false; SET temp_directory=''")
        rows = [(left << 20 | right, merged) for token, merged in ranks.items() for i in range(1, len(token))
                if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None]
        pairs = np.array(rows, dtype=np.int64).reshape(-1, 2)
        self._table("merges", pa.table({"pair": pairs[:, 0], "merged": pairs[:, 1].astype(np.int32)}))
        self._table("vocab", pa.table({"tok": pa.array(list(ranks.values()), pa.int32()), "hex": [t.hex() for t in ranks]}))

    def _table(self, name, data):
        self.db.register("incoming", data)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _query(self, name, data, sql):
        self.db.register(name, data)
        out = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return out

    def encode(self, pieces: list[bytes]):
        """(ids of all pieces in a row, ids per piece)."""
        np = self.np
        parts: list = [None] * len(pieces)
        short = [i for i, p in enumerate(pieces) if len(p) < LONG_PIECE]
        for i in set(range(len(pieces))).difference(short):
            parts[i] = np.array(self._encode_long(pieces[i]), dtype=np.int32)
        weights = np.cumsum([len(pieces[i]) ** 2 for i in short]) // ROWS_A_QUERY
        for some in np.split(np.array(short, dtype=np.int64), np.flatnonzero(np.diff(weights)) + 1) if short else []:
            sizes = np.array([len(pieces[i]) for i in some])
            flat = np.frombuffer(b"".join(pieces[i] for i in some), dtype=np.uint8)
            ends = np.cumsum(sizes)
            pos = (np.arange(len(flat)) - np.repeat(ends - sizes, sizes)).astype(np.int32)
            tok = self.byte_id[flat]
            following = np.append(tok[1:], -1).astype(np.int32)
            following[ends - 1] = -1
            got = self._query("bytes_in", self.pa.table({
                "piece": np.repeat(np.arange(len(some), dtype=np.int32), sizes), "pos": pos, "tok": tok,
                "next_tok": following, "next_pos": pos + 1}), ENCODE_SQL)
            ids = got["tok"].to_numpy()
            cuts = np.cumsum(np.bincount(got["piece"].to_numpy(), minlength=len(some)))[:-1]
            for i, part in zip(some, np.split(ids, cuts), strict=True):
                parts[i] = part
        counts = np.array([len(p) for p in parts], dtype=np.int64)
        return (np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)), counts

    def _encode_long(self, piece: bytes) -> list[int]:
        """The same contractions in the same order, found with a heap."""
        n, ranks = len(piece), self.ranks
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n

        def offer(i):
            j = after[i]
            if j < n and (r := ranks.get(piece[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        heap: list[tuple[int, int, int]] = []
        for i in range(n):
            offer(i)
        while heap:
            _, i, upto = heapq.heappop(heap)
            if not alive[i] or (j := after[i]) >= n or end[j] != upto:
                continue  # one of the pair's parts has changed meanwhile
            end[i], after[i], alive[j] = upto, after[j], False
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    def decode(self, ids, counts) -> list[bytes]:
        """Bytes of each run of ids; a run without ids gives no bytes. An id
        that the vocabulary lacks is an error."""
        np = self.np
        out = [b""] * len(counts)
        if len(ids):
            if not np.isin(ids, np.fromiter(self.ranks.values(), np.int64)).all():
                raise ValueError("an id is not in the vocabulary")
            piece = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
            cuts = np.flatnonzero(np.diff(np.cumsum(counts) // IDS_A_QUERY)) + 1
            ends = np.concatenate([[0], np.cumsum(counts)[cuts - 1], [len(ids)]]).astype(np.int64)
            for at, upto in zip(ends[:-1], ends[1:], strict=True):
                got = self._query("ids_in", self.pa.table({
                    "piece": piece[at:upto], "pos": np.arange(upto - at, dtype=np.int32), "tok": ids[at:upto]}), DECODE_SQL)
                for i, b in zip(got["piece"].to_pylist(), got["bytes"].to_pylist(), strict=True):
                    out[i] = b
        return out


class _Pieces(dict):
    """Piece to its number; a new piece gets the next one."""

    def __missing__(self, piece):
        self[piece] = n = len(self)
        return n


def encode_decode(df: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", decode: bool = True) -> DataFrame:
    """One row per row of ``df``: the id column, ``ids`` array<int> and, with
    ``decode``, ``decoded`` binary (the ids' bytes, taken from the ids alone).

    A null or empty text has no ids and decodes to no bytes. Repeated rows are
    encoded like any others, extra columns are left out, an empty table gives
    an empty one. No shuffle: each task holds some 4 MB of text and an index
    of at most ``PIECES_KEPT`` pieces at a time, however long the table is."""
    ranks = read_ranks(vocab_path)
    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
                          + ([T.StructField("decoded", T.BinaryType())] if decode else []))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import regex

        find = regex.compile(pattern).findall
        coder = PieceCoder(ranks)
        index, ids, starts, raw = _Pieces(), np.zeros(0, np.int32), np.zeros(1, np.int64), []
        for batch in arrow_slices(batches, 1):
            if len(index) > PIECES_KEPT:
                index, ids, starts, raw = _Pieces(), np.zeros(0, np.int32), np.zeros(1, np.int64), []
            known, docs = len(index), []
            for text in batch.column(1):
                found = find(text.as_py() or "")
                docs.append(np.fromiter(map(index.__getitem__, found), np.int64, len(found)))
            if len(index) > known:
                new = [p.encode() for p in list(index)[known:]]
                more, counts = coder.encode(new)
                ids, starts = np.concatenate([ids, more]), np.concatenate([starts, starts[-1] + np.cumsum(counts)])
                if decode:
                    raw += coder.decode(more, counts)
            sizes = np.diff(starts)
            every = np.concatenate(docs) if docs else np.zeros(0, np.int64)
            per_piece = sizes[every]
            ends = np.cumsum(per_piece)
            flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[every] - (ends - per_piece), per_piece)]
            upto = np.concatenate([[0], ends])[np.cumsum([0] + [len(d) for d in docs])].astype(np.int32)
            cols = [batch.column(0), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(flat, pa.int32()))]
            if decode:
                cols.append(pa.array([b"".join([raw[i] for i in d]) for d in docs], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode_ids(df: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id column, ``decoded`` binary) of rows that hold id arrays; a null or
    empty array decodes to no bytes, an unknown id is an error."""
    ranks = read_ranks(vocab_path)
    schema = T.StructType([df.schema[id_col], T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coder = PieceCoder(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                lists = [np.array(x.as_py() or [], dtype=np.int32) for x in part.column(1)]
                counts = np.array([len(x) for x in lists], dtype=np.int64)
                out = coder.decode(np.concatenate(lists) if lists else np.zeros(0, np.int32), counts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], names=[f.name for f in schema])

    return df.select(id_col, ids_col).mapInArrow(run, schema)
