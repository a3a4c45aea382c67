"""Token ids in files of bit planes.

A file holds the ids of consecutive documents as one row of ids, cut into
chunks of a fixed size. A chunk is transposed: plane p holds bit (or byte) p of
every id, lowest first, and each plane is compressed by zstandard on its own, so
the regular high planes shrink to little; planes above the chunk's largest id
are left out. Behind the chunks stand the chunk index (offset, ids and plane
sizes of every chunk) and the document index (ids of the documents and their
numbers of ids), so any stretch of ids is read with the planes of its chunks
alone.

Layout, little-endian: ``IDPLANE1``, chunks, index (a zstandard frame), then
offset and length of the index as two 8-byte integers, and ``IDPLANE1``.

Every task of a range partitioning by doc_id writes one file under a name of
its own attempt; the manifest, a stage table, names the files of the attempts
that Spark accepted. A lost executor or a repeated task can thus leave an
unnamed file behind, but never a missing or a doubled one.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.llm.common import arrow_slices
from timeloom.llm.words import WordCoder
from timeloom.session import checkpoint_dir, stage_table

MAGIC = b"IDPLANE1"
#: Ids of a chunk.
CHUNK = 1 << 16
#: Bits of a plane: 1 (bit planes) or 8 (byte planes).
UNIT = 1
#: Ids from which a file is read by more than one task.
SPLIT = 1 << 22
#: Text that a task encodes at a time, in bytes.
SLICE_BYTES = 3 << 20
#: Compression of zstandard.
LEVEL = 3


def to_planes(ids, unit: int = UNIT) -> list[bytes]:
    """Planes of an array of ids (unsigned, 32 bits), lowest first."""
    import numpy as np

    ids = np.ascontiguousarray(ids, dtype="<u4")
    width = int(ids.max()).bit_length() if len(ids) else 0
    of_byte = ids.view(np.uint8).reshape(-1, 4)[:, :(width + 7) // 8]
    if unit == 8:
        return [col.tobytes() for col in of_byte.T]
    bits = np.unpackbits(of_byte, axis=1, bitorder="little")[:, :width]
    return [np.packbits(col, bitorder="little").tobytes() for col in np.ascontiguousarray(bits.T)]


def from_planes(planes: list[bytes], n: int, unit: int = UNIT):
    """The n ids of these planes."""
    import numpy as np

    of_byte = np.zeros((n, 4), np.uint8)
    if unit == 8:
        for i, plane in enumerate(planes):
            of_byte[:, i] = np.frombuffer(plane, np.uint8)
    elif planes:
        bits = np.zeros((-len(planes) % 8 + len(planes), n), np.uint8)
        for i, plane in enumerate(planes):
            bits[i] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
        of_byte[:, :len(bits) // 8] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return of_byte.view("<u4").reshape(n)


class Writer:
    """One file, written from front to back; holds one chunk of ids and the
    indexes."""

    def __init__(self, out, chunk: int = CHUNK, unit: int = UNIT):
        import zstandard

        self.out, self.chunk, self.unit = out, chunk, unit
        self.press = zstandard.ZstdCompressor(level=LEVEL).compress
        self.held, self.n_held, self.n_ids = [], 0, 0
        self.chunks, self.docs, self.lengths = [], [], []
        out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_id: int | None, n: int) -> None:
        """The next document has n ids, given by ``extend``."""
        self.docs.append(doc_id)
        self.lengths.append(n)

    def extend(self, ids) -> None:
        import numpy as np

        self.n_ids += len(ids)
        while len(ids):
            part = ids[:self.chunk - self.n_held]
            self.held.append(np.asarray(part, dtype="<u4"))
            self.n_held += len(part)
            ids = ids[len(part):]
            if self.n_held == self.chunk:
                self._flush()

    def _flush(self) -> None:
        import numpy as np

        if self.n_held:
            planes = [self.press(p) for p in to_planes(np.concatenate(self.held), self.unit)]
            self.chunks.append((self.at, self.n_held, [len(p) for p in planes]))
            for p in planes:
                self.out.write(p)
            self.at += sum(map(len, planes))
            self.held, self.n_held = [], 0

    def close(self) -> None:
        import numpy as np

        self._flush()
        index = [struct.pack("<QQQBQ", len(self.chunks), len(self.docs), self.chunk, self.unit, self.n_ids)]
        index += [struct.pack(f"<QQB{len(sizes)}I", at, n, len(sizes), *sizes) for at, n, sizes in self.chunks]
        index += [np.array([d or 0 for d in self.docs], "<i8").tobytes(), bytes(d is None for d in self.docs), np.array(self.lengths, "<u8").tobytes()]
        index = self.press(b"".join(index))
        self.out.write(index + struct.pack("<QQ", self.at, len(index)) + MAGIC)


class Reader:
    """One file (seekable), by its indexes."""

    def __init__(self, file, size: int):
        import numpy as np
        import zstandard

        self.file, self.unpress = file, zstandard.ZstdDecompressor().decompress
        tail = self._read(size - 24, 24)
        at, n = struct.unpack("<QQ", tail[:16])
        if tail[16:] != MAGIC:
            raise ValueError("not a file of id planes")
        index = self.unpress(self._read(at, n))
        n_chunks, n_docs, self.chunk, self.unit, self.n_ids = struct.unpack_from("<QQQBQ", index)
        at, self.chunks = struct.calcsize("<QQQBQ"), []
        for _ in range(n_chunks):
            start, n, planes = struct.unpack_from("<QQB", index, at)
            sizes = struct.unpack_from(f"<{planes}I", index, at + 17)
            at += 17 + 4 * planes
            self.chunks.append((start, n, sizes))
        self.docs = np.frombuffer(index, "<i8", n_docs, at)
        self.null = np.frombuffer(index, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        self.lengths = np.frombuffer(index, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids_of_chunk(self, k: int):
        at, n, sizes = self.chunks[k]
        raw, planes = self._read(at, sum(sizes)), []
        for size in sizes:
            planes.append(self.unpress(raw[:size]))
            raw = raw[size:]
        return from_planes(planes, n, self.unit)

    def stretches(self, start: int, end: int) -> Iterator:
        """Ids start .. end - 1, chunk by chunk."""
        for k in range(start // self.chunk, -(-end // self.chunk)):
            a = k * self.chunk
            yield self.ids_of_chunk(k)[max(start - a, 0):end - a]

    def pieces(self, first: int, last: int) -> Iterator:
        """(document's number, part of its ids, whether it ends) of the
        documents first .. last - 1, every chunk read once."""
        import numpy as np

        doc, none = first, np.zeros(0, "<u4")
        left = int(self.lengths[doc]) if doc < last else 0
        end = int(self.starts[last - 1] + self.lengths[last - 1]) if doc < last else 0
        for ids in self.stretches(int(self.starts[first]), end) if doc < last else ():
            while doc < last and len(ids) >= left:
                yield doc, ids[:left], True
                ids, doc = ids[left:], doc + 1
                left = int(self.lengths[doc]) if doc < last else 0
            if doc < last and len(ids):
                yield doc, ids, False
                left -= len(ids)
        for doc in range(doc, last):
            yield doc, none, True  # documents without ids behind the last chunk


def file_system(path: str):
    """(file system of pyarrow, path in it) of a path that all executors
    share: a URI, or a local path in local mode."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int | None = 1,
          chunk: int = CHUNK, unit: int = UNIT) -> DataFrame:
    """Encodes every whole text and writes the ids, in ascending order of
    doc_id, into files in ``folder`` (default: a new one in the shared folder).

    Returns the manifest: one row per file with part, file, n_docs, n_ids and
    base (ids in the files before it). A null or empty text has ``end_id``
    alone (nothing without ``end_id``). Rows with a null id come first, rows
    that share an id by a hash of their texts; repeated rows are written each.
    Other columns are ignored; an empty table gives an empty manifest. A task
    holds some 3 MB of text, or one text that is longer, and one chunk."""
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_row"))
    keys = [F.asc_nulls_first("doc_id"), "_h", "_row"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    schema = "part int, file string, n_docs long, n_ids long"

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, file, writer, coder = TaskContext.get().partitionId(), None, None, None
        for batch in arrow_slices(batches, 1, SLICE_BYTES):
            if writer is None:
                system, inside = file_system(folder)
                system.create_dir(inside, recursive=True)
                file = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
                out = system.open_output_stream(f"{inside}/{file}")
                writer, coder = Writer(out, chunk, unit), WordCoder(tokenizer)
            ids, counts = coder.encode(batch.column(1))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
            for doc_id, n in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
                writer.add(doc_id, n)
            writer.extend(ids)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [file], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    files = stage_table(rows.mapInArrow(run, schema), "token-id-files")
    # one row per file of a whole partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return stage_table(files.select("part", F.concat(F.lit(folder + "/"), "file").alias("file"), "n_docs", "n_ids",
                                    F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")), "token-id-manifest")


def _read(manifest: DataFrame, schema: T.StructType, body, split: int) -> DataFrame:
    """``body(reader, first, last, base)`` over stretches of documents: those
    that begin in the same ``split`` ids of a file are one task's."""
    parts = manifest.select("part", "file", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("n_ids") - 1, F.lit(0)) / split))).alias("k"))
    n = max(1, parts.count())

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                system, inside = file_system(row["file"])
                with system.open_input_file(inside) as file:
                    reader = Reader(file, file.size())
                    at = np.searchsorted(reader.starts, [row["k"] * split, (row["k"] + 1) * split])
                    if (row["k"] + 1) * split >= reader.n_ids:
                        at[1] = len(reader.docs)  # documents without ids at the end too
                    yield from body(reader, int(at[0]), int(at[1]), row["base"])

    return parts.repartitionByRange(n, "part", "k").mapInArrow(run, schema)


def _batch(schema: T.StructType, reader: Reader, numbers: list[int], base: int, *columns):
    import numpy as np
    import pyarrow as pa

    at = np.array(numbers, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(reader.docs[at], pa.int64(), mask=reader.null[at]), pa.array(reader.starts[at] + base, pa.int64()), pa.array(reader.lengths[at], pa.int64()), *columns],
        names=[f.name for f in schema])


def read_ids(manifest: DataFrame, split: int = SPLIT) -> DataFrame:
    """Reads the files back: doc_id, start (ids of all documents before it),
    n_tokens and ids array<int>, one row per document."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def body(reader, first, last, base):
        import numpy as np
        import pyarrow as pa

        numbers, ids, held, own = [], [], 0, []
        for doc, part, ends in reader.pieces(first, last):
            own.append(part)
            if ends:
                numbers.append(doc)
                ids.append(np.concatenate(own).astype(np.int32))
                held, own = held + len(ids[-1]), []
            if numbers and held >= CHUNK:
                yield _batch(schema, reader, numbers, base, pa.array(ids, pa.list_(pa.int32())))
                numbers, ids, held = [], [], 0
        if numbers:
            yield _batch(schema, reader, numbers, base, pa.array(ids, pa.list_(pa.int32())))

    return _read(manifest, schema, body, split)


def read_digests(manifest: DataFrame, split: int = SPLIT) -> DataFrame:
    """Reads the files back: doc_id, start, n_tokens and ids_crc32 (unsigned
    crc32 of the ids as little-endian unsigned 32-bit integers). No document's
    ids are held whole."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])

    def body(reader, first, last, base):
        import pyarrow as pa

        numbers, digests, crc = [], [], 0
        for doc, part, ends in reader.pieces(first, last):
            crc = zlib.crc32(part.tobytes(), crc)
            if ends:
                numbers.append(doc)
                digests.append(crc)
                crc = 0
            if len(numbers) >= 10_000:
                yield _batch(schema, reader, numbers, base, pa.array(digests, pa.int64()))
                numbers, digests = [], []
        if numbers:
            yield _batch(schema, reader, numbers, base, pa.array(digests, pa.int64()))

    return _read(manifest, schema, body, split)
