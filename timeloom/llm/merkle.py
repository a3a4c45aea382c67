"""Merkle manifest of a dataset, with a witness for every row.

Rows become leaf digests in the scan; per group (the language) they stand in
order, and while more than one node remains, every two consecutive nodes become
their digest (a last node alone too). The groups' roots, in order of the group,
make the dataset's root in the same way.

Witnesses grow while the leaves are appended: a task holds the open subtrees of
one aligned block of ``2 ** bits`` nodes (``Frontier``), each with the partial
witnesses of its leaves; when a subtree's sibling completes, the witnesses of
both sides are extended by the other's root and the two become one open
subtree. The blocks' roots are appended in the same way as nodes of the next
level, until every group has one root. A row's witness is then its steps inside
its block, its block's steps, and so on upwards: tables that shrink by
``2 ** bits`` from level to level, joined by (group, block).

A group that holds most rows spreads over its blocks; a group's order comes
from a range partitioning with exact counts per partition, so nothing is ever
ordered in one task. A witness is a binary of steps: byte 0 (the node was alone
at this level), or 1 (sibling on the left) or 2 (on the right) and the
sibling's 32 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.session import release, stage_table

#: Nodes of a block: 2 ** BITS.
BITS = 10
ALONE, LEFT, RIGHT = b"\x00", b"\x01", b"\x02"
#: The fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined(*digests: bytes) -> bytes:
    """Digest of the children's digests as lowercase hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def leaf_digest(*fields: Column) -> Column:
    """sha256 (binary) of the fields: ``-`` for null, else UTF-8 byte count,
    a colon and the value."""
    told = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*told), 256))


class Frontier:
    """The open subtrees of a growing list of nodes, smaller ones last.

    ``witness[i]`` is what is known of node i's witness so far; a subtree is
    (height, root, first node, end) and covers consecutive nodes."""

    def __init__(self):
        self.open: list[tuple[int, bytes, int, int]] = []
        self.witness: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        """One more node; completes as many subtrees as it fills."""
        n = len(self.witness)
        self.witness.append(bytearray())
        self.open.append((0, digest, n, n + 1))
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._pair()

    def _pair(self) -> None:
        height, right, mid, end = self.open.pop()
        _, left, start, _ = self.open.pop()
        for i in range(start, mid):
            self.witness[i] += RIGHT + right
        for i in range(mid, end):
            self.witness[i] += LEFT + left
        self.open.append((height + 1, joined(left, right), start, end))

    def close(self, height: int) -> bytes:
        """Root at ``height``: the last open subtree rises alone until it
        meets the next, or that height. No node may follow."""
        while len(self.open) > 1 or self.open[0][0] < height:
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self._pair()
                continue
            at, root, start, end = self.open.pop()
            for i in range(start, end):
                self.witness[i] += ALONE
            self.open.append((at + 1, joined(root), start, end))
        return self.open[0][1]


def steps(witness: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(side, sibling) level by level; no sibling for a node alone."""
    at = 0
    while at < len(witness):
        side, at = witness[at:at + 1], at + 1
        if side == ALONE:
            yield side, b""
        else:
            yield side, witness[at:at + 32]
            at += 32


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness give."""
    for side, sibling in steps(witness):
        leaf = joined(leaf) if side == ALONE else joined(sibling, leaf) if side == LEFT else joined(leaf, sibling)
    return leaf


def place(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with ``_g``, never null) and ``_pos``, their number from 0 in
    their group by ``order``, and ``_n``, the group's size. One range
    partitioning and counts per (group, partition); rows that tie in all of
    ``order`` may come in any order."""
    keys = [F.asc("_g"), *(F.asc_nulls_first(c) for c in order)]
    put = stage_table(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                      .withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_at", 33)
    counts = put.groupBy("_g", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_c"))
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = stage_table(counts.select("_g", "_part", (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
                                     F.sum("_c").over(Window.partitionBy("_g")).alias("_n")), "merkle-counts")
    return (put.withColumn("_part", part).join(base, ["_g", "_part"])
            .withColumn("_pos", F.col("_base") + F.col("_at")).drop("_part", "_base", "_at"))


def grow(nodes: DataFrame, bits: int) -> DataFrame:
    """Appends every block's nodes to a frontier of its own: the rows of
    ``nodes`` (_g, _pos, _n, _digest and others), with ``_block``, ``_path``
    (witness inside the block) and ``_root`` (the block's)."""
    size = 1 << bits
    rows = nodes.withColumn("_block", F.shiftright("_pos", bits))
    rows = rows.repartition("_g", "_block").sortWithinPartitions("_g", "_pos")
    at_pos, at_n, at_digest = (rows.columns.index(c) for c in ("_pos", "_n", "_digest"))
    schema = T.StructType([*rows.schema.fields, T.StructField("_path", T.BinaryType()), T.StructField("_root", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def whole(block):
            tree, n = Frontier(), block.column(at_n)[0].as_py()
            for digest in block.column(at_digest).to_pylist():
                tree.append(digest)
            root = tree.close(bits if n > size else (n - 1).bit_length())
            more = [pa.array([bytes(w) for w in tree.witness], pa.binary()), pa.array([root] * block.num_rows, pa.binary())]
            for batch in block.combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[f.name for f in schema])

        held = None  # the block that the next batch may go on with
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            starts = np.flatnonzero(table.column(at_pos).to_numpy() % size == 0)
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                yield from whole(table.slice(a, b - a))
            held = table.slice(starts[-1])
        if held is not None:
            yield from whole(held)

    return rows.mapInArrow(run, schema)


def build(nodes: DataFrame, order: list[str], bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(rows, blocks) of the trees over ``nodes`` (_g, _digest and others).

    rows: the nodes with ``_block`` and ``_path``, their witness inside their
    block. blocks: (_g, _block, _up, _top), the blocks' witnesses and their
    trees' roots. Both are stage tables; rounds: the logarithm of the largest
    group's size to the base 2 ** bits."""
    levels = [stage_table(grow(place(nodes, order), bits), "merkle-0")]
    while True:
        last = levels[-1]
        roots = last.groupBy("_g", "_block").agg(F.min("_root").alias("_digest"), F.min("_n").alias("_n")).select(
            "_g", F.col("_block").alias("_pos"), F.ceil(F.col("_n") / (1 << bits)).cast("long").alias("_n"), "_digest")
        roots = stage_table(roots, "merkle-roots")
        if (roots.agg(F.max("_n")).first()[0] or 0) <= 1:
            break
        levels.append(stage_table(grow(roots, bits), f"merkle-{len(levels)}"))
    up = roots.select("_g", F.col("_pos").alias("_block"), F.lit(b"").alias("_up"), F.col("_digest").alias("_top"))
    for level in reversed(levels[1:]):
        up = (level.select("_g", "_block", "_pos", "_path").join(up, ["_g", "_block"])
              .select("_g", F.col("_pos").alias("_block"), F.concat("_path", "_up").alias("_up"), "_top"))
    up = stage_table(up, "merkle-up")
    release(roots, *levels[1:])
    return levels[0], up


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``leaf``, ``subroot``, ``root`` and
    ``witness`` (all binary), and with ``changed`` (field: new value) ``other``,
    the leaf with those values.

    Null fields hash as ``-``; rows order by doc_id (null first), then by leaf,
    so repeated rows have neighbouring leaves with witnesses of their own;
    texts may be empty or of any length, they are hashed in the scan and never
    shuffled. A null language is a group of its own, before all others. Columns
    beyond the five fields are ignored; an empty table gives an empty manifest."""
    now = [F.col(c) for c in FIELDS]
    then = [(changed or {}).get(c, F.col(c)) for c in FIELDS]
    # never null and in the order of the languages, null first
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    leaves = docs.select("doc_id", group.alias("_g"), leaf_digest(*now).alias("_digest"),
                         *([leaf_digest(*then).alias("other")] if changed else []),
                         F.monotonically_increasing_id().alias("_row"))
    leaves = stage_table(leaves, "merkle-leaves")
    rows, blocks = build(leaves, ["doc_id", "_digest", "_row"], bits)
    trees = blocks.groupBy("_g").agg(F.min("_top").alias("_digest"))
    above, tops = build(trees.select(F.lit("").alias("_g"), F.col("_g").alias("_tree"), "_digest"), ["_tree"], bits)
    above = above.select("_tree", "_block", "_path").join(tops.select("_block", "_up", F.col("_top").alias("root")), "_block").select(
        F.col("_tree").alias("_g"), F.concat("_path", "_up").alias("_last"), "root")
    ends = stage_table(blocks.join(above, "_g").select("_g", "_block", F.concat("_up", "_last").alias("_up"),
                                                       F.col("_top").alias("subroot"), "root"), "merkle-ends")
    return rows.select("_g", "_block", "doc_id", F.col("_digest").alias("leaf"), "_path", *(["other"] if changed else [])).join(
        ends, ["_g", "_block"]).select("doc_id", "leaf", "subroot", "root", F.concat("_path", "_up").alias("witness"),
                                       *(["other"] if changed else []))


def verify(rows: DataFrame, leaf: str = "leaf") -> DataFrame:
    """``rows`` (with ``witness``, ``root`` and a leaf column) and
    ``proof_sha256`` (hex, over the siblings' hex digests, upwards),
    ``folded_root`` (hex) and ``verified``: whether leaf and witness give the
    root."""
    at_leaf, at_witness, at_root = (rows.columns.index(c) for c in (leaf, "witness", "root"))
    schema = T.StructType([*rows.schema.fields, T.StructField("proof_sha256", T.StringType()), T.StructField("folded_root", T.StringType()),
                           T.StructField("verified", T.BooleanType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            proofs, folded, good = [], [], []
            for x, w, root in zip(*(batch.column(i).to_pylist() for i in (at_leaf, at_witness, at_root)), strict=True):
                proofs.append(hashlib.sha256("".join(s.hex() for _, s in steps(w)).encode()).hexdigest())
                folded.append((got := fold(x, w)).hex())
                good.append(got == root)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
                                              pa.array(good, pa.bool_())], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)
