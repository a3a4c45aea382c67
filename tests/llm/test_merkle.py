import hashlib

import pytest
from pyspark.sql import functions as F

from timeloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    out = ""
    for f in merkle.FIELDS:
        v = row[f]
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return hashlib.sha256(out.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, pos):
    out = []
    for level in tree[:-1]:
        if (pos ^ 1) < len(level):
            out.append(level[pos ^ 1])
        pos >>= 1
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault("" if r["lang"] is None else "=" + r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = sorted(groups, key=str.encode)
    trees = {g: levels([x[2] for x in sorted(groups[g])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    return sorted(str((x[1] if x[0] else None, x[2], trees[g][-1][0], top[-1][0], h(*siblings(trees[g], i), *siblings(top, j))))
                  for j, g in enumerate(names) for i, x in enumerate(sorted(groups[g])))


def found(done):
    return sorted(str((r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.proof_sha256)) for r in done.collect())


def test_odd_rows_against_brute_force(docs):
    rows = [r.asDict() for r in docs.collect()]
    done = merkle.verify(merkle.manifest(docs, bits=2))
    assert found(done) == brute(rows)
    assert done.where("not verified").count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 16, 17, 33, 65])
def test_sizes_around_the_blocks(spark, n):
    """Groups of one row, of whole blocks and of one row more, over up to four levels."""
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 11 != 3, F.lit("x")).alias("lang"), F.lit("s").alias("source"),
                               F.lit(3).alias("n_chars"), F.lit("abc").alias("text"))
    done = merkle.verify(merkle.manifest(df, bits=2))
    assert found(done) == brute([r.asDict() for r in df.collect()])
    assert done.where("verified").count() == n


def test_one_language_and_a_row_that_repeats(spark):
    df = spark.range(90).select(F.lit(7).alias("doc_id"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
                                F.lit(None).cast("long").alias("n_chars"), F.lit("").alias("text"))
    assert found(merkle.verify(merkle.manifest(df, bits=3))) == brute([r.asDict() for r in df.collect()])


def test_change_of_a_field_is_found(spark, docs):
    kept = docs.where("n_chars is not null and doc_id is not null")
    done = merkle.verify(merkle.manifest(kept, {"n_chars": F.col("n_chars") + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)}, bits=2), "other")
    bad = {r.doc_id for r in done.where("not verified").collect()}
    assert bad == {r.doc_id for r in kept.where("doc_id % 3 = 0").collect()}
    assert done.where("not verified and folded_root = lower(hex(root))").count() == 0


def test_frontier_extends_witnesses_as_siblings_complete():
    tree = merkle.Frontier()
    leaves = [bytes([i]) * 32 for i in range(7)]
    sizes = []
    for x in leaves:
        tree.append(x)
        sizes.append([len(w) for w in tree.witness])
    assert sizes[1] == [33, 33] and sizes[2] == [33, 33, 0] and sizes[3] == [66] * 4
    root = tree.close(3)
    assert all(merkle.fold(x, bytes(w)) == root for x, w in zip(leaves, tree.witness, strict=True))
    assert merkle.fold(leaves[1], bytes(tree.witness[0])) != root


def test_empty_table(no_docs):
    assert merkle.verify(merkle.manifest(no_docs)).collect() == []
