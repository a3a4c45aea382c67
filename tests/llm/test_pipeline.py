import importlib
import re

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from timeloom.llm import bpe, mixing, simhash
from timeloom.session import stage_table

SF = "/root/testdata/sf0.01"  # enough labels to learn from
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "mixing", "byte_bpe"]
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage_table(stage(spark, docs, SF), name)
        seen[name] = docs
        assert (docs.columns == COLUMNS) == (name != "byte_bpe")
    rows = {k: v.collect() for k, v in seen.items()}

    # the classifier only takes rows away, and none that is labelled good
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    kept = {r.doc_id for r in rows["quality_classifier"]}
    assert kept <= {r.doc_id for r in rows["documents"]} and len(good - kept) <= 0.02 * len(good)
    # line dedup keeps every document; each line that stays does so once
    assert {r.doc_id for r in rows["line_dedup"]} == kept
    lines = [x for r in rows["line_dedup"] for x in r.text.split("\n") if x.split()]
    assert len(lines) == len(set(lines)) and all(r.n_chars == len(r.text) for r in rows["line_dedup"])
    assert set(lines) <= {x for r in rows["quality_classifier"] for x in r.text.split("\n")}
    # near dedup keeps whole rows, one of each group
    near = {r.doc_id: r.text for r in rows["simhash_near_dedup"]}
    assert len(near) == len(rows["simhash_near_dedup"]) and sum(not t.split() for t in near.values()) <= 1
    # the mix gives each source its target in words
    sized = seen["simhash_near_dedup"].select("source", mixing.n_words(F.col("text")).alias("size"))
    want = {r.source: r.target for r in mixing.targets(sized).collect()}
    got = {}
    for r in rows["mixing"]:
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert all(abs(got.get(s, 0) - t) <= 0.5 for s, t in want.items())
    # ids are the library's
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert sorted((r.doc_id, enc.encode_ordinary(r.text)) for r in rows["mixing"]) == sorted((r.doc_id, r.ids) for r in rows["byte_bpe"])
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows["byte_bpe"])


def test_odd_documents_stay(spark, docs):
    """Null ids, an id with two texts and repeated rows: near dedup leaves one
    row of every group, and the mix takes its words from just those rows."""
    docs = stage_table(docs, "odd")
    texts = [r.text for r in docs.select("text").distinct().collect()]
    named = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = {texts[r.doc_id]: r.component_id for r in simhash.near_duplicates(named).collect()}
    first = {}  # the smallest id of each group, null last
    for r in docs.collect():
        at = (r.doc_id is None, r.doc_id or 0)
        first[group[r.text]] = min(at, first.get(group[r.text], at))
    near = stage_table(corpus_pipeline.near_dedup(spark, docs, SF), "odd-near")
    rows = near.collect()
    assert {group[r.text]: (r.doc_id is None, r.doc_id or 0) for r in rows} == first and len(rows) == len(first)
    assert {(None, "no id here"), (5, "another text of the same id")} <= {(r.doc_id, r.text) for r in rows}
    assert set(rows) <= set(docs.collect()) and near.columns == docs.columns

    mixed = stage_table(corpus_pipeline.mix(spark, near, SF), "odd-mix")
    sized = near.select("source", mixing.n_words(F.col("text")).alias("size"))
    got = {}
    for r in mixed.collect():
        got[r.source] = got.get(r.source, 0) + len(mixing_words(r.text))
        assert any(n.doc_id == r.doc_id and set(mixing_words(r.text)) <= set(mixing_words(n.text)) for n in rows)
    assert all(abs(got.get(r.source, 0) - r.target) <= 0.5 for r in mixing.targets(sized).collect())
    assert any(r.doc_id is None for r in mixed.collect())
    coded = corpus_pipeline.tokenize(spark, mixed, SF).collect()
    assert len(coded) == mixed.count() and all(r.round_trip for r in coded)


def mixing_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_odd_documents_pass_all_stages(spark, docs):
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage_table(stage(spark, rows, SF), name)
    assert all(r.round_trip for r in rows.collect())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_entry_registers_all():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
