import numpy as np

from timeloom.llm import quality_mil as q
from timeloom.llm.queries import QUERIES


def test_gradient_of_the_attention_model():
    """Fitting lowers the loss on bags where one passage decides the label."""
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 6, 200)
    x = np.abs(rng.normal(size=(counts.sum(), q.FEATURES))).astype(np.float32) * 0.1
    y = rng.integers(0, 2, 200).astype(np.float32)
    first = np.cumsum(counts) - counts
    x[first[y == 1], 7] += 2.0
    model = q.fit_bags(x, counts, y)
    s = q.forward(model, x, counts)[0]
    assert ((s >= 0.5) == y).mean() > 0.95
    again = q.fit_bags(x, counts, y)
    assert all((model[k] == again[k]).all() for k in model)


def test_passages_cover_the_whole_text():
    x, counts = q.encode_bags([b"", b"a", b"word " * 1000])
    assert counts.tolist() == [1, 1, round(5000 / q.PASSAGE)] and len(x) == counts.sum() and not x[0].any()


def test_odd_tables(spark, docs, no_docs):
    labels = spark.createDataFrame([(0, 1, "x"), (1, 0, "x"), (5, 1, "x"), (5, 1, "x"), (12, 0, "x"), (8, 1, "x"), (9, None, "x"), (None, 1, "x"), (777, 0, "x")],
                                   "doc_id long, quality int, text string")
    model = q.fit(docs, labels)
    out = q.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in q.score(docs, None).collect()} == {0.5}
    assert q.fit(docs, labels.limit(0)) is None and q.fit(no_docs, labels) is None
    assert q.fit(docs, labels.where("quality = 1")) == {"constant": 0.99}
    assert q.add_score(no_docs, model, name="_s").columns == [*no_docs.columns, "_s"] and q.score(no_docs, model).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_quality_mil"](spark, sf).where("held_out").collect() if r.doc_id in marks]
    good = [r for r in rows if marks[r.doc_id] == 1]
    assert len(rows) > 500 and sum(r.predicted == marks[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
