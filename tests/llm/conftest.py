import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture(scope="session")
def texts():
    """Texts with the cases that every operator has to stand: null, empty,
    white space only, one word, repeats, ties and one very long text."""
    long = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] for i in range(20_000))
    base = " ".join(WORDS[(3 * i + i * i) % len(WORDS)] for i in range(120))
    return [None, "", " \t\n\x0b\f\r ", "one", "Two words", base, base, base.replace("gamma", "GAMMA", 1), base + " extra",
            "línea única\nlínea única\r\nßtraße ÉTÉ 漢字 🙂\n\n" + base, "a" * 3000 + " " + "=" * 500, long,
            "x y z " * 200, "Und " * 300, "a\x00b c d", "it's we'll I'd  123  4567\n\n\tq"]


@pytest.fixture()
def docs(spark, texts):
    """A documents table of those texts: a repeated row, a repeated id, a null
    id, null source and language, and extra columns whose names clash."""
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "S0"][i % 4], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], (5, "another text of the same id", "en", "s1", 27), (None, "no id here", "en", "s1", 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("ids", "score", "size", "start", "fingerprint", "_row", "key", "node", "line", "n", "h", "_doc", "_hash", "_dropped", "dropped", "spans", "turn", "_key", "_n", "_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture()
def no_docs(docs):
    return docs.limit(0)
