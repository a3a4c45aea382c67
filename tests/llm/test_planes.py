import io
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from timeloom.llm import planes
from timeloom.llm.words import WordCoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def by_library(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def by_coder(texts):
    import pyarrow as pa

    ids, counts = WordCoder(PATH).encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(counts) else []


def test_ids_are_the_library_s(library, texts):
    odd = ["don't we'll'd 'sS I'M", "<|endoftext|> a<|startoftext|>b <|x|>", "é é ́a ǅ İstanbul ΣΑΣ ﬁ 한글 ㎏", "a b c　d\x85e\x1cf!\x1c!", "x\x0by\x0cz \x00 \x7f~~",
           " lead and trail ", "12345 3rd 4ᵗʰ ½", "....!!!a,b;c", "À×É÷ßª ºµÿÿ ÆØÞ'Sæøþ 5é5 é!é", "ß SS ẞ", "ẛ̣ ̈́", "\U0001f642\U0001f642 ok"]
    assert by_coder(texts + odd) == by_library(library, texts + odd)


def test_ids_of_random_strings(library):
    rnd = random.Random(5)
    signs = "abcXYZ019'!?.,-_<|> \t\n\r\x0b\x0c\x1c\x1f\x85  éÉßıỊ̇́漢字🙂ΣσςdDsSlLtTmM"
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    assert by_coder(texts) == by_library(library, texts)


def test_every_word_of_the_vocabulary(library):
    """Each entry's own string, and it with a neighbour's: the short way gives the library's merges."""
    with open(PATH, encoding="utf-8") as f:
        entries = [k.removesuffix("</w>") for k in json.load(f)["model"]["vocab"]]
    entries = [k for k in entries if k.isascii()]
    texts = entries + [a + b for a, b in zip(entries[::7], entries[3::7])]
    assert by_coder(texts) == by_library(library, texts)


@pytest.mark.parametrize("unit", [1, 8])
@pytest.mark.parametrize("top", [1, 2, 255, 256, 49407, 65535, 1 << 20, (1 << 32) - 1])
def test_planes_round_trip(unit, top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 7, 8, 1000):
        ids = rng.integers(0, top + 1, n, dtype=np.uint32)
        assert planes.from_planes(planes.to_planes(ids, unit), n, unit).tolist() == ids.tolist()
    assert planes.to_planes(np.zeros(9, np.uint32), unit) == []


def test_bit_plane_holds_its_bit():
    ids = np.array([5, 2, 7, 0, 1, 4, 4, 4, 3], np.uint32)
    got = planes.to_planes(ids)
    for p in range(3):
        bits = np.unpackbits(np.frombuffer(got[p], np.uint8), count=9, bitorder="little")
        assert bits.tolist() == [(int(x) >> p) & 1 for x in ids]


@pytest.mark.parametrize("unit", [1, 8])
def test_file_and_its_indexes(unit):
    rng = np.random.default_rng(3)
    docs = [(i if i != 4 else None, rng.integers(0, 50_000, n, dtype=np.uint32)) for i, n in enumerate([0, 3, 0, 40, 17, 0, 16, 1, 0, 0])]
    out = io.BytesIO()
    w = planes.Writer(out, chunk=16, unit=unit)
    for d, ids in docs:
        w.add(d, len(ids))
        w.extend(ids)
    w.close()
    r = planes.Reader(out, len(out.getvalue()))
    assert r.n_ids == 77 and len(r.chunks) == 5 and r.starts.tolist() == [0, 0, 3, 3, 43, 60, 60, 76, 77, 77]
    assert [None if n else int(d) for d, n in zip(r.docs, r.null)] == [d for d, _ in docs]
    for first, last in ((0, 10), (3, 5), (5, 5), (8, 10), (0, 1)):
        got = {}
        for doc, part, _ in r.pieces(first, last):
            got.setdefault(doc, []).extend(part.tolist())
        assert got == {i: docs[i][1].tolist() for i in range(first, last)}
    assert np.concatenate(list(r.stretches(20, 70))).tolist() == np.concatenate([x for _, x in docs])[20:70].tolist()


def expected(library, rows):
    out, start = [], 0
    for doc_id, ids in rows:
        ids = [*ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_of_odd_rows(spark, docs, library):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    manifest = planes.write(docs, PATH, chunk=256)
    back = planes.read_ids(manifest, split=512).collect()
    ids = by_library(library, [t for _, t in rows])
    assert sorted(str((r.doc_id, r.ids)) for r in back) == sorted(str((d, [*x, 1])) for (d, _), x in zip(rows, ids))
    back.sort(key=lambda r: r.start)
    assert [r.start for r in back] == [sum(len(x.ids) for x in back[:i]) for i in range(len(back))]
    order = [-1 if r.doc_id is None else r.doc_id for r in back]
    assert order == sorted(order)
    digests = sorted(planes.read_digests(manifest, split=512).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in digests] == expected(library, [(r.doc_id, r.ids[:-1]) for r in back])


def test_bytes_and_no_end(spark, docs, library):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    back = planes.read_ids(planes.write(docs, PATH, end_id=None, chunk=64, unit=8)).collect()
    assert sorted(str((r.doc_id, r.ids)) for r in back) == sorted(str((d, x)) for (d, _), x in zip(rows, by_library(library, [t for _, t in rows])))


def test_empty_table(no_docs):
    manifest = planes.write(no_docs, PATH)
    assert manifest.collect() == [] and planes.read_ids(manifest).collect() == [] and planes.read_digests(manifest).collect() == []
