import hashlib
import random
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from timeloom.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(both, rows):
    """Straight from the definition, token by token."""
    a, b = both
    symbols = align.byte_symbols()
    table = {i: t for t, i in a.get_vocab().items()}
    told = []
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(symbols[c] for c in table[i]) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            ids_a = ids_b = bytes_a = bytes_b = []
        spans = []
        for parts in (bytes_a, bytes_b):
            at, out = 0, []
            for p in parts:
                out.append((at, at + len(p)))
                at += len(p)
            spans.append(out)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, at = [], [0, 0]
        for hi in cuts:
            told_ids = []
            for k, ids in enumerate((ids_a, ids_b)):
                start = at[k]
                while at[k] < len(ids) and spans[k][at[k]][1] <= hi:
                    at[k] += 1
                told_ids.append(",".join(map(str, ids[start:at[k]])))
            groups.append("|".join(told_ids))
        linked, j0 = [], 0
        for x, (s, e) in zip(ids_a, spans[0]):
            while j0 < len(ids_b) and spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(ids_b) and spans[1][j][0] < e:
                linked.append((x, ids_b[j]))
                j += 1
        told.append((doc_id, len(ids_a), len(ids_b), len(groups), linked, ";".join(groups)))
    counts = Counter(p for t in told for p in set(t[4]))
    most = Counter()
    for (x, _), c in counts.items():
        most[x] = max(most[x], c)
    return sorted(str((d, na, nb, ng, len(ls), sum(counts[p] == most[p[0]] for p in ls), sum(counts[p] for p in ls), g)) for d, na, nb, ng, ls, g in told)


def found(done):
    return sorted(str(tuple(r)) for r in done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect())


ODD = ["  two  spaces ", " ", "\n", "a \n b", "tab\tword \x0b", "end space ", "x y z", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁mark ▁",
       "é ́a ﬁ 한글 漢字🙂🙂 ß", "it's don't 'S 's s's", "1234567 89", "....!!! ;;", "\x00\x01 \x1c\x1d \x7f", " em  　wide", "a\x85 b", "zero​width"]


def test_odd_rows_against_brute_force(spark, docs, both):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(1000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(align.cross_align(df, A, B, lot_pairs=50)) == brute(both, rows)


def test_clashing_columns_and_digest(docs, both):
    done = align.cross_align(docs.withColumns({c: docs.doc_id for c in ("lot", "pairs", "times", "groups", "pair", "count")}), A, B, digest=True)
    want = sorted((str(r.doc_id), r.groups) for r in align.cross_align(docs, A, B).collect())
    assert sorted((str(r.doc_id), r.groups) for r in done.collect()) == sorted((d, hashlib.sha256(g.encode()).hexdigest() if g else "") for d, g in want)


def test_pieces_give_the_tokens_of_the_whole_text(both):
    rnd = random.Random(3)
    signs = "abcdefXYZ019'!?.,-<|>s" + align.WHITE + "     éßı́漢🙂\x1c\x00"
    texts = ODD + [t for _ in range(3000) if (t := "".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 40))))]
    texts = [t for t in texts if "▁" not in t]
    a, b = align.Coder(A, B).encode(pa.array(texts))
    assert a.to_pylist() == [e.ids for e in both[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert b.to_pylist() == both[1].encode(texts)


def test_alignment_by_hand():
    a = pa.array([[0, 1], [], [2]], pa.list_(pa.int32()))  # ends 2, 5 and 4
    b = pa.array([[0, 0, 1], [], [0, 0]], pa.list_(pa.int32()))  # ends 1, 2, 5 and 1, 2 (sizes 1 and 3)
    got = align.align(a, b, [2, 3, 2], [1, 3])
    assert got.to_pydict() == {"doc": [0, 0, 0, 2, 2], "a": [0, 0, 1, 2, 2], "b": [0, 1, 2, 3, 4], "cut": [False, True, True, False, True]}


def test_empty_table(no_docs):
    assert align.cross_align(no_docs, A, B).collect() == []
