import public_tokenizers as P
import pytest
import tiktoken

from timeloom.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_documents_match_the_library(docs):
    got = bpe.encode_decode(docs, PATH, P.PATTERN).collect()
    want = sorted(((r.doc_id, ENC.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=repr) == want


def test_empty_table(no_docs):
    out = bpe.encode_decode(no_docs, PATH, P.PATTERN)
    assert out.columns == ["doc_id", "ids", "decoded"] and out.count() == 0


def test_round_trip_through_ids(docs):
    coded = bpe.encode_decode(docs, PATH, P.PATTERN, decode=False)
    assert coded.columns == ["doc_id", "ids"]
    back = sorted(((r.doc_id, bytes(r.decoded)) for r in bpe.decode_ids(coded, PATH).collect()), key=repr)
    assert back == sorted(((r.doc_id, (r.text or "").encode()) for r in docs.collect()), key=repr)


def test_unknown_id_is_an_error(spark):
    df = spark.createDataFrame([(1, [10, 999_999])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode_ids(df, PATH).collect()


def test_long_pieces_contract_alike():
    coder = bpe.PieceCoder(RANKS)
    for piece in (b"a" * 700, b"abcab" * 90, bytes(range(97, 123)) * 20, "éß漢".encode() * 60, b"=" * 127, b"=" * 128):
        want = list(ENC._encode_single_piece(piece))
        assert coder._encode_long(piece) == want
        assert coder.encode([piece])[0].tolist() == want
    few = [b"the", b" the", b"", b"xqzjv"]
    ids, counts = coder.encode(few)
    assert counts.tolist() == [len(ENC._encode_single_piece(p)) if p else 0 for p in few]
    assert coder.decode(ids, counts) == few


def test_query_digests(spark):
    import hashlib

    from timeloom.llm.queries import QUERIES

    SF = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op3_bpe"](spark, SF).collect():
        ids = ENC.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
