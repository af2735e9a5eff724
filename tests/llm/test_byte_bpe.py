import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from footfall.llm import byte_bpe as B  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def test_equal_to_the_library(reference):
    rng = random.Random(3)
    codec = B.load_codec(PATH, PATTERN)
    texts = ["", "a", "  \n\n x", "<|endoftext|>", "é" * 700, "zq" * 3000, "日本語テキスト" * 300, "\x00   x", " " * 5000,
             "x" * 511, "x" * 512, "x" * 513, "don't we'll 123,456.78\r\n\t\x85\xa0end", "\U0001f600" * 200,
             "".join(rng.choice("etaoinshrdlu") for _ in range(9000))]
    alphabet = " 'sadeté1_.,\n\t\x1c\x85\xa0ßж日"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(2000)]
    got = [[] for _ in texts]
    for k, ids in codec.encode_chunks(texts):
        got[k] += ids
    assert got == reference.encode_ordinary_batch(texts, num_threads=1)
    assert all(codec.decode(ids) == t.encode() for ids, t in zip(got, texts))


def test_round_trip_of_documents(spark, reference):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in B.round_trip(docs, PATH, PATTERN).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edge_rows(spark, edge_docs, no_docs, reference, monkeypatch):
    monkeypatch.setattr(B, "_CHUNK_PIECES", 1000)  # the long text comes in parts
    encoded = B.encode(edge_docs, PATH, PATTERN)
    assert sorted(encoded.columns) == sorted(edge_docs.columns)
    decoded = B.decode(encoded, PATH, PATTERN)
    for r in decoded.collect():
        assert r.token_ids == reference.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    empty = hashlib.sha256(b"").hexdigest()
    for r in B.round_trip(edge_docs.where("text is null or text = ''"), PATH, PATTERN).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, empty, empty)
    assert B.round_trip(edge_docs, PATH, PATTERN).count() == edge_docs.count()
    assert B.encode(no_docs, PATH, PATTERN).count() == 0 and B.round_trip(no_docs, PATH, PATTERN).count() == 0
