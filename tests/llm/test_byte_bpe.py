"""Byte BPE against tiktoken, on driver texts and awkward ones."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from featuremart.llm import byte_bpe, queries
from tests.conftest import SF_SMALL

RANK_FILE = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def pair():
    ranks = byte_bpe.read_ranks(queries.read_file(RANK_FILE))
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.TextEncoder(byte_bpe.ByteBPE(ranks), P.PATTERN), ref


HARD = ["", " ", "a" * 9000, "ab" * 3000, "x" * 4096, "x" * 4097, "!?" * 2500, "\n" * 700 + "z",
        "été " * 50, "你好世界" * 40, "<|endoftext|>", "don't we'll I'M", "​́ é", "1234567890" * 60,
        "".join(random.Random(4).choices("abc ", k=5000))]


def test_hard_texts(pair):
    enc, ref = pair
    for text, ids in zip(HARD, enc(HARD)):
        assert ids == ref.encode_ordinary(text), text[:40]
        assert enc.bpe.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_text(pair, texts):
    enc, ref = pair
    assert list(enc(texts)) == [ref.encode_ordinary(t) for t in texts]


def test_cache_limit(pair, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 3)
    monkeypatch.setattr(byte_bpe, "BATCH_CHARS", 20)
    enc, ref = pair
    enc.known = {}
    texts = [f"word{i} other{i % 3} the end" for i in range(40)]
    assert list(enc(texts)) == [ref.encode_ordinary(t) for t in texts]


def _want(ref, text):
    ids = ref.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_query_on_driver_rows(spark, pair):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op2_byte_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == _want(pair[1], docs[r.doc_id])


def test_nulls_repeats_empty_table_and_clashing_columns(spark, pair):
    rows = [(1, None, "x"), (1, "two words", "y"), (1, "two words", "y"), (None, "", None), (2, "w " * 30000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    blob = queries.read_file(RANK_FILE)
    got = byte_bpe.encode_documents(df, blob, P.PATTERN).collect()
    assert sorted(r.n_tokens for r in got) == sorted(_want(pair[1], t)[0] for _, t, _ in rows)
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert byte_bpe.encode_documents(df.limit(0), blob, P.PATTERN).count() == 0
