"""Packing: ids against the tokenizers library, fills against brute force."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from featuremart.llm import packing, queries
from tests.conftest import SF_SMALL

FILE = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(queries.read_file(FILE))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=50) | st.text(alphabet="aÉ1½.,'s- !\u0301>", max_size=30), max_size=5))
def test_ids_of_any_text(tok, words, texts):
    for got, t in zip(words(texts), texts):
        assert got.tolist() == tok.encode(t, add_special_tokens=False).ids


def test_ids_of_hard_texts(tok, words):
    texts = ["\x01 a\x01b \x01", "<|endoftext|> it's", "É é́  ẍ́", "ΣΑΣ οδός İ", "a" * 3000, "１２3 ½",
             "Word, word. WORD!! É, é; ab-- a1. ½. x\u0301. ª, (a) it's, 's! ... <|endoftext|>. Ⅷ. ³, a>\u0338"]
    for got, t in zip(words(texts), texts):
        assert got.tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_ids_of_every_letter_before_punctuation(tok, words):
    """Letters whose normal or lower-case form ends in a combining mark go with the punctuation."""
    letters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    texts = [f"{x}. a{x}, {x}é!" for x in letters]
    for at in range(0, len(texts), 2000):
        part = texts[at:at + 2000]
        for got, want, t in zip(words(part), tok.encode_batch(part, add_special_tokens=False), part):
            assert got.tolist() == want.ids, t


def test_ids_of_special_strings(tok, words):
    texts = ["<|startoftext|>", "a<|startoftext|>, b", "<|endoftext|>.", "A<|endoftext|>!!", "x<|endoftext|", "<|STARTOFTEXT|>",
             "naïve, İ.", "<|startoftext|><|endoftext|>"]
    for got, t in zip(words(texts), texts):
        assert got.tolist() == tok.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=5), st.integers(0, 30))
def test_best_fill(counts, room):
    sums = {sum(k * n for k, n in zip(counts, c)) for c in itertools.product(*(range(n + 1) for n in counts.values()))}
    used = packing.best_fill(counts, room)
    assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)
    assert all(n <= counts[k] for k, n in used.items())


# 20,000 more pieces of one awkward length: 2 x 777 leaves 494, and the pieces
# above 1,271 have used the short ones
@pytest.mark.parametrize("hot, fill", [(0, 0.995), (20_000, 0.92)])
def test_plan_uses_every_piece_once_and_wastes_little(hot, fill):
    rng = random.Random(1)
    counts = defaultdict(int)
    for _ in range(50_000):
        counts[rng.randint(1, 2047)] += 1
    counts[777] += hot
    patterns = packing.plan(dict(counts))
    used, bins = defaultdict(int), 0
    for first, times, lens in patterns:
        assert first == bins and sum(k * n for k, n in lens.items()) <= 2048
        bins += times
        for k, n in lens.items():
            used[k] += n * times
    assert used == counts
    assert sum(k * n for k, n in counts.items()) / (bins * 2048) > fill


def check(rows, texts, tok, capacity):
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    assert len(docs) == len(texts)
    for i, t in texts.items():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rs in seqs.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return sum(r.length for r in rows) / (len(seqs) * capacity)


def test_query(spark, tok):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert check(queries.op6_min_slack_packing(spark, SF_SMALL).collect(), docs, tok, 2048) > 0.97


def test_odd_rows_and_copies(spark, tok, monkeypatch):
    monkeypatch.setattr(packing, "BUCKETS", 7)
    texts = {i: t for i, t in enumerate([None, "", "a " * 5000, "b " * 63] + ["same words here"] * 400)}
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in texts.items()],
                               "doc_id long, text string, length int, piece string").repartition(6)
    blob = queries.read_file(FILE)
    assert check(packing.pack(df, blob, capacity=64).collect(), texts, tok, 64) > 0.95
    got = packing.pack(df, blob, capacity=64, with_ids=True).collect()
    assert all(len(r.ids) == r.length for r in got)
    assert packing.pack(df.limit(0), blob).count() == 0
    twice = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "z")], "doc_id long, text string")
    assert packing.pack(twice, blob).count() == 3
