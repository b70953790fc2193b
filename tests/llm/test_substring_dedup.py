"""Substring dedup against a dictionary of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from featuremart.llm import chunks, queries, substring_dedup as s
from tests.conftest import SF_SMALL


def brute(texts, window):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    n = Counter(tuple(d[i:i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = {i + k for i in range(len(d) - window + 1) if n[tuple(d[i:i + window])] > 1 for k in range(window)}
        out.append((len(d), len(gone), " ".join(w for i, w in enumerate(d) if i not in gone)))
    return out


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: w for (i, _), w in zip(docs, brute([t for _, t in docs], 35))}
    got = queries.op5_substring_dedup(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        n, gone, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
    assert sum(r.n_removed for r in got) > 0


@pytest.mark.parametrize("cells", [4, 0.01])
def test_random_texts_many_chunks_and_crowded_sketch(spark, monkeypatch, cells):
    """Results do not depend on chunk borders or on the sketch's error rate."""
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 300)
    monkeypatch.setattr(s, "CELLS_PER_WINDOW", cells)
    monkeypatch.setattr(s, "MIN_SLICE_BITS", 4)
    rng = random.Random(3)
    texts = [" ".join(rng.choices("a b c dé".split(), k=rng.randint(0, 30))) for _ in range(150)]
    texts += ["x y z w v " * 40, None, "", "a b\tc\nd", "a b c d", "same text here ok now"] * 2
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, Kept_words string, n_words int").repartition(5)
    out = s.remove_repeats(df, 4)
    assert out.columns[:4] == df.columns
    got = {r[0]: r[4:] for r in out.collect()}
    for i, (n, gone, kept) in enumerate(brute(texts, 4)):
        assert tuple(got[i]) == (kept, n, gone), texts[i]


def test_texts_without_repeats_stay_and_odd_rows(spark):
    rows = [(1, "one  two\n three"), (None, None), (2, ""), (3, "w" * 200000), (4, "p q " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in s.dedup_texts(df).collect()}
    assert got == {1: "one  two\n three", None: None, 2: "", 3: "w" * 200000, 4: ""}
    assert s.dedup_texts(df.limit(0)).count() == 0


def test_window_hashes_follow_content():
    h = np.random.default_rng(0).integers(0, 2**63, 500).astype(np.uint64)
    h[300:350] = h[100:150]
    w = chunks.window_hashes(h, 35)
    assert (w[100:116] == w[300:316]).all() and len(np.unique(w)) == len(w) - 16


@pytest.mark.parametrize("segment", [3, 50, 1 << 20])
def test_word_hashes_tell_words_apart(monkeypatch, segment):
    monkeypatch.setattr(chunks, "SEGMENT", segment)
    rng = random.Random(8)
    texts = ["".join(rng.choices("abAB é\t\n\x0b\x0c\r\x1c\x85 ", k=rng.randint(0, 60))) for _ in range(200)]
    texts += [None, "", " ", "x" * 400, "ab ba", "a b"]
    for lower in (False, True):
        words = [w for t in texts for w in
                 re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c in "AB" and lower else c for c in t or ""))]
        got, lens = chunks.word_hashes(texts, lower)
        assert lens.tolist() == chunks.word_counts(texts).tolist() == \
            [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
        by = {}
        for w, h in zip(words, got.tolist(), strict=True):
            assert by.setdefault(w, h) == h
        assert len(set(by.values())) == len(by)
    assert chunks.word_hashes([])[0].size == 0
