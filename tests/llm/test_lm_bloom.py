"""LM scores against exact n-gram dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from featuremart.llm import chunks, lm_bloom as lm, queries
from tests.conftest import SF_SMALL


def toks(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def low(c):
    return 2 ** int(math.log2(c)) if c else 0


def high(c):
    return 2 ** (int(math.log2(c)) + 1) - 1 if c else 0


class Model:
    """The model without false positives, from plain dictionaries."""

    def __init__(self, docs, order=3):
        self.order, self.uni, self.grams = order, Counter(), Counter()
        for _, text, out in docs:
            if not out:
                t = toks(text)
                self.uni.update(t)
                for n in range(2, order + 1):
                    self.grams.update(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
        self.n, self.v = sum(self.uni.values()), len(self.uni)

    def upper(self, gram):
        """Upper end of an n-gram's level, at most the counts of what it holds."""
        if len(gram) == 1:
            return self.uni[gram[0]]
        return min(high(self.grams[gram]), self.upper(gram[1:]), self.upper(gram[:-1]))

    def lower(self, gram):
        return min(low(self.grams[gram]), low(min(self.upper(gram[1:]), self.upper(gram[:-1]))))

    def base(self, w):
        return (self.uni[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def p(self, w, history):
        p = self.base(w)
        for m in range(1, min(len(history), self.order - 1) + 1):
            h = tuple(history[len(history) - m:])
            p = (self.lower((*h, w)) + lm.MU * p) / (self.upper(h) + lm.MU)
        return p


def brute(docs, order=3):
    """docs: (id, text, held out)."""
    model, res = Model(docs, order), {}
    for i, text, out in docs:
        t = toks(text)
        total = sum(math.log10(model.p(w, t[:k][-(order - 1):])) for k, w in enumerate(t))
        res[i] = (out, len(t), sum(model.uni[w] > 0 for w in t), model.n, sum(math.log10(model.base(w)) for w in t), total)
    return res


def compare(got, want, off=0.02, near=1.0):
    """Counts and base scores of every row; scores within ``off`` for the share
    ``near`` of the rows (a false positive can move a text that repeats one
    n-gram as a whole)."""
    assert len(got) == len(want)
    same = close = 0
    for r in got:
        out, n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        close += r.score == pytest.approx(score, rel=off)
        same += r.score == pytest.approx(score, rel=1e-9)
    assert close >= near * len(got)
    assert sum(r.score for r in got) == pytest.approx(sum(w[5] for w in want.values()), rel=off)
    return same / len(got)


def test_query(spark):
    docs = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
            for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op9_lm_bloom(spark, SF_SMALL).collect()
    compare(got, brute(docs), 0.02, 0.97)
    held = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # better on unseen texts


def test_exact_without_false_positives(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(lm, "BITS_PER_NGRAM", 400)
    monkeypatch.setattr(lm, "SPARE_BITS", 40)
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 200)
    monkeypatch.setattr(lm, "SLICE_KEYS", 64)
    texts = ["the cat sat on the mat", "The cat sat", None, "", "dog " * 30, "the cat ran é", "x\x0by\x1cz"] * 4
    docs = [(i, t, i % 5 == 1) for i, t in enumerate(texts)] + [(None, "the cat", False)]
    df = spark.createDataFrame([(i, t, "q") for i, t, _ in docs], "doc_id long, text string, score string").repartition(3)
    got = lm.score(df, F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))).collect()
    assert compare(got, brute(docs), 1e-9) == 1
    assert lm.score(df.limit(0), F.lit(False)).count() == 0
    nothing = lm.score(df, F.lit(True)).collect()
    assert len(nothing) == len(docs) and all(r.train_tokens == 0 and r.n_known == 0 for r in nothing)


def test_levels_and_false_positive_rate():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**48, 20_000).astype(np.uint64))
    n = rng.geometric(0.4, len(keys))
    level, bits = 1 + np.log2(n).astype(int), 8 * (20 * len(keys) // 8)
    f = lm.CountFilter(np.frombuffer(lm.CountFilter.fill(keys, level, bits), np.uint8), 0, bits, 48)
    got = f.levels(keys)
    assert (got >= level).all() and (got == level).mean() > 0.97
    assert (f.levels(rng.integers(0, 2**48, 20_000).astype(np.uint64)) > 0).mean() < 0.03
    below, above = lm.level_bounds(got, n.astype(float))
    assert (below <= n).all() and (above == n).all() and not lm.level_bounds(got, np.zeros(len(got)))[0].any()
    below, above = lm.level_bounds(level, np.full(len(n), 1e9))
    assert (below <= n).all() and (n <= above).all() and (above < 2 * n + 1).all()


def test_probabilities_of_a_contexts_successors_add_up_to_one_at_most(spark):
    """Also where several successors fill their levels differently (three of count 4 in a context of 12)."""
    docs = [(i, t, False) for i, t in enumerate(["a b c", "a b d", "a b e"] * 4 + ["a b", "b b b b b a", "c a c a d"])]
    docs += [(100 + r.doc_id, r.text[:3000], False) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20).collect()]
    model = Model(docs)
    contexts = {()} | {g[:1] for g in model.grams} | {g for g in model.grams if len(g) == 2 and g[-1] is not None}
    some = sorted((h for h in contexts if None not in h), key=str)[::17] + [("a", "b"), ("a",), ("b",), ()]
    words = [w for w in model.uni]
    for h in some:
        # the additive part gives the unseen word 0.5 / (N + 0.5 (V + 1))
        assert sum(model.p(w, h) for w in words) <= 1 + 1e-9, h


def test_scorer_holds_the_broadcast_group_and_no_counts(spark):
    """Every pass reads the requests (keys alone) of its group and probes the group's bits."""
    requests = spark.createDataFrame([(0, 1, b"")], "grp long, chunk long, keys binary")
    bits = spark.sparkContext.broadcast(bytes(8))
    found = lm.probe(requests, bits, 0, 64, 24, 0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and "Aggregate" not in plan and "counts" not in plan
    # what it finds is in the bits: a filter with one n-gram at level 3 answers for that n-gram alone
    keys = np.array([5, 9], np.uint64)
    bits = spark.sparkContext.broadcast(lm.CountFilter.fill(keys[:1], np.array([3]), 1 << 12))
    asked = spark.createDataFrame([(0, 1, bytearray(lm._pack_sorted(keys)))], "grp long, chunk long, keys binary")
    (row,) = lm.probe(asked, bits, 0, 1 << 12, 24, 0).collect()
    assert lm._unpack(bytes(row.levels), np.uint8).tolist() == [3, 0]


@pytest.mark.parametrize("group_bytes", [1 << 11, 1 << 14])
def test_scores_do_not_depend_on_the_size_of_a_group(spark, group_bytes, monkeypatch):
    """Many passes give the levels of one; no group is larger than its bound."""
    monkeypatch.setattr(lm, "SLICE_KEYS", 1 << 11)
    sent = []
    broadcast = spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda v: sent.append(len(v)) or broadcast(v))
    got = {r.doc_id: r.score for r in queries.op9_lm_bloom(spark, SF_SMALL, group_bytes=group_bytes).collect()}
    assert len(sent) > 3 and max(sent) <= max(group_bytes, 1 << 12)
    one = {r.doc_id: r.score for r in queries.op9_lm_bloom(spark, SF_SMALL).collect()}
    assert got == one


def test_training_rows_of_many_chunks_are_merged_before_they_are_sent(spark, monkeypatch):
    """With ten times the chunks, rows sent to the slices do not grow with chunks x slices."""
    monkeypatch.setattr(lm, "SLICE_KEYS", 1 << 10)
    rows = []
    for size in (1 << 18, 1 << 15):
        monkeypatch.setattr(chunks, "CHUNK_BYTES", size)
        df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id", "text as lm_text", "true as lm_train")
        c = chunks.chunked(df, "test-lm", "lm_text", lambda t: int(chunks.word_counts(t).sum()) + len(t))
        rows.append((c.count(), lm._training_counts(c, 3, 6, 40).count()))
    (few, a), (many, b) = rows
    assert many > 4 * few and b <= 2 * a, rows
