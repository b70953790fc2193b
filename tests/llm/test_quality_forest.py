"""Rule statistics against a direct count; the forest on held-out rows."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from featuremart.llm import quality_forest as q, queries
from tests.conftest import SF_CHECK

SF = "/root/testdata/sf0.1"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    cover = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(cover), len(lines)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#é\x0b\x85", max_size=80) | st.none(), max_size=5))
def test_stats(texts):
    assert q.rule_stats(texts).tolist() == [brute(t) for t in texts]


def test_blocks(monkeypatch):
    monkeypatch.setattr(q, "BLOCK_WORDS", 7)
    texts = ["a b c d e a b c d e", None, "x " * 30, "a b c d e", ""]
    assert q.rule_stats(texts).tolist() == [brute(t) for t in texts]


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    got = queries.op4_quality_forest(spark, SF_CHECK).collect()
    assert len(got) == len(docs)
    for r in got:
        n, chars, sym, dup, rep, _ = brute(docs[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == [n, chars, sym, dup, rep]
        assert r.base_failed == (n < 10 or 100 * rep > 20 * n)
        assert not (r.base_failed and r.kept)


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = q.quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rate = {r.quality: r.r for r in out.where("not base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("r")).collect()}
    print(rate)
    assert rate[1] > 0.98 and rate[0] < 0.1


def test_path_lengths_isolate_outliers():
    rng = np.random.default_rng(0)
    x = rng.normal(size=500)
    forest = q.grow(x, -5.0, 12.0)
    s = forest.score(np.append(x, [9.0, -4.9]))
    assert s[-2] == s.max() and s[-2] > 0.8 and s[-1] > 0.6 and np.median(s[:500]) < 0.6


def test_scores_by_hand():
    """Every tree walked node by node."""
    rng = np.random.default_rng(1)
    x = np.round(rng.exponential(size=300), 2)
    forest = q.grow(x, 0.0, 9.0)
    for v in (0.0, 0.3, 1.0, 4.0, 8.9, 20.0):
        depths = []
        for inner, split, path in zip(forest.inner, forest.split, forest.path):
            node = 0
            while inner[node]:
                node = 2 * node + (2 if v >= split[node] else 1)
            depths.append(path[node])
        assert forest.score(np.array([v]))[0] == pytest.approx(2 ** -(np.mean(depths) / forest.norm), rel=1e-12)
    counted = q.grow(np.zeros(1), 0.0, 1.0)
    assert not counted.inner.any() and counted.score(np.array([0.5])) == 1


def test_thresholds_need_both_kinds():
    score = np.array([0.9, 0.8, 0.8, 0.7, 0.5, 0.5])
    assert q.calibrated(score, np.array([0, 0, 0, 1, 1, 1], bool), 0.01, 0.9) == 0.8
    assert q.calibrated(score, np.array([0, 0, 0, 0, 1, 1], bool), 0.01, 0.9) == 0.7
    assert q.calibrated(score, np.array([0, 1, 0, 1, 1, 1], bool), 0.3, 0.9) == 0.9
    assert q.calibrated(score, np.array([1, 0, 0, 0, 0, 0], bool), 0.5, 0.9) == np.inf
    assert q.calibrated(score, np.array([1, 0, 0, 0, 0, 0], bool), 1.0, 0.8) == 0.5


def test_each_statistic_can_reject(spark):
    """Labels that call texts of one odd statistic bad: repeated short lines without a repeated window,
    repeated windows below the base limit, very long texts, symbols, long words."""
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(4000)]

    def prose(n):
        return " ".join(rng.choice(vocabulary, n))

    def lines(n):
        once = [f"{prose(2)} {i}" for i in range(n)]
        return "\n".join(x for i in range(n) for x in (once[i], f"row {i % 7}", f"{prose(3)} {i}"))

    def windows():
        again = prose(12)
        return " ".join([prose(60), again, prose(60), again, prose(40)])

    odd = {"lines": lambda: lines(60), "windows": windows, "long": lambda: prose(3000), "symbols": lambda: " ".join(f"{w}#" if k % 3 == 0 else w for k, w in enumerate(prose(90).split())),
           "words": lambda: " ".join("".join(rng.choice(list("abcdefghij"), 18)) for _ in range(80))}
    good = [prose(int(n)) for n in rng.integers(40, 400, 600)]
    for name, make in odd.items():
        bad = [make() for _ in range(60)]
        stats = q.rule_stats(bad)
        assert not q.base_failed(stats).any(), name
        texts = good + bad
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        labels = df.select("doc_id", (F.col("doc_id") < len(good)).cast("int").alias("quality"))
        kept = {r.doc_id for r in q.quality(df, labels.where("doc_id % 2 = 0")).where("kept").collect()}
        assert len(kept & set(range(len(good)))) >= 0.98 * len(good), name
        assert not [i for i in range(len(good), len(texts)) if i in kept], name


def test_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "a b " * 50000, 3), (2, "w " * 9, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    got = q.quality(df, labels).collect()
    assert len(got) == 4 and all(r.base_failed and not r.kept for r in got)
    assert q.quality(df.limit(0), labels.limit(0)).count() == 0


def test_every_labelled_row_counts(spark):
    """25,000 labelled rows: each is scored and counted, and draws reach all of them."""
    n = 25_000
    stats = spark.range(n).select(F.col("id").alias("doc_id"), *[F.lit(v).alias(c) if c != "n_symbols" else (F.col("id") % 50).alias(c)
                                                                 for c, v in zip(q.STATS, (100, 500, 0, 0, 0, 5))])
    stats = stats.select("doc_id", *[F.col(c).cast("long").alias(c) for c in q.STATS])
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 50 != 49).cast("int").alias("quality"))
    rows = q.labelled(stats, labels.union(labels))
    assert rows.count() == n
    drawn = q.draws(rows.where("good = 1"), n * 49 // 50)
    assert len(drawn) == q.TREES and all(len(x) == q.SUBSAMPLE for x in drawn)
    forests = q.fit(stats, labels)
    counts = q.score_counts(rows, forests)
    assert all(good.sum() == n * 49 // 50 and bad.sum() == n // 50 for _, good, bad in counts)
    kept = q.judge(stats, forests).groupBy((F.col("doc_id") % 50 == 49).alias("bad")).agg(F.sum(F.col("kept").cast("int"))).collect()
    assert dict(kept) == {True: 0, False: n * 49 // 50}
