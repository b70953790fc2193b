"""Threshold algorithm against brute force: windows, ties, odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremart.llm import hard_negatives as H
from featuremart.llm import queries
from tools.oracle_check import compare, duck_connect

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id string"


def new_label(i, label):
    return (label + 1) % 10 if i % 7 == 0 else label


def brute(rows, every=100, scale=256):
    ok = [(i, new_label(i, c), tuple(math.floor(scale * x) for x in v)) for i, v, c in rows
          if i is not None and c is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dims = Counter(len(v) for _, _, v in ok)
    d = min(dims, key=lambda n: (-dims[n], n), default=0)
    ok = [r for r in ok if len(r[2]) == d]
    anchors = {}
    for r in sorted(ok):
        if r[0] % every == 0:
            anchors.setdefault(r[0], r)
    out = []
    for a, label, v in anchors.values():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, c) for i, c, w in ok if i != a)
        positives = [(i, -s) for s, i, c in scored if c == label][:5]
        for place, (p, ps) in enumerate(positives, 1):
            window = [(i, -s) for s, i, c in scored if c != label and 80 * ps <= -100 * s <= 100 * ps][:5]
            out += [(a, p, k, i, ps, s, place) for k, (i, s) in enumerate(window, 1)]
    return sorted(out)


def run(spark, rows, every=100, **more):
    df = spark.createDataFrame([(i, v, c, "x", "y") for i, v, c in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, H.mine(df, F.col("id") % every == 0, label, **more).collect()))


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = (centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, d))).astype(np.float32)
    return [(i, [float(z) for z in v], int(c)) for i, (v, c) in enumerate(zip(x, rng.integers(0, 10, n)))]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 100, "anchor_part": 7}])
def test_matches_brute_force(spark, sizes):
    rows = clustered(600, 8, 1)
    got = run(spark, rows, every=20, **sizes)
    assert got == brute(rows, every=20) and len(got) > 300


def test_ties_repeats_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.5, 1.0, 2.0]) for _ in range(3)], rng.randint(0, 3)) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0, 1.0], 1) for i in range(200)]        # one very common vector
    rows += [(None, [1.0, 1.0, 1.0], 1), (301, None, 1), (302, [1.0, None, 1.0], 1), (303, [1.0, math.nan, 1.0], 1),
             (304, [math.inf, 1.0, 1.0], 1), (305, [1.0, 1.0], 1), (306, [], 1), (307, [1.0, 1.0, 1.0], None),
             (400, [0.0, 0.0, 0.0], 1), (401, [0.0, 0.0, 0.0], 2), (402, [-1.0, -2.0, 0.0], 1),
             (500, [-3.0, 1.0, 0.0], 2), (500, [1.0, 1.0, 1.0], 2), (7, [2.0, 2.0, 2.0], 9), (9, [2.0, 2.0, 2.0], 9)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0], 1)]) == []


def test_components_too_large(spark):
    with pytest.raises(ValueError, match="no long holds"):
        run(spark, [(100, [1e30, 1.0], 1)])


def test_large_scores_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.uniform(1e5, 2e5))) for _ in range(4)], rng.randint(0, 1)) for i in range(120)]
    assert run(spark, rows, every=10) == brute(rows, every=10)


def test_lists_are_not_read_to_the_end():
    """On vectors with few large components the threshold stops early."""
    rng = np.random.default_rng(3)
    x = np.where(rng.random((4000, 16)) < 0.1, rng.integers(100, 1000, (4000, 16)), 0)
    lists, ids, labels = H.SortedLists(x), np.arange(4000), np.zeros(4000, np.int64)
    met = []
    search = lists.search

    def counted(a, satisfied):
        out = search(a, satisfied)
        met.append(len(out[0]))
        return out

    lists.search = counted
    for i in range(50):
        got = H.positives_in_block(lists, ids, labels, (i, 0, x[i]), 5)
        s = x @ x[i]
        s[i] = -1
        if x[i].any():
            assert got == [(int(j), int(s[j])) for j in np.lexsort((ids, -s))[:5]]
    assert min(met) < 1000


def test_query_against_sql(spark):
    path = "/root/testdata/sf0.01"
    r = compare(spark, duck_connect(path), "op11", queries.op11_hard_negatives, queries.ORACLES["op11_hard_negatives"], path)
    assert r["status"] == "OK" and not r.get("types") and r["spark_rows"] > 0, r
