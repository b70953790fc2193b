"""SimHash components against all pairs on small tables."""

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from featuremart.llm import queries, simhash as s
from tests.conftest import SF_CHECK


def brute_print(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, radius=2):
    """prints: list of (doc, fp)."""
    distinct = sorted({fp for _, fp in prints})
    x = np.array(distinct, np.uint64)
    root = {fp: fp for fp in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, fp in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1:] ^ x[i]) <= radius):
            root[find(fp)] = find(distinct[i + 1 + j])
    low = {}
    for doc, fp in prints:
        r = find(fp)
        if doc is not None:
            low[r] = min(low.get(r, doc), doc)
    return {fp: low.get(find(fp)) for fp in distinct}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBc É\n\t", max_size=40) | st.none())
def test_fingerprint(text):
    assert s.fingerprint(text) % 2**64 == brute_print(text)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in docs]
    want = brute_components(prints)
    got = {r.doc_id: r for r in queries.op7_simhash(spark, SF_CHECK).collect()}
    assert len(got) == len(docs)
    for doc, fp in prints:
        assert got[doc].fingerprint == f"{fp:016x}" and got[doc].component_id == want[fp]
    assert len(set(want.values())) < len(prints)


def test_chains_and_tiles(spark):
    """Dense clusters and long chains, over tiles of four fingerprints."""
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for start in rng.sample(sorted(fps), 12):
        f = start
        for _ in range(25):
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.add(f)
    prints = [(i + 10, f) for i, f in enumerate(sorted(fps, key=lambda _: rng.random()))]
    prints += [(5, prints[0][1]), (None, prints[3][1])]
    df = spark.createDataFrame([(d, f - 2**64 if f >> 63 else f) for d, f in prints], "doc long, fp long")
    for tile in (4, 2048):
        s_tile = s.links.__defaults__
        s.links.__defaults__ = (s.RADIUS, tile)
        try:
            got = {r.fp % 2**64: r.doc for r in s.components(df).collect()}
        finally:
            s.links.__defaults__ = s_tile
        assert got == brute_components(prints)


def test_keep_one_and_odd_rows(spark):
    long = "word " * 40000
    rows = [(3, "one two three four", "a"), (2, "One two THREE four", "b"), (9, None, "c"), (8, "", "d"),
            (None, "alone here now indeed", "e"), (7, long, "f"), (7, long, "g"), (4, "x", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, simhash_fp string")
    kept = s.keep_one(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id or -1) for r in kept.collect())
    assert got == [-1, 2, 4, 7, 8]
    assert s.keep_one(df.limit(0)).count() == 0 and s.near_duplicates(df.limit(0)).count() == 0
