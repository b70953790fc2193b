"""Spelling variants against brute force: counts, near words, forms, roots."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from featuremart.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(rows, alter=True):
    n = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if alter and h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(n):
    masks = {}
    for w in n:                       # words that share a pattern with one place open, or one letter less
        for i in range(len(w)):
            masks.setdefault(("r", w[:i], w[i + 1:]), set()).add(w)
            masks.setdefault(("d", w[:i] + w[i + 1:]), set()).add(w)
    out = {}
    for w in n:
        near = set().union(*(masks[("r", w[:i], w[i + 1:])] for i in range(len(w)))) - {w}
        near |= masks.get(("d", w), set()) | {w[:i] + w[i + 1:] for i in range(len(w))} & n.keys()
        best = min(near, key=lambda v: (-n[v], v), default=None)
        ok = best is not None and n[best] >= 2 * n[w]
        out[w] = (best if ok else None, len(near), n[best] if ok else None)
    rows = set()
    for w, (form, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n[w], near, form_n))
    return rows


def result(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_index_finds_exactly_the_near_words():
    rng = random.Random(3)
    words = {"".join(rng.choice("abà") for _ in range(rng.randint(2, 7))) for _ in range(500)}
    words = sorted(words | {"a" * n for n in (30, 31, 32, 60)})
    counts = np.array([rng.randint(1, 9) for _ in words])
    asked = words + ["zzzzz", "abz"]
    near = Counter()
    for reverse in (False, True):
        for w, n, _, _ in spelling._search_shard(words, counts, asked, reverse):
            near[w] += n
    assert {w: sum(is_near(w, v) for v in words) for w in asked} == {w: near[w] for w in asked}


def test_index_on_few_words():
    index = spelling.WordIndex(["abcde"])
    q, w = index.near(["abcd", "abcde", "abxde", "yyyyy", "bcde"], np.array([2, 3, 2, 3, 2]))
    assert sorted(zip(q.tolist(), w.tolist())) == [(2, 0), (4, 0)]  # "abcd" lacks the last letter


@pytest.mark.parametrize("shard_words", [1 << 14, 40])
def test_variants_match_brute_force(spark, shard_words):
    """Odd rows, and keys split into parts of words and queries."""
    rng = random.Random(5)
    hot = ["prefix" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 4))) for _ in range(300)]
    base = hot + ["".join(rng.choice("abcé") for _ in range(rng.randint(4, 7))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(base).title() + rng.choice([",", " 1", "\n"]) for _ in range(60))) for i in range(60)]
    rows += [(None, "Zürich Zürich zürich zurich zurich zurich"), (None, None), (70, ""), (71, "x" * 3000 + " " + "x" * 3000),
             (71, "x" * 3000), (72, ("x" * 2999 + " ") * 3), rows[0], rows[0], (73, "ÀBCDE àbcde Àbcde ×÷×÷×")]
    df = spark.createDataFrame([(k, t, 1, "a") for k, t in rows], "doc_id long, text string, n long, word string")
    got = spelling.group_variants(df, alter=spelling.drop_letter("doc_id"), shard_words=shard_words)
    assert result(got) == brute(brute_counts(rows))


def test_roots_follow_forms_to_the_last(spark):
    words = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    text = " ".join(w for k, w in enumerate(words) for _ in range(3 << k))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    want = brute(brute_counts([(1, text)], alter=False))
    assert {r[2] for r in want} == {"bbbbb"} and result(spelling.group_variants(df)) == want


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert result(spelling.group_variants(empty, alter=spelling.drop_letter())) == set()
    one = spark.createDataFrame([(1, "alone alone alone ab")], "doc_id long, text string")
    assert result(spelling.group_variants(one)) == {("alone", None, "alone", 3, 0, None)}


def test_query_on_the_given_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert result(queries.op13_spelling_variants(spark, path)) == brute(brute_counts(rows))
