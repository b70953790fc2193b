"""Quality rules with an isolation forest on their statistics.

Every whole text gives exact rule statistics (words, characters, symbols,
repeated lines, repeated five-word windows). Each becomes a rate free of length
(FEATURES), and each rate has its own trees: good texts spread widely on some of
them (repeated lines and windows, length), and in trees over all rates together
that spread hides what is odd on another. A tree takes SUBSAMPLE rows of its own, drawn
from all rows labelled good (the isolation forest's method), and splits the whole
labelled range of its rate at random; a text that few splits part from all good rows
has a short path and a high anomaly score.

Thresholds, one per rate, are calibrated on labelled rows of both kinds that pass
the base rules: the lowest score at which at most ``max_false_reject`` of the good
rows, and bad rows for ``precision`` of all, lie at or above it. A rate on which no
score does that rejects nothing. Ranges, draws and thresholds come from every labelled
row: Spark joins, scores and counts them. The driver gets the draws (TREES x SUBSAMPLE
rows) and the rows per score; a forest of TREES x 255 splits of one rate has at most
TREES x 255 + 1 scores, however many rows there are.

The statistics are written once to the shared folder; fitting and scoring read
that narrow table, not the texts again. The model is 5 x TREES x 511 nodes.

Defined results: null and empty texts have all statistics 0 and fail the base
rules (fewer than ten words); repeated rows are judged alike; without labelled
rows of both kinds the forest rejects nothing; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import written

TREES = 100
SUBSAMPLE = 256
DEPTH = 8
SYMBOLS = b"#*$%&|<>"
BLOCK_WORDS = 1 << 20
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
FEATURES = ["symbols per word", "log of mean word length", "repeated lines per line", "repeated words per word", "log of words"]
RATES = [f"r{i}" for i in range(len(FEATURES))]


def repeated_words(docs: list[list[bytes]], size: int = 5) -> np.ndarray:
    """Per document, the words covered by ``size``-word windows that occur
    twice or more in it. Exact: words become numbers, windows whose adjacent
    pairs all repeat are compared as whole number sequences."""
    out = np.zeros(len(docs), np.int64)
    ids: dict[bytes, int] = {}
    lens = np.fromiter(map(len, docs), np.int64, len(docs))
    word = np.fromiter((ids.setdefault(w, len(ids)) for d in docs for w in d), np.int64, int(lens.sum()))
    doc = np.repeat(np.arange(len(docs)), lens)
    if len(word) <= size:
        return out
    v = max(len(ids), 1)
    same = doc[:-1] == doc[1:]
    pair = (doc[:-1] * v + word[:-1]) * v + word[1:]
    pair[~same] = -1 - np.flatnonzero(~same)
    _, back, n = np.unique(pair, return_inverse=True, return_counts=True)
    again = n[back] > 1
    full = again[:len(word) - size + 1].copy()
    for k in range(1, size - 1):
        full &= again[k:len(word) - size + 1 + k]
    at = np.flatnonzero(full)
    if not len(at):
        return out
    window = np.column_stack([doc[at], *(word[at + k] for k in range(size))])
    _, back, n = np.unique(window, axis=0, return_inverse=True, return_counts=True)
    at = at[n[back.ravel()] > 1]
    cover = np.zeros(len(word) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    np.add.at(out, doc[np.cumsum(cover)[:-1] > 0], 1)
    return out


def rule_stats(texts: list[str | None]) -> np.ndarray:
    """STATS of each text, one row per text."""
    out = np.zeros((len(texts), len(STATS)), np.int64)
    block: list[list[bytes]] = []
    start = total = 0
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        words = raw.split()
        spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        out[i, :4] = (len(words), len(t or "") - spaces, sum(raw.count(bytes([s])) for s in SYMBOLS),
                      len(lines) - len(set(lines)))
        out[i, 5] = len(lines)
        block.append(words)
        total += len(words)
        if total >= BLOCK_WORDS or i == len(texts) - 1:
            out[start:i + 1, 4] = repeated_words(block)
            block, start, total = [], i + 1, 0
    return out


def with_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            s = rule_stats(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in s.T)], names=[key, *STATS])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in STATS))


def rates(stats: np.ndarray) -> np.ndarray:
    """FEATURES of each row of STATS."""
    n, chars, sym, dup, repeated, lines = stats.astype(float).T
    words = np.maximum(n, 1)
    return np.column_stack([sym / words, np.log(np.maximum(chars / words, 0.1)), dup / np.maximum(lines, 1), repeated / words, np.log(words)])


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < 10) | (100 * stats[:, 4] > 20 * stats[:, 0])


def _c(n):
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees of one feature, in heap order: node i has children 2i + 1 (below
    the split) and 2i + 2. ``path`` of a leaf: its depth and the mean depth that
    its rows would still need."""
    inner: np.ndarray
    split: np.ndarray
    path: np.ndarray
    norm: float
    threshold: float = math.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for inner, split, path in zip(self.inner, self.split, self.path):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = np.where(inner[node], 2 * node + 1 + (x >= split[node]), node)
            total += path[node]
        return np.exp2(-total / len(self.path) / self.norm)


def grow(x: np.ndarray, low: float, high: float, seed: int = 7) -> Forest:
    """Trees over draws from the values ``x``, split at random between ``low`` and ``high``."""
    rng = np.random.default_rng(seed)
    return trees([x[rng.choice(len(x), min(SUBSAMPLE, len(x)), replace=False)] for _ in range(TREES)], low, high, seed + 1)


def trees(drawn: list[np.ndarray], low: float, high: float, seed: int = 7) -> Forest:
    """A tree over each of the ``drawn`` sets of values."""
    rng = np.random.default_rng(seed)
    nodes = 2 ** (DEPTH + 1) - 1
    inner = np.zeros((len(drawn), nodes), bool)
    split, path = np.zeros((len(drawn), nodes)), np.zeros((len(drawn), nodes))
    size = max(map(len, drawn))
    for t, x in enumerate(drawn):
        todo = [(0, x, 0, low, high)]
        while todo:
            i, part, depth, lo, hi = todo.pop()
            if depth == DEPTH or len(part) <= 1 or hi <= lo:
                path[t, i] = depth + _c(len(part))
                continue
            s = rng.uniform(lo, hi)
            right = part >= s
            inner[t, i], split[t, i] = True, s
            todo += [(2 * i + 1, part[~right], depth + 1, lo, s), (2 * i + 2, part[right], depth + 1, s, hi)]
    return Forest(inner, split, path, float(max(_c(size), 1.0)))


def calibrated(score: np.ndarray, good: np.ndarray, max_false_reject: float, precision: float) -> float:
    """The lowest score that few good rows reach, and mostly bad ones."""
    return counted_level(score, good.astype(float), (~good).astype(float), max_false_reject, precision)


def counted_level(score: np.ndarray, good: np.ndarray, bad: np.ndarray, max_false_reject: float, precision: float) -> float:
    """``calibrated`` from the numbers of ``good`` and ``bad`` rows of each score."""
    level, at = np.unique(score, return_inverse=True)
    n_good, n_bad = (np.cumsum(np.bincount(at, weights=w, minlength=len(level))[::-1])[::-1] for w in (good, bad))
    ok = (n_good <= max_false_reject * good.sum()) & (n_bad >= precision * (n_bad + n_good)) & (n_bad > 0)
    return float(level[ok].min()) if ok.any() else math.inf


def labelled(stats: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every labelled document that passes the base rules, once: its key, good
    and its rates r0, r1, ..."""
    kind = stats.schema[key].dataType.simpleString()
    mark = labels.select(F.col(key), F.col("quality").cast("int").alias("good")) \
        .where(F.col(key).isNotNull() & F.col("quality").isin(0, 1)) \
        .groupBy(key).agg(F.min("good").alias("good"))
    rows = stats.groupBy(key).agg(*[F.min(c).alias(c) for c in STATS]).join(mark, key)

    def run(batches):
        for b in batches:
            s = np.column_stack([b.column(c).to_numpy() for c in STATS]) if b.num_rows else np.zeros((0, len(STATS)), np.int64)
            b = b.filter(pa.array(~base_failed(s)))
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("good"), *map(pa.array, rates(s[~base_failed(s)]).T)],
                                             names=[key, "good", *RATES])

    return rows.select(key, "good", *STATS).mapInArrow(run, f"`{key}` {kind}, good int, " + ", ".join(f"{r} double" for r in RATES))


def draws(good: DataFrame, n: int, key: str = "doc_id") -> list[np.ndarray]:
    """Per tree the rates of SUBSAMPLE of the ``n`` good rows (all, if fewer), those
    of smallest hash with the tree's number: each row is as likely as any other.
    Hashes over twice the share looked for are left out before the ranking."""
    at = F.xxhash64(F.col(key), F.col("tree"))
    rows = good.select(key, *RATES, F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).withColumn("at", at)
    if n > 4 * SUBSAMPLE:
        share = 2 * SUBSAMPLE / n
        rows = rows.where(F.col("at") < F.lit(int(-2 ** 63 + share * 2 ** 64)))
    first = Window.partitionBy("tree").orderBy("at", key)
    got = rows.withColumn("no", F.row_number().over(first)).where(F.col("no") <= SUBSAMPLE).orderBy("tree", "no").collect()
    out: list[list] = [[] for _ in range(TREES)]
    for r in got:
        out[r.tree].append([r[c] for c in RATES])
    return [np.array(x, float) for x in out]


def score_counts(rows: DataFrame, forests: list[Forest], key: str = "doc_id") -> list[tuple]:
    """Per forest its scores over all ``rows``, with the good and bad rows of each."""
    def run(batches):
        for b in batches:
            for i, f in enumerate(forests):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, i, np.int32)), pa.array(f.score(b.column(RATES[i]).to_numpy())),
                                                  b.column("good")], names=["forest", "score", "good"])

    got = rows.select("good", *RATES).mapInArrow(run, "forest int, score double, good int").groupBy("forest", "score").agg(
        F.sum("good").alias("n_good"), F.sum(1 - F.col("good")).alias("n_bad")).collect()
    return [tuple(np.array([r[c] for r in got if r.forest == i], float) for c in ("score", "n_good", "n_bad"))
            for i in range(len(forests))]


def fit(stats: DataFrame, labels: DataFrame, max_false_reject: float = 0.001,
        precision: float = 0.9, key: str = "doc_id") -> list[Forest] | None:
    """One forest per feature, from every labelled row."""
    rows = written(stats.sparkSession, labelled(stats, labels, key), "quality-labelled")
    n = rows.agg(F.count(F.lit(1)).alias("all"), F.sum("good").alias("good"), *[F.min(r).alias(f"{r}_low") for r in RATES],
                 *[F.max(r).alias(f"{r}_high") for r in RATES]).first()
    if not n["good"] or n["good"] == n["all"]:
        return None
    drawn = draws(rows.where("good = 1"), n["good"], key)
    forests = [trees([x[:, i] for x in drawn], n[f"{r}_low"], n[f"{r}_high"]) for i, r in enumerate(RATES)]
    for f, counts in zip(forests, score_counts(rows, forests, key)):
        f.threshold = counted_level(*counts, max_false_reject, precision)
    return forests


def verdict(stats: np.ndarray, forests: list[Forest] | None) -> tuple[np.ndarray, np.ndarray]:
    """(anomaly, kept): the highest score of any feature, and whether none
    reaches its threshold."""
    if not forests:
        return np.zeros(len(stats)), np.ones(len(stats), bool)
    scores = [(f.score(x), f.threshold) for f, x in zip(forests, rates(stats).T)]
    return np.max([s for s, _ in scores], axis=0), np.all([s < t for s, t in scores], axis=0)


def judge(stats: DataFrame, forests: list[Forest] | None, key: str = "doc_id") -> DataFrame:
    """stats with ``anomaly`` (0 to 1) and ``kept`` (the forest's verdict)."""
    kind = stats.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            s = np.column_stack([b.column(c).to_numpy() for c in STATS]) if b.num_rows else np.zeros((0, len(STATS)))
            a, keep = verdict(s, forests)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(a), pa.array(keep)],
                                             names=[*b.schema.names, "anomaly", "kept"])

    cols = [key, *STATS]
    return stats.select(*cols).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in STATS)
                                          + ", anomaly double, kept boolean")


def quality(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """One row per document: statistics, base_failed, anomaly, kept."""
    stats = written(docs.sparkSession, with_stats(docs), "quality-stats")
    out = judge(stats, fit(stats, labels, **limits))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("kept"))
