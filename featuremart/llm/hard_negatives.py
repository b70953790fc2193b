"""Hard negatives by Fagin's threshold algorithm, exact.

Components become integers ``floor(scale * x)``; a score is the integer inner
product with the anchor. An anchor's positives are its best rows of the same
label; each positive opens a window of scores (``low`` to ``high`` percent of
the positive's), and the best rows of other labels inside it are the anchor's
hard negatives for that positive.

Rows are dealt by hash to blocks of about BLOCK_ROWS, anchors to parts of about
ANCHOR_PART (fewer where CELLS components are fewer rows); every part meets every block (a stated query set against all rows, in blocks).
A block keeps, per dimension, its rows sorted by that component. For an anchor
the lists are read in step, from the top where its component is positive, from
the bottom where it is negative, not at all where it is zero; the depth doubles
from FIRST_DEPTH. Rows met for the first time are scored by random access to the
whole vector. The threshold is the anchor's product with the components read
last: no unread row scores more. An anchor stops once the threshold is strictly
below the k-th best score found (strictly, so that ties can still go to the
smaller id); a window also stops once the threshold is below its lower end. On
vectors without structure the lists are read to their end and every row is
scored, which is the same result.

Two rounds: positives first, since windows need the positives of the whole
table, then one search for all windows of an anchor. A block answers with at
most k rows for each anchor (or window), which are ranked afterwards.

Products are sums of integers and are kept exact: in doubles while
``d * max^2`` is below 2^53, in 64-bit integers below 2^63. Components too large
for that raise a ValueError, as no long could hold the scores.

Defined results: rows with a null id, label or vector, an empty vector, null or
non-finite components, or another dimension than the commonest (the smallest of
equally common ones) take no part. An id that occurs more than once is one anchor
(with its smallest label, then smallest vector); as candidates such rows count one
by one, except for the anchor of the same id. Repeated positives give a window
each (``positive_rank`` tells them apart). An anchor without positives, a window
without negatives and an empty table give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import written

BLOCK_ROWS = 1 << 14
ANCHOR_PART = 1 << 12
CELLS = 1 << 21          # components of a block or part: with many dimensions they have fewer rows
FIRST_DEPTH = 16


class SortedLists:
    """A block's vectors and, per dimension, its rows in order."""

    def __init__(self, x: np.ndarray):
        biggest = float(np.abs(x).max(initial=0))
        self.exact = np.float64 if x.shape[1] * biggest ** 2 < 2 ** 53 else np.int64
        self.x, self.rows = x.astype(self.exact), np.argsort(x, axis=0, kind="stable")

    def search(self, a: np.ndarray, satisfied) -> tuple[np.ndarray, np.ndarray]:
        """Rows met and their scores, read until ``satisfied(threshold, rows,
        scores)`` or the end of the lists."""
        m = len(self.x)
        a = a.astype(self.exact)
        dims = np.flatnonzero(a)
        seen, met, scores = np.zeros(m, bool), [], []
        at, depth = 0, FIRST_DEPTH
        while at < m:
            to = min(depth, m)
            if len(dims) == 0 or 2 * to >= m:
                to = m                        # the next reading would hold every row
                new = np.flatnonzero(~seen)
            else:
                down = a[dims] > 0
                read = np.concatenate([self.rows[m - to:m - at, dims[down]].ravel(), self.rows[at:to, dims[~down]].ravel()])
                read = read[~seen[read]]
                seen[read] = True
                new = np.unique(read)
            met.append(new)
            scores.append((self.x[new] @ a).astype(np.int64))
            if to < m:
                last = np.where(down, self.rows[m - to, dims], self.rows[to - 1, dims])
                if satisfied(int(self.x[last, dims] @ a[dims]), met, scores):
                    break
            at, depth = to, depth * 2
        return np.concatenate(met), np.concatenate(scores)


def _kth(scores: np.ndarray, k: int) -> int | None:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores first, then smaller ids."""
    if len(scores) > k:
        keep = np.flatnonzero(scores >= _kth(scores, k))
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))


def positives_in_block(lists: SortedLists, ids: np.ndarray, labels: np.ndarray, anchor: tuple, k: int) -> list[tuple]:
    """(row id, score) of the k best other rows of the anchor's label."""
    anchor_id, label, a = anchor
    own = (labels == label) & (ids != anchor_id)

    def satisfied(threshold, met, scores):
        kth = _kth(np.concatenate([s[own[m]] for m, s in zip(met, scores)]), k)
        return kth is not None and threshold < kth

    met, scores = lists.search(a, satisfied)
    met, scores = met[own[met]], scores[own[met]]
    best = _best(ids[met], scores, k)
    return list(zip(ids[met[best]].tolist(), scores[best].tolist()))


def negatives_in_block(lists: SortedLists, ids: np.ndarray, labels: np.ndarray, anchor: tuple, windows: list[int],
                       k: int, low: int, high: int) -> list[tuple]:
    """(positive score, row id, score) of the k best rows of other labels in
    each window; a window is given by its positive's score."""
    anchor_id, label, a = anchor
    other = (labels != label) & (ids != anchor_id)
    # low * p <= 100 * s <= high * p, as bounds on whole s
    bounds = {p: (-(-low * p // 100), high * p // 100) for p in sorted(set(windows))}
    bounds = {p: b for p, b in bounds.items() if b[0] <= b[1]}
    if not bounds:
        return []

    def satisfied(threshold, met, scores):
        s = np.concatenate([s[other[m]] for m, s in zip(met, scores)])
        for lo, hi in bounds.values():
            if threshold < lo:
                continue
            kth = _kth(s[(s >= lo) & (s <= hi)], k)
            if kth is None or threshold >= kth:
                return False
        return True

    met, scores = lists.search(a, satisfied)
    met, scores = met[other[met]], scores[other[met]]
    out = []
    for p, (lo, hi) in bounds.items():
        inside = np.flatnonzero((scores >= lo) & (scores <= hi))
        best = inside[_best(ids[met[inside]], scores[inside], k)]
        out += [(p, i, s) for i, s in zip(ids[met[best]].tolist(), scores[best].tolist())]
    return out


def _usable(df: DataFrame, label: Column, key: str, vec: str, scale: int) -> tuple[DataFrame, int]:
    """(id, label, v array<long>) of the rows that take part, and their dimension."""
    rows = df.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                     F.transform(vec, lambda x: x.cast("double")).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()) \
        .where((F.size("v") > 0) & ~bad)
    stats = rows.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("top")) \
        .orderBy(F.desc("n"), "d").limit(1).collect()
    d, top = (stats[0].d, stats[0].top) if stats else (0, 0.0)
    if d * (scale * top + 1) ** 2 >= 2.0 ** 63:
        raise ValueError(f"components up to {top} give inner products that no long holds")
    return rows.where(F.size("v") == d).withColumn("v", F.transform("v", lambda x: F.floor(x * scale))), d


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in vectors])


def mine(df: DataFrame, is_anchor: Column, label: Column, key: str = "vec_id", vec: str = "embedding", scale: int = 256,
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
         block_rows: int = BLOCK_ROWS, anchor_part: int = ANCHOR_PART) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, positive_rank). ``is_anchor`` is a condition on the column
    ``id``, ``label`` an expression on ``df``."""
    spark = df.sparkSession
    rows, d = _usable(df, label, key, vec, scale)
    rows = written(spark, rows, "negatives-rows")
    block_rows, anchor_part = (min(n, max(1, CELLS // max(d, 1))) for n in (block_rows, anchor_part))
    anchors = rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    anchors = written(spark, anchors, "negatives-anchors")
    blocks, parts = max(1, -(-rows.count() // block_rows)), max(1, -(-anchors.count() // anchor_part))
    place = ["block", "part"]

    def part_of(name: str) -> Column:
        return F.pmod(F.xxhash64(name, F.lit(7)), F.lit(parts))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    spread = rows.withColumn("block", F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks))).withColumn("part", every(parts))

    def meet(asked: DataFrame, fn, schema: str) -> DataFrame:
        asked = asked.withColumn("part", part_of("id")).withColumn("block", every(blocks))
        names = [f.strip().split(" ")[0] for f in schema.split(",")]

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(left) and len(right):
                lists, ids, labels = SortedLists(_matrix(left["v"])), left["id"].to_numpy(), left["label"].to_numpy()
                for r in right.itertuples(index=False):
                    out += [(r.id, *x) for x in fn(lists, ids, labels, r)]
            return pd.DataFrame(out, columns=names)

        return spread.groupBy(*place).cogroup(asked.groupBy(*place)).applyInPandas(run, schema)

    def anchor(r) -> tuple:
        return r.id, r.label, np.asarray(r.v, np.int64)

    found = meet(anchors, lambda lists, ids, labels, r: positives_in_block(lists, ids, labels, anchor(r), positives),
                 "anchor_id long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    found = written(spark, found.withColumn("positive_rank", rank).where(F.col("positive_rank") <= positives),
                    "negatives-positives")
    asked = found.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("positive_score").alias("windows")).join(anchors, "id")
    hard = meet(asked, lambda lists, ids, labels, r: negatives_in_block(
        lists, ids, labels, anchor(r), [int(p) for p in r.windows], negatives, low, high),
        "anchor_id long, positive_score long, negative_id long, negative_score long")
    window = ["anchor_id", "positive_score"]
    rank = F.row_number().over(Window.partitionBy(*window).orderBy(F.desc("negative_score"), "negative_id"))
    hard = hard.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return found.join(hard, window).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                           "negative_score", "positive_rank")
