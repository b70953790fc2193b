"""Nearest neighbours by inner product: probed lists with an adaptive scan.

Largest inner product becomes smallest distance in one dimension more
(``x' = (x, sqrt(M - |x|^2))``, ``q' = (q, 0)`` with M the largest squared
norm). Rows are assigned to the nearest of the centres of a k-means fitted on a
bounded sample (``max_sample`` rows in hash order, fewer where SAMPLE_CELLS
components are fewer rows); every row is indexed. There are as many lists as the
square root of the rows, at most one for 16 rows of the sample: a larger table
asks for a larger sample. A query probes the lists nearest to it.

Inside a list the vectors are rotated by a fixed random orthogonal matrix and
read in column blocks. After each block the distance so far, scaled up to all
dimensions, estimates the whole one; a candidate is abandoned when the estimate
exceeds the query's bound by more than ``CONFIDENCE`` standard errors (for
sampling without replacement). The bound is the (1.5 k)-th best distance among
the sample, which holds for the whole table too. Survivors are scored exactly,
in double precision, on the original vectors. A query left with fewer than k
rows (tests may abandon too many) is scanned against all rows without tests.

The number of probes is calibrated: for up to ``CALIBRATION`` queries the exact
neighbours are found by a scan of all rows in blocks, and as many lists are
probed as hold TARGET of those neighbours. If the probed lists hold fewer rows
than asked for, further lists are probed until they do.

A list longer than twice the mean, or than BLOCK_CELLS components, is cut into
blocks by hash of the id, so a common vector does not fill one task; a list's
queries go to each block. Queries are routed by id, in batches of ROUTE_ROWS, and
their vectors joined on afterwards. Beyond PART_CELLS components the queries are
dealt into parts by hash, each with its own copy of the block, and a task reads a
block for as many queries at a time as make CELLS distances: its memory grows
neither with the table nor with the dimension.

Defined results: vectors that are null, zero, of another than the commonest
dimension (the smallest of equally common ones) or hold null or non-finite
components take no part; rows with a null id neither; rows with the query's own
id are no candidates; a repeated query id is searched once (with its smallest
vector); ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.llm.common import written

MAX_SAMPLE = 16_384
SAMPLE_CELLS = 1 << 22
CALIBRATION = 256
TARGET = 0.97
CONFIDENCE = 3.0
BLOCK_COLUMNS = 16
DENSE = 0.15          # share of live candidates above which a block is read whole
SLACK = 1e-9
BLOCK_CELLS = 1 << 20
PART_CELLS = 1 << 22
ROUTE_ROWS = 1 << 16  # routed ids in a batch
ROUTE_QUERIES = 512   # queries a task routes at least
CELLS = 1 << 22       # distances held at a time by a task


def _vectors(raws, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), np.float64).reshape(-1, d)


class Index:
    """Centres, rotation and the sample that bounds each query."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, top: float, n_lists: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.top, self.d, self.ids = top, sample.shape[1], ids
        self.rotation = np.linalg.qr(rng.normal(size=(self.d + 1, self.d + 1)))[0]
        self.sample = self.lift(sample)
        c = self.sample[rng.choice(len(sample), min(n_lists, len(sample)), replace=False)]
        for _ in range(8):
            near = self._nearest(self.sample, c)
            n = np.bincount(near, minlength=len(c))
            sums = np.stack([np.bincount(near, weights=col, minlength=len(c)) for col in self.sample.T], 1)
            c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        self.centres = c

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Vectors of the table, one dimension more, rotated."""
        extra = np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))
        return np.column_stack([x, extra]) @ self.rotation

    def lift_queries(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]) @ self.rotation

    @staticmethod
    def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T

    def _nearest(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.concatenate([self._distances(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)]) \
            if len(x) else np.zeros(0, np.int64)

    def assign(self, x: np.ndarray) -> np.ndarray:
        return self._nearest(self.lift(x), self.centres)

    def order(self, q: np.ndarray) -> np.ndarray:
        """Lists from near to far, per query."""
        return self._distances(self.lift_queries(q), self.centres).argsort(1, kind="stable")

    def bounds(self, q: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
        """Squared distance within which each query has 1.5 k rows."""
        out = np.full(len(q), np.inf)
        for i in range(0, len(q), 256):
            d = self._distances(self.lift_queries(q[i:i + 256]), self.sample)
            d[ids[i:i + 256, None] == self.ids] = np.inf
            at = k + k // 2 - 1
            if d.shape[1] > at:
                out[i:i + 256] = np.partition(d, at, axis=1)[:, at]
        return out + SLACK


def adaptive_scan(q: np.ndarray, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that no hypothesis test abandons. ``q`` and ``x``
    are rotated; ``bound`` is each query's squared distance bound."""
    dims = x.shape[1]
    part = np.zeros((len(q), len(x)))
    i = j = live = None
    for lo in range(0, dims, BLOCK_COLUMNS):
        hi = min(lo + BLOCK_COLUMNS, dims)
        a, b = q[:, lo:hi], x[:, lo:hi]
        if i is None:
            part += (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
        else:
            live += ((a[i] - b[j]) ** 2).sum(1)
        error = CONFIDENCE * np.sqrt((dims - hi) / (dims * hi))
        limit = bound * (1 + error) ** 2 * (hi / dims) + SLACK
        if i is None:
            ok = part <= limit[:, None]
            if hi == dims or ok.mean() < DENSE:
                i, j = np.nonzero(ok)
                live = part[i, j]
            else:
                part[~ok] = np.inf
        else:
            ok = live <= limit[i]
            i, j, live = i[ok], j[ok], live[ok]
    return i, j


def _usable(df: DataFrame, key: str, vec: str) -> tuple[DataFrame, int]:
    """(id, v array<double>) of the rows that take part, and their dimension."""
    v = F.transform(vec, lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(key).cast("long").alias("id"), v.alias("v")) \
        .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)) \
        .where(~bad & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = size[0].d if size else 0
    return rows.where(F.size("v") == d), d


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def nearest_in_block(index: Index, q_id: np.ndarray, q: np.ndarray, bound: np.ndarray, id_: np.ndarray,
                     x: np.ndarray, k: int) -> list[tuple]:
    """(query ids, row ids, scores) of the k nearest rows for each query."""
    found, lifted, step = [], index.lift(x), max(1, CELLS // max(len(x), 1))
    for s in range(0, len(q), step):
        part, part_id = q[s:s + step], q_id[s:s + step]
        qi, xj = adaptive_scan(index.lift_queries(part), lifted, bound[s:s + step])
        other = part_id[qi] != id_[xj]
        qi, xj = qi[other], xj[other]
        for lo, hi in zip(*_runs(qi)):
            score = _dot(part[qi[lo:hi]], x[xj[lo:hi]])
            best = _best(id_[xj[lo:hi]], score, k)
            found.append((part_id[qi[lo + best]], id_[xj[lo + best]], score[best]))
    return found


def search(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vec: str = "embedding",
           max_sample: int = MAX_SAMPLE, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found. ``is_query``
    is a condition on the key column ``id``."""
    spark = df.sparkSession
    rows, d = _usable(df, key, vec)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("asked"), F.max(
        F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("top")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not stats.n:
        return spark.createDataFrame([], schema)
    max_sample = max(1, min(max_sample, SAMPLE_CELLS // d))
    sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(max_sample).toArrow()  # at most SAMPLE_CELLS numbers
    index = Index(np.concatenate([c.flatten().to_numpy() for c in sample["v"].chunks]).reshape(-1, d),
                  sample["id"].to_numpy(), stats.top, min(max(1, max_sample // 16), max(1, round(stats.n ** 0.5))))
    shared = spark.sparkContext.broadcast(index)  # max_sample x (d + 1) numbers and fewer centres

    def place(batches):
        for b in batches:
            x = b.column(1).values.to_numpy().reshape(-1, d) if b.num_rows else np.zeros((0, d))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shared.value.assign(x), pa.int32()), b.column(0),
                 pa.array([r.tobytes() for r in x], pa.binary())], names=["list", "id", "v"])

    # v is sliced from a list column; flatten() keeps offsets right
    flat = rows.select("id", "v")
    indexed = written(spark, flat.mapInArrow(_flat(place), "list int, id long, v binary"), "ann-index")
    counts = np.zeros(len(index.centres), np.int64)
    for r in indexed.groupBy("list").count().collect():  # a row per list
        counts[r["list"]] = r["count"]
    queries = indexed.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    probes = _calibrate(indexed, queries, index, k, target)
    block = min(max(1, BLOCK_CELLS // d), max(64, -(-2 * stats.n // len(index.centres))))
    query_parts = max(1, -(-stats.asked * d // PART_CELLS))
    parts = -(-counts // block)

    def route(whole: bool):
        def run(batches):
            ix, out, n_out = shared.value, [], 0

            def flush():
                cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 4
                out.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                    pa.int32(), pa.int32(), pa.int64(), pa.float64()))], names=["list", "part", "id", "bound"])

            for b in batches:
                for at in range(0, b.num_rows, 256):
                    some = b.slice(at, 256)
                    ids, q = some.column(0).to_numpy(), _vectors(some.column(1).to_pylist(), d)
                    bound = np.full(len(q), np.inf) if whole else ix.bounds(q, ids, k)
                    for i, lists in enumerate(ix.order(q)):
                        held = np.cumsum(counts[lists])
                        # the query's own rows are no candidates, so one row more is asked for
                        n = max(probes, int(np.searchsorted(held, min(k + 1, held[-1]))) + 1)
                        lists = lists if whole else lists[:n]
                        to = np.repeat(lists, parts[lists])
                        part = np.arange(len(to)) - np.repeat(np.cumsum(parts[lists]) - parts[lists], parts[lists])
                        out.append((to, part, np.full(len(to), ids[i]), np.full(len(to), bound[i])))
                        n_out += len(to)
                        if n_out >= ROUTE_ROWS:
                            yield flush()
                            n_out = 0
            yield flush()
        return run

    cut = F.element_at(F.array(*[F.lit(int(max(p, 1))) for p in parts]), F.col("list") + 1)
    blocks = indexed.withColumn("part", F.pmod(F.xxhash64("id"), cut).cast("int")) \
        .withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ix = shared.value
        q_id, id_, found = right["id"].to_numpy(), left["id"].to_numpy(), []
        if len(q_id) and len(id_):
            q, x = _vectors(right["v"], d), _vectors(left["v"], d)
            found = nearest_in_block(ix, q_id, q, right["bound"].to_numpy(), id_, x, k)
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols)))

    def nearest(asked: DataFrame, whole: bool) -> DataFrame:
        # a fixed number of tasks: the few rows that come in become many
        tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stats.asked // ROUTE_QUERIES)))
        routed = asked.repartition(tasks, "id").mapInArrow(route(whole), "list int, part int, id long, bound double")
        routed = routed.join(asked, "id").withColumn("asked", F.pmod(F.xxhash64("id"), F.lit(query_parts)).cast("int"))
        group = ["list", "part", "asked"]
        hits = blocks.groupBy(*group).cogroup(routed.groupBy(*group)) \
            .applyInPandas(scan, "query_id long, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = written(spark, nearest(queries, False), "ann-found")
    full = found.groupBy("query_id").count().where(F.col("count") >= min(k, stats.n - 1))
    short = queries.join(full.select(F.col("query_id").alias("id")), "id", "left_anti").select("id", "v")
    short = written(spark, short, "ann-short")
    if not short.limit(1).count():
        return found
    again = nearest(short, True)
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti") \
        .select(*found.columns).unionByName(again)


def _flat(fn):
    """Give ``fn`` batches whose list column is not a slice of a larger one."""
    def run(batches):
        def whole():
            for b in batches:
                lists = b.column(1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(
                        np.asarray(lists.offsets) - lists.offsets[0].as_py(), pa.int32()), lists.flatten())],
                    names=b.schema.names)
        yield from fn(whole())
    return run


def _runs(x: np.ndarray):
    """Begin and end of the runs of equal values in a sorted array."""
    edges = np.flatnonzero(np.diff(x)) + 1
    return (np.concatenate([[0], edges]), np.concatenate([edges, [len(x)]])) if len(x) else ((), ())


def _calibrate(indexed: DataFrame, queries: DataFrame, index: Index, k: int, target: float) -> int:
    """Lists to probe so that they hold ``target`` of the exact neighbours of
    a bounded set of queries."""
    asked = queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATION).collect()
    if not asked:
        return 1
    d = index.d
    ids, q = np.array([r.id for r in asked]), _vectors([bytes(r.v) for r in asked], d)

    def run(batches):
        for b in batches:
            lists, id_ = b.column(0).to_numpy(), b.column(1).to_numpy()
            score = q @ _vectors(b.column(2).to_pylist(), d).T
            score[ids[:, None] == id_] = -np.inf
            out = []
            for i, s in enumerate(score):
                best = _best(id_, s, k)
                out += [(i, int(lists[j]), int(id_[j]), float(s[j])) for j in best if s[j] > -np.inf]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.int32(), pa.int32(), pa.int64(), pa.float64()))], names=["i", "list", "id", "score"])

    exact = indexed.mapInArrow(run, "i int, list int, id long, score double") \
        .withColumn("rank", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), "id"))) \
        .where(F.col("rank") <= k).select("i", "list").collect()  # at most CALIBRATION x k rows
    if not exact:
        return 1
    at = np.empty((len(q), len(index.centres)), np.int64)
    np.put_along_axis(at, index.order(q), np.arange(len(index.centres))[None, :], 1)
    depth = np.sort([at[r.i, r.list] for r in exact])
    return int(depth[min(len(depth) - 1, int(np.ceil(target * len(depth))) - 1)]) + 1
