"""SimHash near-duplicates by exact comparison in tiles.

A document's fingerprint has a bit set where more than half of its shingle
hashes have it. Distinct fingerprints are laid into tiles by the population
counts of their four 16-bit lanes (at most 17**4 cells, cut into tiles of at
most ``TILE`` fingerprints). The Hamming distance is at least the sum of the
lanes' count differences, so tile pairs whose counts differ by more than the
radius are never paired: a tile meets its neighbour cells by an equality join
on the cell number. Paired tiles are compared whole, by exclusive-or and bit
counts in numpy, and give a spanning forest of their links (never all pairs).

Components: every fingerprint takes the smallest label (smallest doc_id and
its fingerprint) among its links, and labels jump to their own label's label,
until nothing changes; each round is written to the shared folder.

Defined results: null and empty texts have fingerprint zero and link like any
other; a text shorter than a shingle is one shingle; a null key is larger than
any other; repeated rows share fingerprint and component; an empty table gives
no rows; other columns are ignored (``keep_one`` passes them).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.llm.common import ASCII_LOWER, fresh, written

SHINGLE = 3
RADIUS = 2
LANES = 4
TILE = 2048


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    import xxhash

    words = text.encode().translate(ASCII_LOWER).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], 42) for a, b in zip(begins[:len(words) - k].tolist(), ends[k:].tolist())),
                    np.uint64, len(words) - k)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little", signed=True)


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in s], dtype="int64")
    return run(text)


def _lanes(fp: Column) -> list[Column]:
    width = 64 // LANES
    return [F.bit_count(F.shiftrightunsigned(fp, k * width).bitwiseAND(F.lit((1 << width) - 1).cast("long")))
            for k in range(LANES)]


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Lane count differences within the radius, each unordered pair once."""
    out: list[tuple[int, ...]] = [()]
    for _ in range(LANES):
        out = [s + (d,) for s in out for d in range(-radius, radius + 1) if sum(map(abs, s)) + abs(d) <= radius]
    return [s for s in out if s >= (0,) * LANES]


def _cell(counts: list[Column]) -> Column:
    base, cell = 64 // LANES + 1, F.lit(0)
    for c in counts:
        cell = cell * base + c
    return cell.cast("int")


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles as (fingerprint, representative) pairs that
    join what the tiles' links join."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    i, j = np.nonzero(near)
    nodes, at = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
    u, v = at[:len(i)], at[len(i):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between different fingerprints, enough to join every
    pair within the radius. ``distinct`` has one column ``fp``, no repeats."""
    lanes = _lanes(F.col("fp"))
    cells = distinct.select("fp", _cell(lanes).alias("cell"), F.array(*lanes).alias("counts"))
    parts = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).alias("parts"))  # at most 17**LANES rows
    tiles = cells.join(F.broadcast(parts), "cell") \
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts"))) \
        .groupBy("cell", "part").agg(F.first("counts").alias("counts"), F.collect_list("fp").alias("fps"))
    tiles = written(distinct.sparkSession, tiles, "simhash-tiles")
    base = 64 // LANES
    near = F.array(*[F.struct(
        _cell([F.col("counts")[k] + d for k, d in enumerate(s)]).alias("cell"),
        F.lit(any(s)).alias("other"),
        _inside(s, base).alias("ok")) for s in _steps(radius)])
    left = tiles.select(F.col("part").alias("part_a"), F.col("fps").alias("a"), F.explode(near).alias("to")) \
        .where("to.ok").select("part_a", "a", "to.cell", "to.other")
    paired = left.join(tiles.select("cell", F.col("part").alias("part_b"), F.col("fps").alias("b")), "cell") \
        .where(F.col("other") | (F.col("part_a") <= F.col("part_b"))).select("a", "b")

    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            out_a, out_b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for i in range(batch.num_rows):
                x, y = (c[i].values.to_numpy().view(np.uint64) for c in (a, b))
                u, v = _forest(x, y, radius)
                out_a.append(u), out_b.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (out_a, out_b)],
                                             names=["a", "b"])

    return paired.mapInArrow(run, "a long, b long")


def _inside(step: tuple[int, ...], base: int) -> Column:
    ok = F.lit(True)
    for k, d in enumerate(step):
        if d:
            ok = ok & (F.col("counts")[k] + d).between(0, base)
    return ok


def _labels(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(fp, label) of every fingerprint in a link; label: the smallest
    (doc, fp) reachable. ``nodes``: (fp, doc)."""
    spark = edges.sparkSession
    both = written(spark, edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   "simhash-links")
    own = F.struct(F.col("doc").alias("doc"), F.col("fp").alias("fp"))
    labels = written(spark, nodes.join(both.select(F.col("a").alias("fp")).distinct(), "fp")
                     .select("fp", own.alias("label")), "simhash-labels")
    while True:
        told = both.join(labels.select(F.col("fp").alias("a"), "label"), "a") \
            .groupBy(F.col("b").alias("fp")).agg(F.min("label").alias("near"))
        better = labels.join(told, "fp", "left") \
            .select("fp", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("fp").alias("via"), F.col("label").alias("far"))
        new = better.join(jump, F.col("new.fp") == F.col("via"), "left") \
            .select("fp", F.least("new", "far").alias("label"), (F.least("new", "far") != F.col("label")).alias("moved"))
        new = written(spark, new, "simhash-labels")
        if not new.agg(F.max("moved")).first()[0]:
            return labels
        labels = new.select("fp", "label")


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, doc, root): the component of each distinct fingerprint is the row
    (doc, root) with the smallest doc. ``prints``: (doc long, fp long)."""
    spark = prints.sparkSession
    last = F.lit(2**63 - 1)
    nodes = written(spark, prints.groupBy("fp").agg(F.min(F.coalesce("doc", last)).alias("doc")), "simhash-nodes")
    edges = written(spark, links(nodes.select("fp"), radius), "simhash-forest")
    out = nodes.join(_labels(edges, nodes), "fp", "left") \
        .select("fp", F.coalesce("label", F.struct("doc", "fp")).alias("label"))
    return out.select("fp", F.when(F.col("label.doc") != last, F.col("label.doc")).alias("doc"),
                      F.col("label.fp").alias("root"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """One row per document: key, fp, component (smallest key reachable)."""
    prints = written(df.sparkSession, df.select(
        F.col(key).cast("long").alias("doc"), fingerprints(F.col(text), shingle).alias("fp")), "simhash-prints")
    comp = components(prints, radius).select("fp", F.col("doc").alias("component"))
    return prints.join(comp, "fp").select(F.col("doc").alias(key), "fp", "component")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """The rows and columns of ``df``, one row of each component: the one with
    the component's smallest key (any of several equal rows)."""
    fp = fresh(df, "simhash_fp")
    docs = written(df.sparkSession, df.withColumn(fp, fingerprints(F.col(text), shingle)), "simhash-docs")
    prints = docs.select(F.col(key).cast("long").alias("doc"), F.col(fp).alias("fp"))
    stay = components(prints, radius).where(F.col("fp") == F.col("root"))  # the label's own fingerprint
    a, b = fresh(docs, "stay_doc"), fresh(docs, "stay_null")
    # null-safe: the key and whether it is null
    stay = stay.select(F.coalesce("doc", F.lit(0)).alias(a), F.col("doc").isNull().alias(b), F.col("fp").alias(fp))
    kept = docs.withColumn(a, F.coalesce(F.col(key).cast("long"), F.lit(0))).withColumn(b, F.col(key).isNull()) \
        .join(stay, [a, b, fp], "left_semi")
    if prints.groupBy("doc", "fp").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates([a, b, fp])
    return kept.select(*df.columns)
