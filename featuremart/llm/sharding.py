"""Weighted rendezvous (highest-random-weight) sharding, in built-in functions.

Every (record key, shard) pair gets a hash in (0, 1); a record goes to the
shard with the smallest ``-ln(hash) / weight``. Shard ``s`` then receives a
share of the keys in proportion to its weight, the choice needs no state, and
adding a shard moves only the records that the new shard wins.

Slots number the rows inside a shard without gaps. Numbering a shard in one
task would put 1/16 of the table into it, so each shard is cut into
``BUCKETS`` hash buckets of (key, size, checksum): rows are numbered inside
(shard, bucket) and shifted by the counts of the buckets before, a table of at
most shards x BUCKETS rows.
Equal (key, size, checksum) rows are counted first (partial counts before the
shuffle), so a record that fills a third of the table is one row until the end,
and a key with many texts is spread over the buckets of its shard.

Defined results: a null key hashes as its own key value; null text has size 1
and checksum 0; repeated rows get a slot each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.session import staged

BUCKETS = 256
BLOCK = 65_536


def _score(key: Column, shard: int, weight: float) -> Column:
    # 53 random bits, moved off zero, as a double in (0, 1)
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    return -F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 .. len(weights) - 1) of a record key."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    ranked = [F.struct(_score(key, s, w).alias("score"), F.lit(s).alias("shard"))
              for s, w in enumerate(weights)]
    return ranked[0]["shard"] if len(ranked) == 1 else F.least(*ranked)["shard"]


def shard_rows(df: DataFrame, key: str, weights: Sequence[float],
               grown: Sequence[float] | None = None, text: str = "text") -> DataFrame:
    """One row per record: key, size, text_crc32, shard, slot and, when
    ``grown`` gives the weights after growth, grown_shard."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    k = F.col(key)
    size, crc = (F.octet_length(body) + F.lit(1)).cast("long"), F.crc32(body)
    rows = df.select(
        k.alias("key"), size.alias("size"), crc.alias("text_crc32"),
        rendezvous(k, weights).alias("shard"),
        (rendezvous(k, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.pmod(F.xxhash64(k, size, crc, F.lit(-1)), F.lit(BUCKETS)).alias("bucket"))
    # written once: slots and offsets below read it, the table is read and hashed once
    kinds = staged(df.sparkSession, rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "shard-records")
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "size", "text_crc32") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = kinds.withColumn("first", F.sum("n").over(inside) - F.col("n"))
    # at most len(weights) x BUCKETS rows
    before = Window.partitionBy("shard").orderBy("bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = kinds.groupBy("shard", "bucket").agg(F.sum("n").alias("n")) \
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = placed.join(F.broadcast(offsets), ["shard", "bucket"])
    # back to one row per record, in blocks so that no array grows with a hot key
    blocks = placed.withColumn("block", F.explode(F.expr(f"sequence(0L, n - 1, {BLOCK}L)")))
    copies = blocks.withColumn("copy", F.explode(F.expr(
        f"sequence(block, least(block + {BLOCK - 1}, n - 1))")))
    return copies.select("key", "size", "text_crc32", "shard",
                         (F.col("offset") + F.col("first") + F.col("copy")).alias("slot"),
                         "grown_shard")
