"""Rendezvous shards against a direct Python evaluation."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

from featuremart.llm import queries, sharding
from tests.conftest import SF_SMALL


def brute(key, weights):
    def score(s):
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", s), seed=seed)
        return -math.log(((h >> 11) + 0.5) / 2**53) / weights[s]
    return min(range(len(weights)), key=score)


def check(rows, texts, weights, grown):
    slots = defaultdict(list)
    for r in rows:
        assert r["shard"] == brute(r["key"], weights)
        assert r["grown_shard"] == brute(r["key"], grown)
        assert r["grown_shard"] in (r["shard"], len(grown) - 1)
        slots[r["shard"]].append(r["slot"])
    for got in slots.values():
        assert sorted(got) == list(range(len(got)))
    want = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in texts)
    assert Counter((r["key"], r["size"], r["text_crc32"]) for r in rows) == want


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op3_rendezvous_shards(spark, SF_SMALL).collect()
    assert {r.law for r in got} == {"key"}
    rows = [r.asDict() | {"key": r.doc_id} for r in got]
    check(rows, [tuple(d) for d in docs], [1.0] * 16, [1.0] * 17)


def test_weights_nulls_repeats(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 8)
    texts = [(i, f"t{i}") for i in range(400)] + [(7, "same")] * 50 + [(None, None), (None, ""), (5, "x" * 100000)]
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in texts], "doc_id long, text string, shard int, size int")
    w = [1.0, 2.0, 5.0]
    got = [r.asDict() for r in sharding.shard_rows(df, "doc_id", w, [*w, 1.0]).collect()]
    check(got, texts, w, [*w, 1.0])
    share = Counter(r["shard"] for r in got)
    assert share[2] > share[1] > share[0]
    assert sharding.shard_rows(df.limit(0), "doc_id", w, [*w, 1.0]).count() == 0


def test_texts_of_one_key_spread_over_buckets(spark):
    rows = [(None, f"t{i}") for i in range(1000)] + [(i, "x") for i in range(1000)]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", [1.0]).collect()
    slots = [r.slot for r in got if r["key"] is None]
    assert sorted(r.slot for r in got) == list(range(2000))
    assert max(slots) - min(slots) > 1500  # numbered among the other keys, not in one bucket


def test_no_python_in_plan(spark):
    plan = queries.op3_rendezvous_shards(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_the_table_is_read_once(spark):
    """Slots and offsets come from the counted records, written once."""
    df = queries.op3_rendezvous_shards(spark, SF_SMALL)
    read = df.inputFiles()
    assert read and all("shard-records" in f for f in read), read
