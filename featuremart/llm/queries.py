"""Queries of the training-data operators: ``QUERIES`` (name -> function of
(spark, sf_dir)) and ``ORACLES`` (name -> DuckDB SQL, where SQL can say it)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.llm import (ann, byte_bpe, hard_negatives, lm_bloom, packing, pii, quality_forest, sharding, simhash,
                             spelling, substring_dedup, toxicity, warc)
from featuremart.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@query
def op1_toxicity(spark: SparkSession, sf_dir: str, max_labelled: int = 4000) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), max_labelled)
    return toxicity.score(docs, model).select(
        "doc_id", F.col("tox_severity").alias("severity"), F.col("tox_grade").alias("grade"),
        F.col("tox_rejected").alias("rejected"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    blob = read_file(ranks or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), blob,
                                     public_tokenizers.PATTERN, with_ids=False)


@query
def op3_rendezvous_shards(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"), "doc_id",
                               [1.0] * shards, [1.0] * (shards + 1))
    return rows.select(F.col("key").alias("doc_id"), "size", "text_crc32",
                       F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op4_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_forest.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "anomaly")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str, window: int = 35) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, window).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


@query
def op6_min_slack_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None,
                          capacity: int = 2048) -> DataFrame:
    blob = read_file(tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), blob, capacity=capacity)


@query
def op7_simhash(spark: SparkSession, sf_dir: str, shingle: int = 3, radius: int = 2) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=shingle, radius=radius)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


@query
def op9_lm_bloom(spark: SparkSession, sf_dir: str, order: int = 3, group_bytes: int = lm_bloom.GROUP_BYTES) -> DataFrame:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return lm_bloom.score(table(spark, sf_dir, "documents"), F.crc32(name) % 5 == 1, order=order,
                          group_bytes=group_bytes)


@query
def op8_adaptive_ann(spark: SparkSession, sf_dir: str, k: int = 20, max_sample: int = 16_384) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k, max_sample=max_sample)


@query
def op10_pii_boosting(spark: SparkSession, sf_dir: str, precision: float = 0.9) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"), precision=precision)

    def count(kind: str):
        code = pii.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == code)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str, min_length: int = 5, min_count: int = 3) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), alter=spelling.drop_letter("doc_id"),
                                   min_length=min_length, min_count=min_count)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str, positives: int = 5, negatives: int = 5) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label,
                               positives=positives, negatives=negatives)


ORACLES["op11_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank
  FROM scored WHERE same
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score, p.positive_rank
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
WHERE p.positive_rank <= 5
QUALIFY rank <= 5
"""


@query
def op12_warc_normaliser(spark: SparkSession, sf_dir: str, min_revisit: int = 0) -> DataFrame:
    row_id = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    read = warc.round_trip(table(spark, sf_dir, "pages"), row_id=row_id, min_revisit=min_revisit)
    return read.select(F.col("key").cast("long").alias("page_id"), F.col("bytes").alias("payload_bytes"),
                       F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                       F.col("refers_to").cast("long").alias("refers_to"))


ORACLES["op12_warc_normaliser"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT)
                                     >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM p
"""
