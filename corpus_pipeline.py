"""Corpus pipeline: the stages that turn ``documents`` into packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every result to the shared folder and rereads it as the next stage's input. All
stages but the last return the columns of ``docs``:

1. toxicity      rows whose expected severity passes the calibrated threshold go
2. simhash       one row of each near-duplicate component stays
3. substring     words of passages that repeat elsewhere go; a text that loses
                 none is unchanged, rows stay even when all words went
4. pii           personal data is replaced by its kind's name in brackets
5. packing       the pieces of the token sequences: token ids, sequence and offset

Stages change ``text`` only (n_chars keeps describing the source text). SQL
cannot express the fitted stages, so there is no oracle; the tests hold ``run``
against the stages' operators and brute-force forms.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from featuremart.llm import packing, pii, simhash, substring_dedup, toxicity
from featuremart.llm.common import table
from featuremart.llm.queries import read_file
from featuremart.session import remove_folder, scratch_dir, scratch_root


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_texts(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, read_file(public_tokenizers.path("word_bpe_49k.json")), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("substring", drop_repeated_passages),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and reread.
    A stage's intermediate tables, and the result it started from, go when its
    own result is written; the last result stays."""
    docs, before, base = table(spark, sf_dir, "documents"), None, scratch_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        with scratch_root(spark, f"pipeline-{name}"):
            out = stage(spark, docs, sf_dir)
            out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
