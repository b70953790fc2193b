"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.session import scratch_dir

# Words are maximal runs outside the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not hold yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def whole_text(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def written(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` once below the shared checkpoint folder
    and read it back, so later jobs (and retried tasks) see the same rows."""
    path = scratch_dir(spark, f"{tag}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def freeing_shuffles(spark: SparkSession):
    """Shuffle files of the queries run inside go when each query ends, not
    when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes (``bytes.split`` splits at exactly the
    six white-space characters of WORD)."""
    return text.encode().split() if text else []


# A-Z only; every other letter stays as it is.
ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
