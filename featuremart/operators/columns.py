"""Schema-driven projections (PRJ-01..PRJ-12).

Each operator is one ``select`` built from the schema, so it adds no stage
and Catalyst still prunes what later steps do not read.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType, StringType)

from featuremart.functions.dates import month_end, month_start, period_int
from featuremart.functions.text import UNKNOWN_LABEL, label_missing

FRACTIONAL = (FloatType, DoubleType, DecimalType)
NUMERIC = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)

# Key and period columns that keep their names when a domain prefix is added.
DEFAULT_KEYS = ["customer_key", "account_key", "_observ_start_dt", "_observ_end_dt"]


def key_columns_first(df: DataFrame, start_cols: Iterable[str]) -> DataFrame:
    """PRJ-01: listed columns that exist come first, the rest keep order."""
    first = [c for c in start_cols if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def add_prefix(df: DataFrame, prefix: str, exclude: Iterable[str] = DEFAULT_KEYS) -> DataFrame:
    """PRJ-02: ``prefix_`` on every column but the keys."""
    ex = set(exclude)
    return df.select(*[F.col(c) if c in ex else F.col(c).alias(f"{prefix}_{c}")
                       for c in df.columns])


def to_val_columns(df: DataFrame) -> DataFrame:
    """PRJ-03: every float/double/decimal column -> round 2, ``decimal(19,2)``,
    name + ``_val``."""
    return df.select(*[
        F.round(F.col(f.name), 2).cast(DecimalType(19, 2)).alias(f"{f.name}_val")
        if isinstance(f.dataType, FRACTIONAL) else F.col(f.name)
        for f in df.schema.fields])


def with_period(df: DataFrame, date_col: str, name: str = "_particion") -> DataFrame:
    """PRJ-04: ``yyyyMM`` int of a date column."""
    return df.withColumn(name, period_int(date_col))


def add_suffix(df: DataFrame, suffix: str, exclude: Iterable[str] = ()) -> DataFrame:
    """PRJ-05: ``_suffix`` on every column but the excluded."""
    ex = set(exclude)
    return df.select(*[F.col(c) if c in ex else F.col(c).alias(f"{c}_{suffix}")
                       for c in df.columns])


def remove_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """PRJ-06: strip ``prefix`` where present."""
    return df.select(*[F.col(c).alias(c[len(prefix):]) if c.startswith(prefix) else F.col(c)
                       for c in df.columns])


def remove_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """PRJ-07: strip ``suffix`` where present."""
    return df.select(*[F.col(c).alias(c[: -len(suffix)]) if c.endswith(suffix) else F.col(c)
                       for c in df.columns])


def int_columns_with_cnt(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """AG-14: every integer column gets the ``_cnt`` suffix (keys excluded)."""
    ex = set(exclude)
    ints = (ByteType, ShortType, IntegerType, LongType)
    return df.select(*[
        F.col(f.name).alias(f"{f.name}_cnt")
        if isinstance(f.dataType, ints) and f.name not in ex and not f.name.endswith("_cnt")
        else F.col(f.name) for f in df.schema.fields])


def columns_with_suffix(df: DataFrame, suffix: str) -> list[str]:
    """PRJ-08: names ending in ``suffix``."""
    return [c for c in df.columns if c.endswith(suffix)]


def drop_zero_measures(df: DataFrame, measures: Iterable[str], totals: DataFrame | None = None,
                       materialize: bool = True) -> DataFrame:
    """PRJ-09: drop measure columns whose total is 0 or null.

    One global aggregate (a single row reaches the driver) decides which
    names to drop; the data itself never leaves the executors. A caller that
    can get the totals cheaper than from ``df`` (a pruned scan of its source)
    passes them as the one-row frame ``totals``. Otherwise, with
    ``materialize``, ``df`` is first written once with ``checkpoint()`` to the
    shared checkpoint folder, so the totals and the caller's own action read
    it instead of running the upstream plan twice.
    """
    measures = list(measures)
    if not measures:
        return df
    if totals is None:
        if materialize:
            from featuremart.session import ensure_checkpoint_dir
            ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint(eager=True)
        totals = df.agg(*[F.sum(F.col(m)).alias(m) for m in measures])
    row = totals.first()
    dead = [m for m in measures if row[m] is None or row[m] == 0]
    return df.drop(*dead)


def label_missing_text(df: DataFrame, label: str = UNKNOWN_LABEL,
                       exclude: Iterable[str] = ()) -> DataFrame:
    """PRJ-10: every string column trimmed and squeezed; null or empty ->
    ``label``. Keys listed in ``exclude`` are left alone (S-11)."""
    ex = set(exclude)
    return df.select(*[
        label_missing(f.name, label).alias(f.name)
        if isinstance(f.dataType, StringType) and f.name not in ex else F.col(f.name)
        for f in df.schema.fields])


def fill_numeric_zero(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """PRJ-11: numeric nulls -> 0, decimals included (S-07)."""
    sub = set(subset) if subset is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, NUMERIC) and (sub is None or f.name in sub):
            out.append(F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def with_observation_dates(df: DataFrame, date_col: str | None = None, start=None,
                           end=None) -> DataFrame:
    """PRJ-12 / observation period: ``_observ_start_dt`` and ``_observ_end_dt``
    from a date column, or stamped from given dates."""
    if date_col is not None:
        return df.withColumns({"_observ_start_dt": month_start(date_col),
                               "_observ_end_dt": month_end(date_col)})
    return df.withColumns({"_observ_start_dt": F.to_date(F.lit(start)),
                           "_observ_end_dt": F.to_date(F.lit(end))})


def project(df: DataFrame, spec: Mapping[str, str | Column]) -> DataFrame:
    """Select-only nodes: ``{out_name: column name or expression}``."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in spec.items()])
