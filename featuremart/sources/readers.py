"""Scans: load datasets, date-range filters, tagged unions, table listings.

SRC-01..SRC-10. All readers return lazy DataFrames; date filters are plain
``between`` predicates on the stored column so Parquet statistics and
partition pruning apply.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class EmptyDatasetError(ValueError):
    """A dataset that must hold rows is empty."""


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_dataset(spark: SparkSession, path: str, fmt: str = "parquet",
                 require_rows: bool = True) -> DataFrame:
    """SRC-01: read one dataset in a named format; empty is an error.

    The emptiness test reads at most one row (``isEmpty``), not the table.
    """
    df = spark.read.format(fmt).load(path)
    if require_rows and df.isEmpty():
        raise EmptyDatasetError(f"dataset at {path} has no rows")
    return df


def date_range_filter(df: DataFrame, partition_col: str, start=None, end=None,
                      out_col: str | None = None, is_catalog: bool = False) -> DataFrame:
    """SRC-02: inclusive range on the stored date column, then expose it
    as a ``date`` under ``out_col`` at the end of the row.

    The predicate is applied to the raw column first so it reaches the scan
    (``PushedFilters``) and prunes partitions; the cast comes afterwards.
    Catalog tables are returned unchanged.
    """
    if is_catalog:
        return df
    c = F.col(partition_col)
    if start is not None:
        df = df.where(c >= F.lit(start).cast(df.schema[partition_col].dataType))
    if end is not None:
        # inclusive on whole days for timestamp columns
        if df.schema[partition_col].simpleString().startswith("timestamp"):
            df = df.where(c < F.date_add(F.lit(end).cast("date"), 1).cast(
                df.schema[partition_col].dataType))
        else:
            df = df.where(c <= F.lit(end).cast(df.schema[partition_col].dataType))
    out_col = out_col or partition_col
    others = [x for x in df.columns if x not in (partition_col, out_col)]
    return df.select(*others, F.to_date(c).alias(out_col))


def find_column(df: DataFrame, name: str) -> str | None:
    """Case-insensitive column lookup (SRC-05)."""
    low = name.lower()
    return next((c for c in df.columns if c.lower() == low), None)


def filter_by_date_column(df: DataFrame, date_col: str, start=None, end=None) -> DataFrame:
    """SRC-05: inclusive range on a column found case-insensitively; a
    table without the column is returned whole."""
    actual = find_column(df, date_col)
    if actual is None:
        return df
    d = F.to_date(F.col(actual))
    if start is not None:
        df = df.where(d >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.where(d <= F.to_date(F.lit(end)))
    return df


def load_optional(spark: SparkSession, path: str | None = None, table: str | None = None,
                  date_col: str | None = None, start=None, end=None,
                  fmt: str = "parquet") -> DataFrame | None:
    """SRC-04: load by path or table name with an optional date filter;
    ``None`` when absent or empty."""
    try:
        df = spark.read.format(fmt).load(path) if path else spark.table(table)
    except AnalysisException:
        return None
    if date_col:
        df = filter_by_date_column(df, date_col, start, end)
    return None if df.isEmpty() else df


def load_many(spark: SparkSession, catalog: dict[str, dict], fallback_root: str | None = None
              ) -> dict[str, DataFrame]:
    """SRC-03: load every input of a node into ``name -> DataFrame``.

    ``catalog`` maps a name to ``{"path", "format", "date_col", "start", "end"}``
    and optionally ``"fallback"``, the shared path to read when the user path
    is missing; without it the fallback is ``fallback_root/<name>``.
    """
    out = {}
    for name, spec in catalog.items():
        fmt = spec.get("format", "parquet")
        try:
            df = spark.read.format(fmt).load(spec["path"])
        except AnalysisException:
            fallback = spec.get("fallback") or (fallback_root and f"{fallback_root.rstrip('/')}/{name}")
            if not fallback:
                raise
            df = spark.read.format(fmt).load(fallback)
        if spec.get("date_col"):
            df = date_range_filter(df, spec["date_col"], spec.get("start"), spec.get("end"),
                                   spec.get("out_col"))
        out[name] = df
    return out


def rows_per_date(df: DataFrame, date_col: str | None, table_name: str,
                  out_date: str = "info_date") -> DataFrame:
    """SRC-06: rows per date of one dataset (total for a catalog)."""
    if date_col is None:
        return df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(table_name).alias("table_name"), F.lit(None).cast("date").alias(out_date),
            "records")
    return (df.groupBy(F.to_date(F.col(date_col)).alias(out_date))
              .agg(F.count(F.lit(1)).alias("records"))
              .select(F.lit(table_name).alias("table_name"), out_date, "records"))


def rows_per_date_at(spark: SparkSession, path: str, date_col: str | None, table_name: str,
                     fmt: str = "parquet", out_date: str = "info_date") -> DataFrame:
    """SRC-06 for a path: rows per date, or one zero row (null date) when the
    path cannot be read, so a missing source shows up in the counts."""
    try:
        df = spark.read.format(fmt).load(path)
    except AnalysisException:
        return spark.createDataFrame([(table_name, None, 0)],
                                     f"table_name string, {out_date} date, records bigint")
    return rows_per_date(df, date_col, table_name, out_date)


def union_tagged(frames: dict[str, DataFrame], project: Iterable[Column | str],
                 tag_col: str = "table_name") -> DataFrame:
    """SRC-07: the same projection over several tables, each row tagged with
    its table name, all unioned by name (one plan, no driver loop of jobs)."""
    project = list(project)
    parts = [df.select(*project).withColumn(tag_col, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def list_tables(spark: SparkSession, database: str | None = None,
                exclude_prefixes: Iterable[str] = ()) -> list[str]:
    """SRC-08 / SRC-10: table names of a schema, minus excluded prefixes.
    (Catalog metadata only: a bounded list of names, not data.)"""
    excl = tuple(exclude_prefixes)
    names = [t.name for t in spark.catalog.listTables(database)]
    return [n for n in names if not (excl and n.startswith(excl))]


def classify_tables(spark: SparkSession, frames: dict[str, DataFrame],
                    date_kinds: dict[str, str]) -> DataFrame:
    """SRC-09: which table holds which known date column, and its kind
    (``snapshot`` / ``transactional`` / ``catalog``). Uses schemas only."""
    rows = []
    for name, df in frames.items():
        cols = {c.lower(): c for c in df.columns}
        hit = next(((cols[k.lower()], kind) for k, kind in date_kinds.items()
                    if k.lower() in cols), None)
        rows.append((name, hit[0] if hit else None, hit[1] if hit else "catalog"))
    return spark.createDataFrame(rows, "table_name string, date_column string, table_kind string")


def partition_counts(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """SRC-06 / QA-03 / QA-16 / QA-17 for a table partitioned by its date: rows
    per partition from folder names and file footers alone.

    The table is opened as a version-2 source, whose Parquet reader takes the
    grouped count as a pushed aggregate: no column is read. Only this read uses
    it; the session's choice of readers is put back."""
    conf, name = spark.conf, "spark.sql.sources.useV1SourceList"
    before = conf.get(name)
    conf.set("spark.sql.parquet.aggregatePushdown", "true")  # concerns version-2 reads only
    try:
        conf.set(name, ",".join(s for s in before.split(",") if s.strip().lower() != "parquet"))
        df = spark.read.parquet(path)
    finally:
        conf.set(name, before)
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("records"))
