"""Completeness, profiling and volume control (QA-01..QA-17).

Date grids are generated per table row with ``explode(sequence(...))`` (no
cross join). Counting, profiling and reconciling are set-based: one grouped
job per input instead of a driver loop with a ``collect`` per table.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from featuremart.operators.windows import VOLUME_K, volume_controls

# Table kinds of the completeness checks.
SNAPSHOT, TRANSACTIONAL, CATALOG = "snapshot", "transactional", "catalog"


class MissingDates(RuntimeError):
    """Raised when tables still miss dates at the end of a completeness run."""


def expected_dates(tables: DataFrame, start_col: str = "start_date", end_col: str = "end_date",
                   kind_col: str = "table_kind") -> DataFrame:
    """QA-01 / QA-02: the dates each table must hold inside the run's window
    (given, never taken from the data): every day for transactional tables,
    month ends for snapshots, the window's end for full-load catalogs."""
    first, last = F.to_date(F.col(start_col)), F.to_date(F.col(end_col))
    days = F.sequence(first, last, F.expr("INTERVAL 1 DAY"))
    dates = F.when(F.col(kind_col) == CATALOG, F.array(last)) \
        .when(F.col(kind_col) == SNAPSHOT, F.filter(days, lambda d: d == F.last_day(d))).otherwise(days)
    return tables.withColumn("info_date", F.explode(dates)).drop(start_col, end_col)


def completeness(grid: DataFrame, counts: DataFrame, keys: Sequence[str] = ("table_name", "info_date")
                 ) -> DataFrame:
    """QA-03 / QA-16 / QA-17: rows per table and expected date, 0 where missing."""
    return grid.join(counts, list(keys), "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)).cast("long"))


def missing_months(comp: DataFrame, tolerances: dict[str, int] | None = None) -> DataFrame:
    """QA-04: (table, month) pairs with more missing dates than allowed. A
    transactional table is allowed the smallest tolerance among the keys its
    name holds, every other table none (S-22)."""
    gaps = comp.groupBy("table_name", "table_kind", "date_column", F.last_day("info_date").alias("month_end")) \
        .agg(F.count_if(F.col("cnt") == 0).alias("missing_days"))
    limits = [F.when(F.col("table_name").contains(key), F.lit(days)) for key, days in (tolerances or {}).items()]
    allowed = F.when(F.col("table_kind") == TRANSACTIONAL, F.least(*limits, F.lit(None).cast("int"),
                                                                   F.lit(None).cast("int")))
    return gaps.where(F.col("missing_days") > F.coalesce(allowed, F.lit(0))).select(
        "table_name", "table_kind", "date_column",
        F.date_format("month_end", "yyyy-MM").alias("month_without_data"), "missing_days")


def require_complete(gaps: DataFrame) -> None:
    """QA-04: stop the run when gaps remain; the error names up to 20 of them."""
    left = gaps.select("table_name", "month_without_data").limit(20).collect()
    if left:
        raise MissingDates("missing dates in " + ", ".join(f"{r[0]} {r[1]}" for r in left))


def closed_month(as_of) -> Column:
    """Month end of the last month closed before the run date ``as_of``."""
    return F.last_day(F.add_months(F.to_date(F.lit(as_of)), -1))


def monthly_spine(df: DataFrame, date_col: str, as_of, start=None) -> DataFrame:
    """QA-06: month ends from the first month of the data (or ``start``) to the
    last month closed before ``as_of``, whatever the data's own last month."""
    first = F.to_date(F.lit(start)) if start is not None else F.min(F.to_date(F.col(date_col)))
    bounds = df.agg(F.trunc(first, "month").alias("first")).withColumn("last", closed_month(as_of))
    months = F.when(F.col("first") <= F.col("last"), F.sequence("first", "last", F.expr("INTERVAL 1 MONTH")))
    return bounds.select(F.explode(months).alias("month")).select(F.last_day("month").alias("info_date"))


def fill_months(monthly: DataFrame, as_of, series: Sequence[str], zeros: Sequence[str]) -> DataFrame:
    """One row per ``series`` and month end from its first month to the last
    closed one, the ``zeros`` columns 0 in months without a row. ``monthly``
    has at most one row per series and month (column info_date).

    Each row fills the months up to the next row, so the table behind
    ``monthly`` is read once: no second pass for its date bounds.
    """
    end = closed_month(as_of)
    following = F.lead("info_date").over(Window.partitionBy(*series).orderBy("info_date"))
    until = F.coalesce(F.last_day(F.add_months(following, -1)), end)
    rows = monthly.withColumn("__until", until).where(F.col("info_date") <= end)
    months = F.sequence(F.trunc("info_date", "month"), F.col("__until"), F.expr("INTERVAL 1 MONTH"))
    rows = rows.withColumn("__month", F.explode(months)).withColumn("__month", F.last_day("__month"))
    own = F.col("__month") == F.col("info_date")
    return rows.select(*[F.when(own, F.col(c)).otherwise(F.lit(0).cast(monthly.schema[c].dataType)).alias(c)
                         if c in zeros else (F.col("__month").alias(c) if c == "info_date" else F.col(c))
                         for c in monthly.columns])


def profile_counts(df: DataFrame) -> dict[str, Column]:
    """Aggregates of a column profile: rows, and per column nulls and, for
    numbers, zeros."""
    counts = {"total_rows": F.count(F.lit(1))}
    for f in df.schema.fields:
        counts[f"empty_{f.name}"] = F.count_if(F.col(f.name).isNull())
        if isinstance(f.dataType, NumericType):
            counts[f"zero_{f.name}"] = F.count_if(F.col(f.name) == 0)
    return counts


def profile_rows(monthly: DataFrame, schema: StructType, table_name: str, as_of) -> DataFrame:
    """A profile's row per month and column from the counts per month
    (``profile_counts`` and unique_customers by info_date)."""
    entries: list[Column] = []
    for f in schema.fields:
        zeros = F.col(f"zero_{f.name}") if isinstance(f.dataType, NumericType) else F.lit(None).cast("long")
        entries += [F.lit(f.name), F.lit(f.dataType.simpleString()), F.col(f"empty_{f.name}"), zeros]
    monthly = monthly.withColumn("table_name", F.lit(table_name))
    counts = [c for c in monthly.columns if c not in ("table_name", "info_date")]
    long = fill_months(monthly, as_of, ["table_name"], counts).select(
        "table_name", "info_date", "total_rows", "unique_customers",
        F.stack(F.lit(len(schema.fields)), *entries).alias("column_name", "data_type", "nulls", "zeros"))

    def share(part: str) -> Column:
        of_rows = F.round(F.col(part).cast("decimal(20,0)") / F.greatest("total_rows", F.lit(1)), 4)
        return of_rows.cast("decimal(10,4)")

    return long.select("table_name", "column_name", "data_type", "total_rows", "unique_customers", "nulls",
                       share("nulls").alias("null_ratio"), "zeros", share("zeros").alias("zero_ratio"), "info_date")


def column_profile(df: DataFrame, table_name: str, date_col: str, as_of,
                   customer_cols: Iterable[str] = ()) -> DataFrame:
    """QA-07: per column and month up to the last closed one: rows, distinct
    customers, nulls, zeros (numeric columns only), their shares to 4 digits
    and the type name. One grouped aggregate reads the table; ``stack`` turns
    its row per month into a row per column. (``monthly_state.profile`` gives the
    same from counts kept between runs.)"""
    customer = next((c for c in customer_cols if c in df.columns), None)
    unique = (F.count_distinct(customer) if customer else F.lit(0)).cast("long")
    monthly = df.groupBy(F.last_day(F.to_date(F.col(date_col))).alias("info_date")).agg(
        *[v.alias(k) for k, v in profile_counts(df).items()], unique.alias("unique_customers"))
    return profile_rows(monthly, df.schema, table_name, as_of)


def volume_series(df: DataFrame, table_name: str, date_col: str, as_of,
                  customer_col: str | None) -> DataFrame:
    """QA-09 input: rows and distinct customers per month, 0 in months without
    rows up to the last closed month (a table that stopped loading shows it)."""
    customers = F.count_distinct(F.col(customer_col)) if customer_col else F.lit(0)
    monthly = df.groupBy(F.last_day(F.to_date(F.col(date_col))).alias("info_date")).agg(
        F.count(F.lit(1)).alias("records"), customers.cast("long").alias("customers"))
    monthly = monthly.select(F.lit(table_name).alias("table_name"), "records", "customers", "info_date")
    return fill_months(monthly, as_of, ["table_name"], ["records", "customers"])


def volume_report(series: DataFrame, k: float = VOLUME_K) -> DataFrame:
    """QA-09 / QA-10: WN-11 on the monthly series of every table."""
    return volume_controls(series, "table_name", "info_date", ["records", "customers"], k)


# Grace days before a date counts as overdue, days of one attempt.
GRACE_DAYS, ATTEMPT_DAYS = 2, 7


def reconcile_counts(tables: DataFrame, lake_counts: DataFrame, source_counts: DataFrame, as_of) -> DataFrame:
    """QA-13: what a table's load still owes, all tables in one plan.

    ``tables``: (table_name, table_kind, start_date, end_date), the run's
    window. A dated table owes every expected date the lake has no row for
    (snapshots: month ends up to the last closed month); a snapshot also owes
    the dates whose row count differs from the source's. A catalog owes its
    whole load when the lake has no rows. ``weeks_overdue`` counts whole weeks
    since the date, after the grace days: with none the date is loaded again
    (``re-ingest``), from one on it is reported as ``missing_at_source``.
    """
    dated = expected_dates(tables).where(
        (F.col("table_kind") != SNAPSHOT) | (F.col("info_date") <= closed_month(as_of)))
    key = ["table_name", "info_date"]
    both = dated.join(lake_counts.withColumnRenamed("records", "lake_records"), key, "left") \
        .join(source_counts.withColumnRenamed("records", "source_records"), key, "left")
    absent = F.coalesce("lake_records", F.lit(0)) == 0
    differs = (F.col("table_kind") == SNAPSHOT) & (F.col("lake_records") != F.col("source_records"))
    late = F.datediff(F.date_sub(F.to_date(F.lit(as_of)), GRACE_DAYS), F.col("info_date")) / ATTEMPT_DAYS
    weeks = F.when(F.col("table_kind") == CATALOG, F.lit(0)).otherwise(late.cast("int"))
    return both.where(absent | F.coalesce(differs, F.lit(False))).withColumn("weeks_overdue", weeks).select(
        *key, "table_kind", F.coalesce("lake_records", F.lit(0)).cast("long").alias("lake_records"),
        F.col("source_records").cast("long").alias("source_records"), "weeks_overdue",
        F.when(F.col("weeks_overdue") < 1, F.lit("re-ingest")).otherwise(F.lit("missing_at_source")).alias("issue"))


def listed_tables(listing: DataFrame, json_col: str) -> DataFrame:
    """QA-13 (metadata part): a column holding a JSON array of
    ``{"info": {table fields}}`` objects becomes one row per listed table."""
    entry = "array<struct<info: struct<table: string, date_column: string, kind: string>>>"
    return listing.select("*", F.explode(F.from_json(json_col, entry)).alias("__t")) \
        .select(*[c for c in listing.columns if c != json_col], "__t.info.*")


def tables_with_column(table_columns: DataFrame, column_name: str) -> list[str]:
    """QA-05: distinct names of the tables holding a column. The input is
    schema metadata (one row per table and column), so the list read back is
    bounded by the number of tables."""
    rows = (table_columns.where(F.col("column_name") == column_name)
            .select("table_name").distinct().orderBy("table_name").collect())
    return [r.table_name for r in rows]
