"""Aggregations and pivots (AG-01..AG-20).

Pivots take an explicit value list and are written as conditional
aggregates: one ``Aggregate`` with partial (map-side) combine and a single
shuffle on the group keys, no extra job to discover the values, and an
output schema that does not depend on the data (S-03).
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremart.functions.arith import sum_fields_nullsafe


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sum_if(cond: Column, value) -> Column:
    """AG-01: conditional sum (null when no row matches)."""
    return F.sum(F.when(cond, _c(value)))


def count_if(cond: Column) -> Column:
    """AG-01: number of rows where ``cond`` holds (S-04: not all rows)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def date_bound(df: DataFrame, date_col: str, alias: str, operation: str,
               group: Sequence[str]) -> DataFrame:
    """AG-02: min or max of a date per group; other names are an error."""
    ops = {"min": F.min, "max": F.max}
    if operation not in ops:
        raise ValueError(f"operation must be 'min' or 'max', got {operation!r}")
    return df.groupBy(*group).agg(ops[operation](F.col(date_col)).alias(alias))


def _name(v) -> str:
    return str(v).strip().lower().replace(" ", "_").replace("-", "_")


def pivot_measures(df: DataFrame, keys: Sequence[str], pivot_col: str | Column,
                   values: Iterable, measures: Mapping[str, tuple[str, object]],
                   fill_zero: bool = True, name_fmt: str = "{value}_{measure}") -> DataFrame:
    """AG-03..AG-06, AG-18: pivot ``measures`` by the listed ``values``.

    ``measures`` maps a suffix to ``(agg, column)`` with agg in
    ``sum | count | max | min | avg``. Listed values with no rows give 0 when
    ``fill_zero`` (nulls -> 0), else null.
    """
    return df.groupBy(*keys).agg(*pivot_aggs(pivot_col, values, measures, fill_zero, name_fmt))


def pivot_aggs(pivot_col, values: Iterable, measures: Mapping[str, tuple[str, object]],
               fill_zero: bool = True, name_fmt: str = "{value}_{measure}") -> list[Column]:
    """The aggregate expressions of ``pivot_measures`` for use inside a larger
    ``agg`` (so totals and pivots share one pass)."""
    pc = _c(pivot_col)
    out = []
    for v in values:
        hit = F.coalesce(pc == F.lit(v), F.lit(False))
        for mname, (agg, col) in measures.items():
            name = name_fmt.format(value=_name(v), measure=mname)
            if agg == "count":
                e = F.count_if(hit)
            else:
                fn = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}[agg]
                e = fn(F.when(hit, _c(col)))
                if fill_zero and agg == "sum":
                    e = F.coalesce(e, F.lit(0))
            out.append(e.alias(name))
    return out


def horizontal_total(df: DataFrame, name: str, columns: Iterable[str]) -> DataFrame:
    """AG-04 / AG-07 / AG-10: row total over pivoted columns (null -> 0)."""
    cols = list(columns)
    return df.withColumn(name, sum_fields_nullsafe(cols) if cols else F.lit(0))


def any_flag(cond: Column) -> Column:
    """AG-09: 1 when any row of the group satisfies ``cond``."""
    return F.max(F.when(cond, 1).otherwise(0)).cast("int")


def half_count_pairs(df: DataFrame, keys: Sequence[str], entity_col: str, amount_col: str,
                     is_pair: Column) -> DataFrame:
    """AG-11 / AG-12 / AG-13: rows that are reported once per currency (pairs)
    count as ceil(n/2) per (entity, amount); the limit is amount x that count;
    other rows count plainly. Two grouped steps, both with partial combine.
    """
    first = (df.withColumn("__pair", F.coalesce(is_pair, F.lit(False)))
               .groupBy(*keys, entity_col, amount_col, "__pair")
               .agg(F.count(F.lit(1)).alias("__n")))
    cnt = F.when(F.col("__pair"), F.ceil(F.col("__n") / 2)).otherwise(F.col("__n"))
    return (first.withColumn("__cnt", cnt.cast("long"))
                 .groupBy(*keys)
                 .agg(F.sum("__cnt").alias("debt_cnt"),
                      F.sum(F.col(amount_col) * F.col("__cnt")).alias("limit_amount")))


def first_by_condition(cond: Column, value, order) -> Column:
    """AG-17: deterministic "first non-null value where cond" (S-06): the
    value of the matching row with the greatest ``order``."""
    return F.max_by(F.when(cond, _c(value)), F.when(cond, _c(order)))


def bucket(value, width: int, max_bucket: int, overflow_label: str | None = None) -> Column:
    """AG-19: ``value * width`` day buckets; above ``max_bucket`` one overflow bucket."""
    v = _c(value)
    b = (v * width).cast("int")
    over = F.lit(overflow_label) if overflow_label else F.lit((max_bucket + 1) * width)
    return F.when(v > max_bucket, over).otherwise(b.cast("string") if overflow_label else b)


def count_per_date(df: DataFrame, date_col: str, tag_col: str, start=None, end=None) -> DataFrame:
    """AG-20: rows per (date, table) in an inclusive range."""
    d = F.to_date(F.col(date_col))
    if start is not None and end is not None:
        df = df.where(d.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return df.groupBy(d.alias(date_col), F.col(tag_col)).agg(F.count(F.lit(1)).alias("cnt"))


def worst_grade_pivot(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Iterable,
                      grade_col: str, name_fmt: str = "{value}_worst_grade") -> DataFrame:
    """AG-15: worst (max) grade per key, pivoted by a category."""
    return df.groupBy(*keys).agg(*[
        F.max(F.when(F.col(pivot_col) == F.lit(v), F.col(grade_col)))
         .alias(name_fmt.format(value=_name(v))) for v in values])
