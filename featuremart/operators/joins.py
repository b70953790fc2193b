"""Join operators (JN-01..JN-08).

Dimension sides (rates, catalogs, bridges) go through ``join_small`` so they
are broadcast only behind a size check. The line-item-to-order join is
``fact_join``: a sort-merge join dealt out by row count. Other large joins are
left to the planner, with AQE's skew-join split for hot keys.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremart.operators.broadcast import join_small

# Fact rows that one task joins.
FACT_ROWS = 250_000


def fact_tasks(facts: DataFrame, rows: int | None = None) -> int:
    """Tasks that take at most about ``rows`` of the facts each, and no fewer
    than run at a time. The rows are counted (Parquet footers, unless filtered)."""
    return max(facts.sparkSession.sparkContext.defaultParallelism, -(-facts.count() // (rows or FACT_ROWS)))


def fact_join(facts: DataFrame, orders: DataFrame, facts_key: str = "l_orderkey", orders_key: str = "o_orderkey") -> DataFrame:
    """Inner join of facts to their orders; both sides grow with the data, so
    neither is broadcast.

    Both sides are dealt out by the key over ``fact_tasks``: AQE would merge
    them up to its advisory size in compressed bytes, some millions of rows, and
    a grouping in the same task (partial sums, hardly fewer than the rows) would
    hold a wide row for nearly each of them. The rows of a task, and with them
    its memory, stay the same however large the tables are.
    """
    n = fact_tasks(facts)
    return facts.repartition(n, facts_key).join(orders.repartition(n, orders_key).hint("shuffle_merge"),
                                                F.col(facts_key) == F.col(orders_key), "inner")


def join_all(frames: Sequence[DataFrame], on: Sequence[str], how: str = "left") -> DataFrame:
    """JN-01 / JN-02: fold frames left to right on the same keys with ``how``
    for every step (S-01). One frame -> itself; none -> error (S-02)."""
    if not frames:
        raise ValueError("join_all needs at least one DataFrame")
    return reduce(lambda a, b: a.join(b, list(on), how), frames)


def add_rate(df: DataFrame, rates: DataFrame, date_col: str, rate_date_col: str = "rate_date",
             rate_col: str = "rate", snapshot: bool = False) -> DataFrame:
    """JN-03: rate of the transaction day, or of the month end for snapshot
    tables; left join, a missing rate gives null (S-08).

    The rates are first brought to one per day (the highest), so a repeated
    day cannot multiply facts, and the broadcast has a bound that does not grow
    with the facts: at most 366 rows a year.
    """
    key = F.last_day(F.col(date_col)) if snapshot else F.to_date(F.col(date_col))
    daily = rates.groupBy(F.col(rate_date_col).alias("__rate_dt")).agg(F.max(rate_col).alias(rate_col))
    out = df.withColumn("__rate_key", key).join(F.broadcast(daily), F.col("__rate_key") == F.col("__rate_dt"), "left")
    return out.drop("__rate_key", "__rate_dt")


def sum_across(frames: Sequence[DataFrame], keys: Sequence[str], result_col: str,
               replace_negative: bool = False) -> DataFrame:
    """JN-04: null-safe sum of one measure held in several tables, keyed the
    same; null only when every source is null; optional clamp at 0.

    Written as a union + one grouped sum instead of n full outer joins: one
    shuffle on the keys, partial sums before it.
    """
    parts = []
    for df in frames:
        measure = [c for c in df.columns if c not in keys]
        if len(measure) != 1:
            raise ValueError("each frame must hold the keys and exactly one measure")
        parts.append(df.select(*keys, F.col(measure[0]).alias("__v")))
    total = F.sum("__v")
    if replace_negative:
        total = F.when(total < 0, F.lit(0).cast("decimal(1,0)")).otherwise(total)
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy(*keys).agg(total.alias(result_col))


def translate_ids(df: DataFrame, bridge: DataFrame, from_key: str, to_key: str,
                  bridge_from: str | None = None, max_rows: int = 2_000_000) -> DataFrame:
    """JN-05: map external ids to internal ids through a bridge table
    (deduplicated first, inner join)."""
    bridge_from = bridge_from or from_key
    b = bridge.select(F.col(bridge_from).alias("__from"), F.col(to_key)).dropDuplicates()
    return join_small(df, b, F.col(from_key) == F.col("__from"), "inner", max_rows).drop("__from")


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per group under a total order (``row_number``)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def greatest_on_or_after(requests: DataFrame, facts: DataFrame, keys: Sequence[str], request_date: str,
                         fact_date: str, value: str, out_col: str) -> DataFrame:
    """TR-30: per request the greatest ``value`` among the facts of the same
    keys dated on or after it; null when there is none (or a key is null).

    An as-of join by ordered union. Facts and requests are first brought to one
    row per key and day (partial aggregates before the shuffle), so a key has at
    most as many rows as the calendar has days, however many facts or requests it
    holds. A running maximum from the newest day back gives the answer of every
    day; requests join it on key and day.
    """
    ks = list(keys)
    days = facts.select(*ks, F.col(fact_date).alias("__day"), F.col(value).alias(out_col), F.lit(False).alias("__asked")) \
        .unionByName(requests.select(*ks, F.col(request_date).alias("__day"),
                                     F.lit(None).cast(facts.schema[value].dataType).alias(out_col), F.lit(True).alias("__asked"))) \
        .where(F.col("__day").isNotNull()).groupBy(*ks, "__day").agg(F.max(out_col).alias(out_col), F.max("__asked").alias("__asked"))
    back = Window.partitionBy(*ks).orderBy(F.desc("__day")).rowsBetween(Window.unboundedPreceding, 0)
    answers = days.withColumn(out_col, F.max(out_col).over(back)).where(F.col("__asked") & F.col(out_col).isNotNull())
    return requests.withColumn("__day", F.col(request_date)).join(
        answers.drop("__asked"), [*ks, "__day"], "left").drop("__day")


def exclude_reviewed(df: DataFrame, reviewed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-07: drop rows already reviewed (left anti on the keys)."""
    return df.join(reviewed.select(*keys).dropDuplicates(), list(keys), "left_anti")


def with_metadata(df: DataFrame, metadata: DataFrame, on, max_rows: int = 2_000_000) -> DataFrame:
    """JN-08: inner join to table metadata (small side checked)."""
    return join_small(df, metadata, on, "inner", max_rows)
