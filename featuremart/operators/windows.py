"""Window operators, top-k per group, trailing frames (WN-01..WN-12).

Every ranking gets a unique tie-break so results do not depend on the
physical row order (S-05). Where only one row per group is needed and no
rank column is kept, ``max_by`` over a struct would avoid sorting, but the
row_number form keeps all columns and is what the reference expresses; both
shuffle once on the partition keys.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order: Iterable) -> list[Column]:
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
        elif isinstance(o, tuple):
            c, direction = o
            c = F.col(c) if isinstance(c, str) else c
            out.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
        else:
            out.append(F.col(o).asc_nulls_last())
    return out


def top_n_per_group(df: DataFrame, partition: Sequence[str], order: Iterable, n: int = 1,
                    rank_col: str | None = None) -> DataFrame:
    """WN-01 / WN-02 / WN-09: the first ``n`` rows per partition under
    ``order`` (columns, ``(col, 'asc'|'desc')`` pairs or Columns)."""
    w = Window.partitionBy(*partition).orderBy(*_order(order))
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def top_one_by(df: DataFrame, partition: Sequence[str], columns: Sequence[str],
               order: Sequence[str], descending: bool = True) -> DataFrame:
    """WN-01 with all order columns in one direction (the reference's form)."""
    d = "desc" if descending else "asc"
    return top_n_per_group(df, partition, [(c, d) for c in order]).select(*columns)


# Rows above which one group is numbered across several tasks.
HOT_GROUP_ROWS = 5_000_000


def distributed_row_number(df: DataFrame, partition: Sequence[str], order: Iterable,
                           rank_col: str = "rank", num_partitions: int | None = None,
                           hot_threshold: int = HOT_GROUP_ROWS) -> DataFrame:
    """``row_number() OVER (PARTITION BY partition ORDER BY order)`` for every
    row, without sending a whole group to one task.

    A grouped count (partial counts before the shuffle) finds the hot groups,
    those above ``hot_threshold`` rows. There are at most rows / threshold of
    them, so their keys are a bounded broadcast. Cold groups are numbered by
    the plain window. Rows of hot groups are range-partitioned on (group,
    order), so one group spans many tasks. Each task numbers its rows
    locally, and the row counts per (group, task), a small table, give every
    task's offset. Range bounds come from a sample, so the ranged rows are
    checkpointed to the shared checkpoint folder first: a retried stage or a
    second branch of the plan sees the same task ids.
    """
    part = list(partition)
    ordered = _order(order)
    sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    hot_keys = sizes.where(F.col("__n") > hot_threshold).select(*part)
    if hot_keys.isEmpty():
        return df.withColumn(rank_col, F.row_number().over(
            Window.partitionBy(*part).orderBy(*ordered)).cast("long"))

    on = [df[k].eqNullSafe(hot_keys[k]) for k in part]
    hot_b = F.broadcast(hot_keys)  # bounded: at most rows / hot_threshold keys
    cold = df.join(hot_b, on, "left_anti").withColumn(
        rank_col, F.row_number().over(Window.partitionBy(*part).orderBy(*ordered)).cast("long"))
    hot = df.join(hot_b, on, "left_semi")

    from featuremart.session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(c).asc_nulls_last() for c in part] + ordered
    ranged = (hot.repartitionByRange(n, *sort).withColumn("__pid", F.spark_partition_id())
              .checkpoint(eager=True))
    local = ranged.withColumn(
        "__local", F.row_number().over(Window.partitionBy("__pid", *part).orderBy(*ordered)))
    counts = ranged.groupBy(*part, "__pid").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*part).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, "__pid", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"))
    keys = [*part, "__pid"]
    numbered = (local.join(offsets, [local[k].eqNullSafe(offsets[k]) for k in keys])
                .select(*[local[c] for c in df.columns],
                        (F.col("__off") + F.col("__local")).cast("long").alias(rank_col)))
    return cold.unionByName(numbered)


def rank_by_latest_date(df: DataFrame, partition: Sequence[str], date_cols: Sequence[str],
                        tiebreak: Sequence, rank_col: str = "rank") -> DataFrame:
    """WN-03: rank rows by the greatest of several dates (newest first) with
    tie-breaks; the rank stays as a column (skew-safe numbering)."""
    latest = F.greatest(*[F.col(c) for c in date_cols])
    tmp = df.withColumn("__latest", latest)
    out = distributed_row_number(tmp, partition, [("__latest", "desc"), *tiebreak], rank_col)
    return out.drop("__latest")


def worst_row(df: DataFrame, partition: Sequence[str], grade_col: str, tiebreak: Sequence,
              exclude_grades: Iterable = ()) -> DataFrame:
    """WN-04 / WN-05: the row with the worst (highest) grade per key; rows
    with excluded (ungraded) markers do not compete."""
    ex = list(exclude_grades)
    src = df.where(~F.col(grade_col).isin(*ex)) if ex else df
    src = src.where(F.col(grade_col).isNotNull())
    return top_n_per_group(src, partition, [(grade_col, "desc"), *tiebreak])


def latest_if_present(history: DataFrame, partition: Sequence[str], date_col: str,
                      tiebreak: Sequence, presence_col: str, shown: Sequence[str]) -> DataFrame:
    """WN-06: newest history row per key; its values are shown only when the
    key has such debt (``presence_col`` > 0)."""
    latest = top_n_per_group(history, partition, [(date_col, "desc"), *tiebreak])
    return latest.select(*partition, presence_col, *[
        F.when(F.col(presence_col) > 0, F.col(c)).alias(c) for c in shown])


def worst_of(grade_col: str, tiebreak: Sequence[Column], shown: Sequence[str], exclude_grades: Iterable = ()) -> Column:
    """WN-04 / WN-05 as an aggregate: the ``shown`` columns of the row with the
    highest grade (ties: greatest ``tiebreak``), ungraded rows left out. For
    callers that need one row per key and have a grouped pass of their own."""
    graded = F.col(grade_col).isNotNull()
    if list(exclude_grades):
        graded = graded & ~F.col(grade_col).isin(*list(exclude_grades))
    return F.max(F.when(graded, F.struct(F.col(grade_col), *[c.alias(f"__t{i}") for i, c in enumerate(tiebreak)],
                                         F.struct(*shown).alias("row"))))["row"]


def latest_of(date_col: str, tiebreak: Sequence[Column], shown: Sequence[str]) -> Column:
    """WN-06 as an aggregate: the ``shown`` columns of the newest row."""
    return F.max(F.struct(F.col(date_col), *[c.alias(f"__t{i}") for i, c in enumerate(tiebreak)],
                          F.struct(*shown).alias("row")))["row"]


def keep_ratio(df: DataFrame, partition: Sequence[str], order: Iterable, divisor_col: str | None = None,
               distinct_col: str | None = None, hot_threshold: int = HOT_GROUP_ROWS) -> DataFrame:
    """WN-07: keep the first ceil(rows / divisor) rows per group, which drops
    the repeats of a report sent several times. The divisor is a column that is
    the same in the whole group, or the number of distinct values of
    ``distinct_col`` in it.

    Distinct values are counted by flagging the first row of each value (the
    value before it, in the order of the values, differs) and summing the flags
    over the group, so no set of them is held. A group without any value is kept
    whole. The input (pass only the columns needed) is written once, so its plan
    runs once for the check for hot groups and the cut. Cold groups need one
    shuffle (all measures are windows over the group); hot groups, at most rows /
    hot_threshold of them, bring their size along as a bounded broadcast and are
    numbered across tasks.
    """
    from featuremart.session import staged

    part = list(partition)
    df = staged(df.sparkSession, df, "keep_ratio")
    total = F.count_distinct(distinct_col) if distinct_col else F.max(divisor_col)
    hot = (df.groupBy(*[F.col(k).alias(f"__h_{k}") for k in part]).agg(F.count(F.lit(1)).alias("__n"), total.alias("__d"))
           .where(F.col("__n") > hot_threshold))
    group = Window.partitionBy(*part)
    kept_rows = F.col("__rn") <= F.ceil(F.col("__n") / F.greatest("__d", F.lit(1)))

    def cut(x: DataFrame) -> DataFrame:
        size = F.max(divisor_col).over(group) if divisor_col else None
        if distinct_col:
            before = F.lag(distinct_col).over(group.orderBy(F.col(distinct_col).asc_nulls_first()))
            starts = F.col(distinct_col).isNotNull() & ~before.eqNullSafe(F.col(distinct_col))
            x, size = x.withColumn("__first", starts.cast("int")), F.sum("__first").over(group)
        return (x.withColumn("__rn", F.row_number().over(group.orderBy(*_order(order))))
                .withColumn("__n", F.count(F.lit(1)).over(group)).withColumn("__d", size)
                .where(kept_rows).select(*df.columns))

    if hot.isEmpty():
        return cut(df)
    small = F.broadcast(hot)  # bounded: at most rows / hot_threshold groups
    on = [F.col(k).eqNullSafe(F.col(f"__h_{k}")) for k in part]
    big = df.join(small, on).select(*df.columns, "__n", "__d")
    numbered = distributed_row_number(big, part, order, "__rn", hot_threshold=hot_threshold)
    kept = numbered.where(kept_rows).select(*df.columns)
    return cut(df.join(small, on, "left_anti")).unionByName(kept)


def last_n_records(df: DataFrame, partition: Sequence[str], order: Iterable, n: int = 18,
                   rank_col: str = "record_no") -> DataFrame:
    """WN-08: the newest ``n`` records per key, numbered from 1 (newest)."""
    return top_n_per_group(df, partition, order, n, rank_col)


# Volume-control states and defaults of the reference.
STATE_NO_HISTORY = "NO_HISTORY"
STATE_OK = "OK"
STATE_LOW = "ALERT_LOW"
STATE_HIGH = "ALERT_HIGH"
VOLUME_WINDOW = 18
VOLUME_MIN_HISTORY = 12
VOLUME_K = 2.2


def volume_controls(series: DataFrame, series_key: str, order_col: str,
                    measures: Sequence[str], k: float = VOLUME_K,
                    window: int = VOLUME_WINDOW, min_history: int = VOLUME_MIN_HISTORY
                    ) -> DataFrame:
    """WN-11: per measure, mean / sample stddev / count over the ``window``
    preceding rows (current excluded), bounds mean +- k*sd, state and z-score.

    States: fewer than ``min_history`` rows -> NO_HISTORY; sd null or 0 -> OK
    with null z; below / above bounds -> ALERT_LOW / ALERT_HIGH (S-19).
    """
    w = Window.partitionBy(series_key).orderBy(order_col).rowsBetween(-window, -1)
    cols = [F.col(c) for c in series.columns]
    for m in measures:
        mean, sd, n = F.avg(m).over(w), F.stddev_samp(m).over(w), F.count(m).over(w)
        cols += [mean.alias(f"{m}_mean"), sd.alias(f"{m}_sd"), n.alias(f"{m}_n_hist")]
    return volume_states(series.select(*cols), measures, k, min_history)


def volume_states(stats: DataFrame, measures: Sequence[str], k: float = VOLUME_K,
                  min_history: int = VOLUME_MIN_HISTORY) -> DataFrame:
    """Bounds, state and z-score of each measure from its ``_mean``, ``_sd``
    and ``_n_hist`` columns."""
    kk = F.lit(float(k))
    out = [F.col(c) for c in stats.columns]
    for m in measures:
        mean, sd, n = F.col(f"{m}_mean"), F.col(f"{m}_sd"), F.col(f"{m}_n_hist")
        lo, hi = mean - kk * sd, mean + kk * sd
        flat = sd.isNull() | (sd == 0)
        out += [lo.alias(f"{m}_lower"), hi.alias(f"{m}_upper"),
                F.when(n < min_history, F.lit(STATE_NO_HISTORY))
                 .when(flat, F.lit(STATE_OK))
                 .when(F.col(m) < lo, F.lit(STATE_LOW))
                 .when(F.col(m) > hi, F.lit(STATE_HIGH))
                 .otherwise(F.lit(STATE_OK)).alias(f"{m}_state"),
                F.when(flat, F.lit(None).cast("double"))
                 .otherwise((F.col(m) - mean) / sd).alias(f"{m}_z")]
    return stats.select(*out)
