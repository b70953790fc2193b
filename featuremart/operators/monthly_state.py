"""Monthly state of a table, kept between runs (QA-07..QA-10, WN-11).

A run that reports on a table's whole history should read the newest month
only. What it needs of the older ones is kept as mergeable state, partitioned by
month (``_particion``) so a month is replaced on its own:

* counts: rows, and per column nulls and zeros; sums merge them;
* customers: a bitmap per bucket of ids (``bitmap_construct_agg``), exact, so
  distinct customers of a month, or of any set of months, are bit counts of
  bitmaps merged by ``bitmap_or_agg``; ids are whole numbers;
* moments: (n, sum, sum of squares) of the monthly volumes added up from the first
  month on, in exact decimals; a trailing window's mean and deviation are the
  difference of two rows.

Counts and bitmaps of a month come from one pass: rows are grouped by month and
bucket, and a month's counts are the sums over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremart.functions.dates import period_int
from featuremart.operators.profiling import closed_month, fill_months, profile_counts, profile_rows
from featuremart.operators.windows import VOLUME_K, VOLUME_MIN_HISTORY, VOLUME_WINDOW, volume_states
from featuremart.sources.readers import date_range_filter
from featuremart.sources.writers import swap_partitions

PERIOD = "_particion"


def month_state(df: DataFrame, date_col: str, customer_col: str | None) -> DataFrame:
    """One row per month and bucket of customer ids: info_date, bucket,
    bitmap, total_rows and the counts of nulls and zeros by column."""
    if customer_col is not None and not isinstance(df.schema[customer_col].dataType, T.IntegralType):
        raise TypeError(f"customers are kept in bitmaps of whole numbers, {customer_col} is not one")
    customer = F.col(customer_col).cast("long") if customer_col else F.lit(None).cast("long")
    return df.groupBy(F.last_day(F.to_date(F.col(date_col))).alias("info_date"), F.bitmap_bucket_number(customer).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(customer)).alias("bitmap"),
             *[v.alias(k) for k, v in profile_counts(df).items()]).withColumn(PERIOD, period_int("info_date"))


def update_state(spark: SparkSession, path: str, df: DataFrame, date_col: str, customer_col: str | None,
                 start, end) -> list[dict]:
    """Compute the months from ``start`` to ``end`` anew and put them in place
    of the stored ones; other months are neither read nor rewritten. The date
    range reaches the scan of ``df``."""
    months = spark.range(1).select(F.explode(F.sequence(
        F.trunc(F.to_date(F.lit(start)), "month"), F.to_date(F.lit(end)), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    values = [r[0] for r in months.select(period_int("m")).collect()]  # a row per month of the run
    first, last = (F.trunc(F.to_date(F.lit(start)), "month"), F.last_day(F.to_date(F.lit(end))))
    bounds = spark.range(1).select(first.cast("string"), last.cast("string")).first()
    rows = date_range_filter(df, date_col, bounds[0], bounds[1])
    return swap_partitions(spark, path, PERIOD, values, month_state(rows, date_col, customer_col))


def monthly_counts(state: DataFrame) -> DataFrame:
    """One row per month: the counts, and the exact number of its customers."""
    counts = [c for c in state.columns if c not in ("info_date", "bucket", "bitmap", PERIOD)]
    return state.groupBy("info_date").agg(*[F.sum(c).alias(c) for c in counts],
                                          F.sum(F.bitmap_count("bitmap")).alias("unique_customers"))


def volumes(state: DataFrame, table_name: str, as_of) -> DataFrame:
    """QA-09 series from the state: as ``volume_series``, without the table."""
    monthly = monthly_counts(state).select(F.lit(table_name).alias("table_name"), F.col("total_rows").alias("records"),
                                           F.col("unique_customers").alias("customers"), "info_date")
    return fill_months(monthly, as_of, ["table_name"], ["records", "customers"])


def profile(state: DataFrame, schema: T.StructType, table_name: str, as_of) -> DataFrame:
    """QA-07 from the state: as ``column_profile`` of a table of that schema."""
    return profile_rows(monthly_counts(state), schema, table_name, as_of)


def customers_in_window(state: DataFrame, months: int, as_of) -> DataFrame:
    """Distinct customers of the ``months`` months up to each month end, from
    the first month of the state to the last closed one: a month's bitmaps go to
    every window that holds it and are merged there bucket by bucket."""
    last = F.least(F.last_day(F.add_months("info_date", months - 1)), closed_month(as_of))
    ends = F.when(F.col("info_date") <= closed_month(as_of), F.sequence(F.trunc("info_date", "month"), last, F.expr("INTERVAL 1 MONTH")))
    spread = state.select("bucket", "bitmap", F.explode(ends).alias("month"))
    merged = spread.groupBy(F.last_day("month").alias("window_end"), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("window_end").agg(F.sum(F.bitmap_count("bitmap")).alias("customers"))


def _exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def moments(series: DataFrame, measures: Sequence[str], before: DataFrame | None = None) -> DataFrame:
    """The series with ``<m>_n``, ``<m>_sum`` and ``<m>_sq`` added up per table
    from its first month. ``before``: stored moments; the newest row of each
    table is where the series goes on, so older months are not needed."""
    from pyspark.sql import Window

    run = Window.partitionBy("table_name").orderBy("info_date").rowsBetween(Window.unboundedPreceding, 0)
    parts = {}
    for m in measures:
        v = _exact(F.col(m))
        parts |= {f"{m}_n": F.count(m).over(run), f"{m}_sum": _exact(F.sum(v).over(run)), f"{m}_sq": _exact(F.sum(v * v).over(run))}
    out = series.withColumns(parts)
    if before is not None:
        newest = before.groupBy("table_name").agg(F.max(F.struct("info_date", *parts)).alias("__last"))
        out = out.join(newest, "table_name", "left").withColumns(
            {c: (F.col(c) + F.coalesce(F.col(f"__last.{c}"), F.lit(0))).cast(out.schema[c].dataType) for c in parts}).drop("__last")
    return out


def controls(current: DataFrame, stored: DataFrame, measures: Sequence[str], k: float = VOLUME_K,
             window: int = VOLUME_WINDOW, min_history: int = VOLUME_MIN_HISTORY) -> DataFrame:
    """WN-11 of the rows of ``current`` (any months of a series without gaps)
    from two rows of the stored moments each: up to the month before, less what
    lies before the window."""
    def at(months: int, tag: str) -> tuple[DataFrame, Column]:
        s = stored.select(F.col("table_name").alias(f"__{tag}_t"), F.col("info_date").alias(f"__{tag}_d"),
                          *[F.col(f"{m}_{p}").alias(f"__{tag}_{m}_{p}") for m in measures for p in ("n", "sum", "sq")])
        day = F.last_day(F.add_months("info_date", -months))
        return s, (F.col("table_name") == F.col(f"__{tag}_t")) & (day == F.col(f"__{tag}_d"))

    out = current
    for months, tag in ((1, "hi"), (window + 1, "lo")):
        out = out.join(*at(months, tag), "left")
    for m in measures:
        n, s, q = (F.coalesce(F.col(f"__hi_{m}_{p}"), F.lit(0)) - F.coalesce(F.col(f"__lo_{m}_{p}"), F.lit(0)) for p in ("n", "sum", "sq"))
        n, s, q = n.cast("long"), _exact(s), _exact(q)
        spread = (_exact(q * n) - _exact(s * s)).cast("double")
        out = out.withColumns({f"{m}_mean": F.when(n > 0, s.cast("double") / n),
                               f"{m}_sd": F.when(n > 1, F.sqrt(spread / (n.cast("double") * (n - 1)))), f"{m}_n_hist": n})
    names = [*[c for c in ("table_name", *measures, "info_date")], *[f"{m}_{p}" for m in measures for p in ("mean", "sd", "n_hist")]]
    return volume_states(out.select(*names), measures, k, min_history)
