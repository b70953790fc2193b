"""Completeness, profiling and reconciliation queries (QA family)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.operators.columns import with_period
from featuremart.operators.profiling import (column_profile, completeness,
                                             expected_dates, listed_tables, missing_months,
                                             monthly_spine, reconcile_counts)
from featuremart.plans.inputs import account_snapshots, t
from featuremart.plans.registry import register
from featuremart.operators.joins import exclude_reviewed
from featuremart.operators.monthly_state import (controls, customers_in_window, moments, month_state, profile,
                                                 update_state, volumes)
from featuremart.session import staged
from featuremart.sources.readers import date_range_filter, partition_counts, union_tagged
from featuremart.sources.writers import (new_location, save_partitioned, upsert_in_partitions,
                                         write_json_lines)


# The run date of the checks: later than the last load of every table, so a table that
# stopped loading shows months and days without rows.
AS_OF = "2024-03-10"
CLOSED = f"last_day(DATE '{AS_OF}' - INTERVAL 1 MONTH)"


# --- QA-06: month-end spine from the first month of the data to the last closed month
@register("date_spine", f"""
SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(CAST(o_orderdate AS DATE))),
                                            {CLOSED}, INTERVAL 1 MONTH)) AS DATE)) AS info_date
FROM orders
""")
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_spine(t(spark, sf_dir, "orders"), "o_orderdate", AS_OF)


# kind, date column and the run's window of every checked table
CHECKED = {"orders": ("transactional", "o_orderdate", "2001-01-01", "2001-12-31"),
           "lineitem": ("transactional", "l_shipdate", "2001-01-01", "2001-12-31"),
           "events": ("transactional", "ts", "2024-01-01", "2024-02-15"),
           "account_snapshot": ("snapshot", "info_date", "2001-01-01", "2001-12-31"),
           "nation": ("catalog", "loaded_on", "2024-02-15", "2024-02-15")}


def _checked_tables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in CHECKED.items()],
                                 "table_name string, table_kind string, date_column string, start_date string, end_date string")


def _dated_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """(table, date) rows of every checked table inside its window: daily
    tables, a month-end snapshot, and a catalog, whose rows count for the day
    of the load."""
    def window(df: DataFrame, name: str, column: str) -> DataFrame:
        _, _, lo, hi = CHECKED[name]
        return date_range_filter(df, column, lo, hi).select(F.to_date(column).alias("info_date"))

    loaded_on = F.to_date(F.lit(CHECKED["nation"][3])).alias("info_date")
    return {
        "orders": window(t(spark, sf_dir, "orders"), "orders", "o_orderdate"),
        "lineitem": window(t(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate"),
        "events": window(t(spark, sf_dir, "events"), "events", "ts"),
        "account_snapshot": window(account_snapshots(spark, sf_dir), "account_snapshot", "info_date"),
        "nation": t(spark, sf_dir, "nation").select(loaded_on),
    }


def _completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = union_tagged(_dated_tables(spark, sf_dir), ["info_date"])
    counts = dated.groupBy("table_name", "info_date").agg(F.count(F.lit(1)).alias("cnt"))
    return completeness(expected_dates(_checked_tables(spark)), counts)


def _in_window(name: str, column: str) -> str:
    return f"CAST({column} AS DATE) BETWEEN DATE '{CHECKED[name][2]}' AND DATE '{CHECKED[name][3]}'"


_DATED_SQL = f"""
  SELECT 'orders' AS table_name, CAST(o_orderdate AS DATE) AS info_date FROM orders WHERE {_in_window("orders", "o_orderdate")}
  UNION ALL SELECT 'lineitem', CAST(l_shipdate AS DATE) FROM lineitem WHERE {_in_window("lineitem", "l_shipdate")}
  UNION ALL SELECT 'events', CAST(ts AS DATE) FROM events WHERE {_in_window("events", "ts")}
  UNION ALL SELECT 'account_snapshot', info_date FROM (
    SELECT DISTINCT o_custkey, o_orderpriority, last_day(CAST(o_orderdate AS DATE)) AS info_date FROM orders)
    WHERE {_in_window("account_snapshot", "info_date")}
  UNION ALL SELECT 'nation', DATE '{CHECKED["nation"][3]}' FROM nation"""

GRID_SQL = f"""
  SELECT table_name, table_kind, date_column, info_date FROM (
    SELECT v.*, CAST(unnest(generate_series(CAST(lo AS DATE), CAST(hi AS DATE), INTERVAL 1 DAY)) AS DATE) AS info_date
    FROM (VALUES {", ".join("(" + ", ".join(f"'{x}'" for x in (k, *v)) + ")" for k, v in CHECKED.items())})
         AS v(table_name, table_kind, date_column, lo, hi))
  WHERE table_kind <> 'snapshot' OR info_date = last_day(info_date)"""

COMPLETENESS_SQL = f"""
WITH d AS ({_DATED_SQL}),
g AS ({GRID_SQL}),
c AS (SELECT table_name, info_date, count(*) AS cnt FROM d GROUP BY 1, 2)
SELECT g.table_name, g.info_date, g.table_kind, g.date_column, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
FROM g LEFT JOIN c ON c.table_name = g.table_name AND c.info_date = g.info_date
"""


# --- QA-01..QA-03 (QA-16 / QA-17 with the upper layers' date columns): rows per table and
#     date expected in the run's window, 0 where missing
@register("date_completeness", COMPLETENESS_SQL)
def date_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _completeness(spark, sf_dir)


# --- QA-04: months with gaps, per-table tolerance for transactional tables
TOLERANCES = {"lineitem": 2, "events": 0}


@register("gap_tolerance", f"""
WITH comp AS ({COMPLETENESS_SQL}),
m AS (SELECT table_name, table_kind, date_column, last_day(info_date) AS month_end, CAST(count(*) AS BIGINT) AS missing_days
      FROM comp WHERE cnt = 0 GROUP BY 1, 2, 3, 4)
SELECT table_name, table_kind, date_column, strftime(month_end, '%Y-%m') AS month_without_data, missing_days
FROM m
WHERE table_kind <> 'transactional'
   OR NOT (contains(table_name, 'lineitem') OR contains(table_name, 'events'))
   OR (contains(table_name, 'lineitem') AND 2 < missing_days)
   OR (contains(table_name, 'events') AND 0 < missing_days)
""")
def gap_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_months(_completeness(spark, sf_dir), TOLERANCES)


# --- QA-07: column profile per month on a month-end spine
def _ratio_sql(n: str) -> str:
    return f"CAST(round(CAST({n} AS DECIMAL(20,0)) / total_rows, 4) AS DECIMAL(10,4))"


PROFILE_COLUMNS = {
    "orders": [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "string", False),
               ("o_totalprice", "double", True), ("o_orderdate", "timestamp_ntz", False),
               ("o_orderpriority", "string", False)],
    "lineitem": [("l_orderkey", "bigint", True), ("l_partkey", "bigint", True), ("l_suppkey", "bigint", True),
                 ("l_linenumber", "int", True), ("l_quantity", "double", True), ("l_extendedprice", "double", True),
                 ("l_discount", "double", True), ("l_tax", "double", True), ("l_returnflag", "string", False),
                 ("l_linestatus", "string", False), ("l_shipdate", "timestamp_ntz", False)],
}


def _profile_sql(table: str = "orders", date_col: str = "o_orderdate", cust: str | None = "o_custkey") -> str:
    """DuckDB form of ``column_profile`` for one table (oracle)."""
    cols = PROFILE_COLUMNS[table]
    aggs, parts = [], []
    for i, (c, typ, num) in enumerate(cols):
        aggs.append(f"count_if({c} IS NULL) AS n{i}")
        if num:
            aggs.append(f"count_if({c} = 0) AS z{i}")
        zeros = f"CAST(coalesce(z{i}, 0) AS BIGINT)" if num else "CAST(NULL AS BIGINT)"
        zr = (f"CASE WHEN total_rows > 0 THEN {_ratio_sql(f'coalesce(z{i}, 0)')} ELSE CAST(0 AS DECIMAL(10,4)) END"
              if num else "CAST(NULL AS DECIMAL(10,4))")
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{typ}' AS data_type, total_rows, unique_customers, "
            f"CAST(coalesce(n{i}, 0) AS BIGINT) AS nulls, "
            f"CASE WHEN total_rows > 0 THEN {_ratio_sql(f'coalesce(n{i}, 0)')} ELSE CAST(0 AS DECIMAL(10,4)) END AS null_ratio, "
            f"{zeros} AS zeros, {zr} AS zero_ratio, info_date FROM w")
    distinct = f"count(DISTINCT {cust})" if cust else "0"
    return f"""
WITH sp AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(CAST({date_col} AS DATE))),
                 {CLOSED}, INTERVAL 1 MONTH)) AS DATE)) AS info_date FROM {table}),
a AS (SELECT last_day(CAST({date_col} AS DATE)) AS info_date, count(*) AS r, {distinct} AS u,
             {", ".join(aggs)} FROM {table} GROUP BY 1),
w AS (SELECT sp.info_date, CAST(coalesce(a.r, 0) AS BIGINT) AS total_rows, CAST(coalesce(a.u, 0) AS BIGINT) AS unique_customers,
             a.* EXCLUDE (info_date, r, u) FROM sp LEFT JOIN a USING (info_date))
""" + "\nUNION ALL\n".join(parts)


@register("column_profile", _profile_sql())
def column_profile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    return column_profile(o, "orders", "o_orderdate", AS_OF, ["o_custkey"])


# --- QA-13: what each load still owes, for the three load kinds; the source reports one row
#     more on month ends of even months, and the lake lacks the 15th of the month
def _source_extra() -> str:
    return "CASE WHEN info_date = last_day(info_date) AND month(info_date) % 2 = 0 THEN 1 ELSE 0 END"


RECONCILE_AS_OF = "2002-01-12"
RECONCILED = {k: (CHECKED[k][0], "2001-06-01", "2002-01-11") for k in ("orders", "account_snapshot")} | {
    "nation": ("catalog", "2002-01-11", "2002-01-11"), "missing_catalog": ("catalog", "2002-01-11", "2002-01-11")}


def _issue_sql(grid: str, lake: str, source: str, as_of: str) -> str:
    """DuckDB form of ``reconcile_counts`` over (table_name, table_kind,
    info_date), and counts per (table_name, info_date)."""
    weeks = f"CASE WHEN g.table_kind = 'catalog' THEN 0 ELSE CAST(trunc(date_diff('day', g.info_date, DATE '{as_of}' - 2) / 7.0) AS INTEGER) END"
    return f"""
  SELECT table_name, info_date, table_kind, CAST(coalesce(lake_records, 0) AS BIGINT) AS lake_records,
         CAST(source_records AS BIGINT) AS source_records, weeks_overdue,
         CASE WHEN weeks_overdue < 1 THEN 're-ingest' ELSE 'missing_at_source' END AS issue
  FROM (SELECT g.*, l.records AS lake_records, s.records AS source_records, {weeks} AS weeks_overdue
        FROM {grid} g LEFT JOIN {lake} l USING (table_name, info_date) LEFT JOIN {source} s USING (table_name, info_date)
        WHERE g.table_kind <> 'snapshot'
           OR (g.info_date = last_day(g.info_date) AND g.info_date <= last_day(DATE '{as_of}' - INTERVAL 1 MONTH)))
  WHERE coalesce(lake_records, 0) = 0 OR (table_kind = 'snapshot' AND lake_records <> source_records)"""


@register("count_reconcile", f"""
WITH grid AS (SELECT table_name, table_kind, CAST(unnest(generate_series(CAST(lo AS DATE), CAST(hi AS DATE), INTERVAL 1 DAY)) AS DATE) AS info_date
              FROM (VALUES {", ".join("(" + ", ".join(f"'{x}'" for x in (k, *v)) + ")" for k, v in RECONCILED.items())})
                   AS v(table_name, table_kind, lo, hi)),
d AS (SELECT 'orders' AS table_name, CAST(o_orderdate AS DATE) AS info_date FROM orders
      UNION ALL SELECT 'account_snapshot', info_date FROM (
        SELECT DISTINCT o_custkey, o_orderpriority, last_day(CAST(o_orderdate AS DATE)) AS info_date FROM orders)
      UNION ALL SELECT 'nation', DATE '2002-01-11' FROM nation),
source AS (SELECT table_name, info_date, records + {_source_extra()} AS records
           FROM (SELECT table_name, info_date, count(*) AS records FROM d GROUP BY 1, 2)),
lake AS (SELECT table_name, info_date, count(*) AS records FROM d WHERE day(info_date) <> 15 GROUP BY 1, 2)
{_issue_sql("grid", "lake", "source", RECONCILE_AS_OF)}
""")
def count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = spark.createDataFrame([(k, *v) for k, v in RECONCILED.items()],
                                   "table_name string, table_kind string, start_date string, end_date string")
    dated = union_tagged({
        "orders": t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("info_date")),
        "account_snapshot": account_snapshots(spark, sf_dir).select("info_date"),
        "nation": t(spark, sf_dir, "nation").select(F.to_date(F.lit("2002-01-11")).alias("info_date"))}, ["info_date"])
    # a row per table and day, written once: the lake's and the source's counts are both read from it
    counts = staged(spark, dated.groupBy("table_name", "info_date").agg(F.count(F.lit(1)).alias("records")), "reconcile_counts")
    source = counts.withColumn("records", F.col("records") + F.expr(_source_extra()))
    return reconcile_counts(tables, counts.where(F.dayofmonth("info_date") != 15), source, RECONCILE_AS_OF)


# --- QA-13 (metadata part): a JSON array of table objects exploded with a declared schema
@register("json_table_list", """
SELECT n.n_name AS owner, r.r_name AS "table", 'loaded_on' AS date_column,
       CASE WHEN r.r_regionkey % 2 = 0 THEN 'catalog' ELSE 'snapshot' END AS kind
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def json_table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one listing per nation: the tables of its region as JSON, as a catalog service sends them
    info = F.struct(F.struct(F.col("r_name").alias("table"), F.lit("loaded_on").alias("date_column"),
                             F.when(F.col("r_regionkey") % 2 == 0, "catalog").otherwise("snapshot").alias("kind")).alias("info"))
    region = t(spark, sf_dir, "region").groupBy("r_regionkey").agg(F.to_json(F.collect_list(info)).alias("info"))
    listing = t(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("n_name").alias("owner"), "info")
    return listed_tables(listing, "info")


# --- QA-08 / QA-10 / QA-11: volume and profile reports over several tables in one plan
LAYER_TABLES = {"orders": ("o_orderdate", "o_custkey"), "lineitem": ("l_shipdate", None),
                "events": ("ts", "user_id")}


def _volume_series_sql(name: str, date_col: str, cust: str | None) -> str:
    cust_expr = f"count(DISTINCT {cust})" if cust else "0"
    return f"""
  SELECT '{name}' AS table_name, CAST(coalesce(c.records, 0) AS BIGINT) AS records,
         CAST(coalesce(c.customers, 0) AS BIGINT) AS customers, sp.info_date
  FROM (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(CAST({date_col} AS DATE))),
               {CLOSED}, INTERVAL 1 MONTH)) AS DATE)) AS info_date FROM {name}) sp
  LEFT JOIN (SELECT last_day(CAST({date_col} AS DATE)) AS info_date, count(*) AS records, {cust_expr} AS customers
             FROM {name} GROUP BY 1) c USING (info_date)"""


def _r6(c: str) -> str:
    return f"round({c}, 6) AS {c}"


VOLUME_LAYER_SQL = f"""
WITH s AS ({" UNION ALL ".join(_volume_series_sql(n, d, c) for n, (d, c) in LAYER_TABLES.items())}),
w AS (SELECT *,
        avg(records) OVER h AS records_mean, stddev_samp(records) OVER h AS records_sd, count(records) OVER h AS records_n_hist,
        avg(customers) OVER h AS customers_mean, stddev_samp(customers) OVER h AS customers_sd, count(customers) OVER h AS customers_n_hist
      FROM s WINDOW h AS (PARTITION BY table_name ORDER BY info_date ROWS BETWEEN 18 PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, records_mean - 2.2 * records_sd AS records_lower, records_mean + 2.2 * records_sd AS records_upper,
             customers_mean - 2.2 * customers_sd AS customers_lower, customers_mean + 2.2 * customers_sd AS customers_upper FROM w)
SELECT table_name, records, customers, info_date, records_n_hist, customers_n_hist,
       {_r6("records_mean")}, {_r6("records_sd")}, {_r6("records_lower")}, {_r6("records_upper")},
       {_r6("customers_mean")}, {_r6("customers_sd")}, {_r6("customers_lower")}, {_r6("customers_upper")},
       CASE WHEN records_n_hist < 12 THEN 'NO_HISTORY' WHEN records_sd IS NULL OR records_sd = 0 THEN 'OK'
            WHEN records < records_lower THEN 'ALERT_LOW' WHEN records > records_upper THEN 'ALERT_HIGH' ELSE 'OK' END AS records_state,
       round(CASE WHEN records_sd IS NULL OR records_sd = 0 THEN NULL ELSE (records - records_mean) / records_sd END, 6) AS records_z,
       CASE WHEN customers_n_hist < 12 THEN 'NO_HISTORY' WHEN customers_sd IS NULL OR customers_sd = 0 THEN 'OK'
            WHEN customers < customers_lower THEN 'ALERT_LOW' WHEN customers > customers_upper THEN 'ALERT_HIGH' ELSE 'OK' END AS customers_state,
       round(CASE WHEN customers_sd IS NULL OR customers_sd = 0 THEN NULL ELSE (customers - customers_mean) / customers_sd END, 6) AS customers_z
FROM b
"""


@register("volume_layer", VOLUME_LAYER_SQL)
def volume_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.operators.profiling import volume_report, volume_series
    from featuremart.operators.setops import union_same_shape
    series = []
    for name, (date_col, cust) in LAYER_TABLES.items():
        df = t(spark, sf_dir, name)
        series.append(volume_series(df, name, date_col, AS_OF, cust))
    rep = volume_report(union_same_shape(series))
    doubles = [f.name for f in rep.schema.fields if f.dataType.simpleString() == "double"]
    return rep.select(*[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in rep.columns])


@register("profile_layer", "\nUNION ALL\n".join(
    f"SELECT * FROM ({q})" for q in [_profile_sql("orders", "o_orderdate", "o_custkey"),
                                     _profile_sql("lineitem", "l_shipdate", None)]))
def profile_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QA-08 / QA-11 / ST-03: column profiles of every table of a layer, unioned
    into one report (one plan; tables without a customer column count 0)."""
    from featuremart.operators.setops import consolidate
    parts = []
    for name, date_col, cust in [("orders", "o_orderdate", ["o_custkey"]), ("lineitem", "l_shipdate", [])]:
        df = t(spark, sf_dir, name)
        parts.append(column_profile(df, name, date_col, AS_OF, cust))
    # a table of the layer without any file gives no part; the report keeps its shape (ST-03)
    return consolidate(spark, parts, None)


# --- QA-14: the missing-data run. Reconcile all dated tables in one plan (QA-13), upsert
#     the issues into the stored list (SNK-04: new issues inserted with their values,
#     stored issues the run no longer reports deleted inside the run's window), drop
#     reviewed issues (JN-07), hand the rest over as JSON lines (SNK-05), read back typed.
RUN_TABLES = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
RUN_DATES = {"orders": ("1996-01-01", "2001-08-31"), "lineitem": ("1996-01-01", "2001-11-30"),
             "events": ("2024-01-01", "2024-02-29")}
RUN_WINDOW = ("1997-01-01", "2024-02-29")  # stored issues of earlier days are kept
FIRST_RUN, SECOND_RUN = "2024-02-20", "2024-03-01"
ISSUE_SCHEMA = ("table_name string, info_date date, lake_records bigint, source_records bigint, "
                "weeks_overdue int, issue string")


def _issues(spark: SparkSession, lake: DataFrame, skipped_days: list[int], as_of: str) -> DataFrame:
    """Issues of one run from the lake's rows per (table, day), of which the
    ``skipped_days`` of the month are not loaded yet."""
    tables = spark.createDataFrame([(n, "transactional", *RUN_DATES[n]) for n in RUN_TABLES],
                                   "table_name string, table_kind string, start_date string, end_date string")
    loaded = lake.where(~F.dayofmonth("info_date").isin(*skipped_days))
    return reconcile_counts(tables, loaded, lake, as_of).drop("table_kind")


@register("missing_data_run", f"""
WITH b AS ({" UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST({c} AS DATE) AS d FROM {n}" for n, c in RUN_TABLES.items())}),
lake AS (SELECT table_name, d AS info_date, count(*) AS records FROM b GROUP BY 1, 2),
grid AS (SELECT table_name, 'transactional' AS table_kind, CAST(unnest(generate_series(CAST(lo AS DATE), CAST(hi AS DATE), INTERVAL 1 DAY)) AS DATE) AS info_date
         FROM (VALUES {", ".join(f"('{k}', '{lo}', '{hi}')" for k, (lo, hi) in RUN_DATES.items())}) AS v(table_name, lo, hi)),
early AS (SELECT * FROM lake WHERE day(info_date) NOT IN (14, 15)),
late AS (SELECT * FROM lake WHERE day(info_date) <> 15),
prev AS (SELECT *, day(info_date) = 14 AS reviewed FROM ({_issue_sql("grid", "early", "lake", FIRST_RUN)})),
cur AS ({_issue_sql("grid", "late", "lake", SECOND_RUN)}),
m AS (SELECT coalesce(p.table_name, c.table_name) AS table_name, coalesce(p.info_date, c.info_date) AS info_date,
             CASE WHEN p.table_name IS NULL THEN c.lake_records ELSE p.lake_records END AS lake_records,
             CASE WHEN p.table_name IS NULL THEN c.source_records ELSE p.source_records END AS source_records,
             CASE WHEN p.table_name IS NULL THEN c.weeks_overdue ELSE p.weeks_overdue END AS weeks_overdue,
             CASE WHEN p.table_name IS NULL THEN c.issue ELSE p.issue END AS issue,
             CASE WHEN p.table_name IS NULL THEN false ELSE p.reviewed END AS reviewed
      FROM prev p FULL JOIN cur c ON p.table_name = c.table_name AND p.info_date = c.info_date
      WHERE c.table_name IS NOT NULL
         OR NOT coalesce(p.info_date BETWEEN DATE '{RUN_WINDOW[0]}' AND DATE '{RUN_WINDOW[1]}', false))
SELECT table_name, info_date, lake_records, source_records, weeks_overdue, issue FROM m WHERE NOT reviewed
""")
def missing_data_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = reduce(DataFrame.unionByName, [
        t(spark, sf_dir, n).select(F.lit(n).alias("table_name"), F.to_date(c).alias("info_date"))
        for n, c in RUN_TABLES.items()])
    path = new_location(spark, "missing_data_run")
    # rows per (table, day): one pass over the tables, partial counts before the shuffle; the
    # result is small (tables x days) and written once, both runs below read it
    lake = dates.groupBy("table_name", "info_date").agg(F.count(F.lit(1)).alias("records"))
    lake.write.mode("overwrite").parquet(f"{path}/lake_counts")
    lake = spark.read.parquet(f"{path}/lake_counts")
    # the stored list from the previous run; someone reviewed the day-14 gaps
    previous = _issues(spark, lake, [14, 15], FIRST_RUN).withColumn("reviewed", F.dayofmonth("info_date") == 14)
    save_partitioned(with_period(previous, "info_date"), f"{path}/store", "_particion", "replace_schema")
    upsert_in_partitions(spark, f"{path}/store", _issues(spark, lake, [15], SECOND_RUN), ["table_name", "info_date"],
                         "info_date", *RUN_WINDOW, "reviewed", False)
    store = spark.read.parquet(f"{path}/store").drop("_particion")
    pending = exclude_reviewed(store, store.where("reviewed"), ["table_name", "info_date"])
    write_json_lines(pending.drop("reviewed"), f"{path}/handover")
    return spark.read.schema(ISSUE_SCHEMA).json(f"{path}/handover")


# --- QA-07 / QA-08 / QA-10, WN-11 from state kept between runs: the first run stores the months up
#     to STATE_UNTIL, the second reads the newer rows only; reports come from the stored counts,
#     customer bitmaps and moments
STATE_UNTIL = "2001-06-30"
STATE_TABLES = {n: LAYER_TABLES[n] for n in ("orders", "events")}


def _two_runs(spark: SparkSession, sf_dir: str, name: str, path: str) -> DataFrame:
    date_col, customer = STATE_TABLES[name]
    df = t(spark, sf_dir, name)
    update_state(spark, path, df, date_col, customer, "1995-01-01", STATE_UNTIL)
    update_state(spark, path, df, date_col, customer, "2001-07-01", "2024-02-29")
    return spark.read.parquet(path)


@register("volume_from_state", VOLUME_LAYER_SQL.replace("FROM b\n", "FROM b WHERE table_name <> 'lineitem'\n"))
def volume_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, measures = new_location(spark, "volume_state"), ["records", "customers"]
    series = reduce(DataFrame.unionByName, [
        volumes(_two_runs(spark, sf_dir, name, f"{path}/{name}"), name, AS_OF) for name in STATE_TABLES])
    # moments of the first run are stored; the second goes on from their newest row
    first = staged(spark, moments(series.where(F.col("info_date") <= F.to_date(F.lit(STATE_UNTIL))), measures), "moments")
    second = staged(spark, moments(series.where(F.col("info_date") > F.to_date(F.lit(STATE_UNTIL))), measures, first), "moments")
    rep = controls(series, first.unionByName(second), measures)
    doubles = [f.name for f in rep.schema.fields if f.dataType.simpleString() == "double"]
    return rep.select(*[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in rep.columns])


@register("profile_from_state", _profile_sql())
def profile_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _two_runs(spark, sf_dir, "orders", new_location(spark, "profile_state"))
    return profile(state, t(spark, sf_dir, "orders").schema, "orders", AS_OF)


# --- QA-08: distinct customers of the twelve months up to each month end, from merged bitmaps
CUSTOMER_MONTHS, CUSTOMERS_AS_OF = 12, "2001-12-10"


@register("customers_twelve_months", f"""
WITH m AS (SELECT DISTINCT o_custkey, last_day(CAST(o_orderdate AS DATE)) AS info_date FROM orders),
w AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(info_date)),
             last_day(DATE '{CUSTOMERS_AS_OF}' - INTERVAL 1 MONTH), INTERVAL 1 MONTH)) AS DATE)) AS window_end FROM m)
SELECT window_end, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers
FROM w JOIN m ON m.info_date <= w.window_end AND m.info_date > last_day(w.window_end - INTERVAL {CUSTOMER_MONTHS} MONTH)
GROUP BY 1
""")
def customers_twelve_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = month_state(t(spark, sf_dir, "orders").select("o_orderdate", "o_custkey"), "o_orderdate", "o_custkey")
    return customers_in_window(state, CUSTOMER_MONTHS, CUSTOMERS_AS_OF)


# --- SRC-06 / QA-03 / QA-16 / QA-17 on a table partitioned by its date: rows of every expected day
#     from footers, 0 where the day has no partition
@register("partition_completeness", """
WITH d AS (SELECT CAST(ts AS DATE) AS info_date, count(*) AS n FROM events GROUP BY 1),
g AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-15', INTERVAL 1 DAY)) AS DATE) AS info_date)
SELECT 'events' AS table_name, 'transactional' AS table_kind, g.info_date, CAST(coalesce(n, 0) AS BIGINT) AS cnt
FROM g LEFT JOIN d USING (info_date)
""")
def partition_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_location(spark, "events_by_day")
    save_partitioned(t(spark, sf_dir, "events").withColumn("info_date", F.to_date("ts")), path, "info_date", "replace_schema")
    counts = partition_counts(spark, path, "info_date").select(
        F.lit("events").alias("table_name"), F.to_date("info_date").alias("info_date"), F.col("records").alias("cnt"))
    grid = expected_dates(spark.createDataFrame([("events", "transactional", "2024-01-01", "2024-02-15")],
                                                "table_name string, table_kind string, start_date string, end_date string"))
    return completeness(grid, counts)
