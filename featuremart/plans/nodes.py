"""Node-level compositions (cleaning -> transformation -> integration recast
on the driver tables) and the remaining scalar / aggregate operators."""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions import currency as CUR
from featuremart.functions import dates as D
from featuremart.functions import lookup as L
from featuremart.functions import text as T
from featuremart.operators import aggregates as A
from featuremart.operators import windows as W
from featuremart.operators.columns import (key_columns_first, label_missing_text,
                                           with_observation_dates)
from featuremart.operators.quality import QualityRules, validate_before_save, validate_layer
from featuremart.plans.inputs import (HOME, RATES_SQL, TRANSACTIONS_SQL, rates, t,
                                      transactions)
from featuremart.operators.joins import add_rate, with_metadata
from featuremart.plans.quality import records_sql
from featuremart.plans.registry import register
from featuremart.functions.dates import held_back_range, previous_month_range
from featuremart.operators.profiling import tables_with_column
from featuremart.sources.readers import (classify_tables, date_range_filter, filter_by_date_column,
                                         list_tables, load_dataset, load_many, load_optional,
                                         rows_per_date, rows_per_date_at)
from featuremart.sources.writers import document_columns, prepare_for_save


def _val(expr: str, alias: str) -> str:
    return f"CAST(round({expr}, 2) AS DECIMAL(19,2)) AS {alias}"


# --- SC-17..SC-21: currency split, unified home amount, conversions
@register("currency_views", f"""
WITH r AS ({RATES_SQL}), x AS ({TRANSACTIONS_SQL}),
y AS (SELECT x.*, r.rate FROM x LEFT JOIN r ON x.trx_date = r.rate_date)
SELECT l_orderkey, l_linenumber, l_partkey, currency_id,
       {_val("CASE WHEN currency_id = 1 THEN amount ELSE 0 END", "amount_home_val")},
       {_val("CASE WHEN currency_id = 2 THEN amount ELSE 0 END", "amount_foreign_val")},
       {_val("CASE WHEN currency_id = 1 THEN amount ELSE amount * rate END", "amount_unified_val")},
       {_val("amount * rate", "amount_converted_val")},
       CAST(round(CASE WHEN currency_id = 2 THEN CAST(amount AS DECIMAL(38,10)) / rate ELSE 0 END, 2) AS DECIMAL(19,2)) AS from_home_foreign_val
FROM y
""")
def currency_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = add_rate(transactions(spark, sf_dir), rates(spark, sf_dir), "trx_date")
    views = CUR.currency_views("currency_id", "amount", "rate", {"home": 1, "foreign": 2}, HOME)
    foreign = CUR.split_home_amount("currency_id", F.col("amount").cast("decimal(38,10)"), "rate",
                                    {"foreign": 2}, HOME, value_name="from_home")
    out = y.select("l_orderkey", "l_linenumber", "l_partkey", "currency_id", *views,
                   CUR.convert("amount", "rate").alias("amount_converted"), *foreign)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "currency_id",
                      CUR.money("amount_home").alias("amount_home_val"),
                      CUR.money("amount_foreign").alias("amount_foreign_val"),
                      CUR.money("amount_unified").alias("amount_unified_val"),
                      CUR.money("amount_converted").alias("amount_converted_val"),
                      CUR.money("from_home_foreign").alias("from_home_foreign_val"))


# --- SC-24 / SC-33 / SC-34 / SC-35: payment date, code-picked values, compound key
@register("card_fields", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) - 5
            WHEN o_orderpriority = '2-HIGH' THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) - 6
            ELSE CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) END AS payment_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2))
            WHEN o_orderstatus = 'O' THEN CAST(-o_totalprice AS DECIMAL(18,2)) END AS signed_amount,
       concat_ws('_', CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'pending' END,
                 lower(substr(o_orderpriority, 3))) AS pivot_key
FROM orders
""")
def card_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    status_name = L.map_lookup("o_orderstatus", {"F": "closed", "O": "open"}, default="pending")
    return o.select(
        "o_orderkey",
        D.next_payment_date("o_orderdate", "o_orderpriority", early_types=["1-URGENT"],
                            earlier_types=["2-HIGH"]).alias("payment_date"),
        L.pick_by_code("o_orderstatus", "F", F.col("o_totalprice"), "O", -F.col("o_totalprice"),
                       cast="decimal(18,2)").alias("signed_amount"),
        L.compound_key(status_name, F.lower(F.substr("o_orderpriority", F.lit(3)))).alias("pivot_key"))


# --- AG-02 / AG-09 / AG-20: first and last dates per group, any-flag, rows per date
@register("date_bounds", """
SELECT o_custkey AS customer_key, min(CAST(o_orderdate AS DATE)) AS first_order, max(CAST(o_orderdate AS DATE)) AS last_order,
       CAST(max(CASE WHEN o_orderstatus = 'P' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'
                     THEN 1 ELSE 0 END) AS INTEGER) AS pending_9899_flag,
       CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) AS order_days
FROM orders GROUP BY 1
""")
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_key"),
                                          F.to_date("o_orderdate").alias("d"), "o_orderstatus")
    # rows per day first (partial counts), then every bound of the customer in one aggregate
    per_day = o.groupBy("customer_key", "d").agg(A.any_flag(
        (F.col("o_orderstatus") == "P") & F.col("d").between("1998-01-01", "1999-12-31"))
        .alias("pending_9899_flag"))
    return per_day.groupBy("customer_key").agg(
        F.min("d").alias("first_order"), F.max("d").alias("last_order"),
        F.max("pending_9899_flag").alias("pending_9899_flag"), F.count("d").alias("order_days"))


# --- WN-04 / WN-05 / WN-06: worst graded row per key; latest history shown only with debt
@register("worst_and_latest", """
WITH o AS (SELECT o_custkey AS customer_key, o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS grade,
                  CAST(o_orderdate AS DATE) AS d, o_orderstatus, o_totalprice FROM orders),
w AS (SELECT customer_key, o_orderkey AS worst_order, grade AS worst_grade FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_key ORDER BY grade DESC, o_orderkey ASC) AS rn
        FROM o WHERE grade <> 5) WHERE rn = 1),
c AS (SELECT customer_key, count_if(o_orderstatus = 'O') AS open_cnt FROM o GROUP BY 1),
l AS (SELECT customer_key, d AS latest_date, o_totalprice AS latest_amount FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_key ORDER BY d DESC, o_orderkey DESC) AS rn FROM o) WHERE rn = 1)
SELECT l.customer_key, CAST(c.open_cnt AS BIGINT) AS open_cnt,
       CASE WHEN c.open_cnt > 0 THEN l.latest_date END AS latest_date,
       CASE WHEN c.open_cnt > 0 THEN l.latest_amount END AS latest_amount,
       w.worst_order, w.worst_grade
FROM l JOIN c USING (customer_key) LEFT JOIN w USING (customer_key)
""")
def worst_and_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), "o_orderkey",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("grade"),
        F.to_date("o_orderdate").alias("d"), "o_orderstatus", "o_totalprice")
    # one grouped pass: open orders, worst graded row and newest row are aggregates of it
    g = o.groupBy("customer_key").agg(
        A.count_if(F.col("o_orderstatus") == "O").alias("open_cnt"),
        W.worst_of("grade", [-F.col("o_orderkey")], ["o_orderkey", "grade"], exclude_grades=[5]).alias("worst"),
        W.latest_of("d", [F.col("o_orderkey")], ["d", "o_totalprice"]).alias("latest"))
    has_debt = F.col("open_cnt") > 0
    return g.select("customer_key", "open_cnt", F.when(has_debt, F.col("latest.d")).alias("latest_date"),
                    F.when(has_debt, F.col("latest.o_totalprice")).alias("latest_amount"),
                    F.col("worst.o_orderkey").alias("worst_order"), F.col("worst.grade").alias("worst_grade"))


# --- DQ-06 / DQ-14: validate every dataset of a layer in one plan; a validator that fails becomes a HIGH record
LAYER_RULES = {
    "orders": QualityRules(unique_keys=["o_orderkey"], allowed_values={"o_orderstatus": ["F", "O"]}),
    "customer": QualityRules(null_limits={"c_acctbal": 0},
                             rules=[{"name": "non_negative_balance", "condition": "c_acctbal >= 0"}]),
    "supplier": QualityRules(unique_keys=["s_nationkey"]),
}


@register("dq_layer", "\nUNION ALL\n".join(f"SELECT * FROM ({q})" for q in [
    records_sql("SELECT * FROM orders", "orders", LAYER_RULES["orders"], "o_orderdate"),
    records_sql("SELECT * FROM customer", "customer", LAYER_RULES["customer"], None),
    records_sql("SELECT * FROM supplier", "supplier", LAYER_RULES["supplier"], None)]))
def dq_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {n: t(spark, sf_dir, n) for n in LAYER_RULES}
    return validate_layer(spark, frames, LAYER_RULES, {"orders": "o_orderdate"})


# --- SRC-05 / SRC-09 / JN-08: case-insensitive date filter; tables classified by date column;
#     counts joined to the table metadata
@register("classify_and_filter", """
SELECT 'events' AS table_name, CAST(count(*) AS BIGINT) AS rows_in_range,
       'ts' AS date_column, 'transactional' AS table_kind
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
UNION ALL
SELECT 'customer', CAST(count(*) AS BIGINT), NULL, 'catalog' FROM customer
UNION ALL
SELECT 'orders', CAST(count(*) AS BIGINT), 'o_orderdate', 'transactional' FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
""")
def classify_and_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {n: t(spark, sf_dir, n) for n in ["events", "customer", "orders"]}
    kinds = classify_tables(spark, frames, {"TS": "transactional", "O_ORDERDATE": "transactional"})
    counts = None
    for name, df in frames.items():
        date_col = next((c for c in df.columns if c.lower() in ("ts", "o_orderdate")), "none")
        n = filter_by_date_column(df, date_col.upper(), "2024-01-10", "2024-01-20") \
            .agg(F.count(F.lit(1)).alias("rows_in_range")).withColumn("table_name", F.lit(name))
        counts = n if counts is None else counts.unionByName(n)
    return with_metadata(counts, kinds, "table_name")  # JN-08: inner join to table metadata


# --- a cleaning node end to end: keys, flags, text, observation period (PRJ-12), prefix, gate
#     (CL + SNK-03 + DQ-12)
CLEAN_RULES = QualityRules(unique_keys=["customer_key"], null_limits={"cus_segment": 0})
# Fixed example word list for the word-boundary flag (parameter of the node).
FLAG_WORDS = ["Customer#000000007", "Customer#000000042"]


@register("clean_customer_node", """
WITH c AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey, c_acctbal,
                  CAST(o.m AS DATE) AS info_date
           FROM customer JOIN (SELECT o_custkey, max(last_day(CAST(o_orderdate AS DATE))) AS m FROM orders GROUP BY 1) o
             ON o.o_custkey = c_custkey)
SELECT c_custkey AS customer_key, '0x' || hex(c_custkey) AS cus_customer_hex,
       CASE WHEN c_mktsegment IS NULL OR trim(c_mktsegment) = '' THEN 'unknown' ELSE c_mktsegment END AS cus_segment,
       CASE WHEN upper(trim(substr(c_mktsegment, 1, 1))) IN ('S','SI','Y','YES','1','A') THEN 1 ELSE 0 END AS cus_segment_flag,
       CASE WHEN regexp_matches(trim(c_name), '\\bCustomer#000000007\\b|\\bCustomer#000000042\\b') THEN 1 ELSE 0 END AS cus_listed_flag,
       c_nationkey AS cus_nation_key, CAST(round(c_acctbal, 2) AS DECIMAL(19,2)) AS cus_balance_val,
       info_date AS cus_info_date,
       CAST(date_trunc('month', info_date) AS DATE) AS _observ_start_dt, info_date AS _observ_end_dt,
       CAST(strftime(info_date, '%Y%m') AS INTEGER) AS _particion
FROM c
""")
def clean_customer_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    last_month = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max(F.last_day(F.to_date("o_orderdate"))).alias("info_date"))
    raw = c.join(last_month, c.c_custkey == last_month.o_custkey)
    cleaned = raw.select(
        F.col("c_custkey").alias("customer_key"), T.hex_key("c_custkey").alias("customer_hex"),
        F.col("c_mktsegment").alias("segment"),
        T.truthy_flag(F.substring("c_mktsegment", 1, 1)).alias("segment_flag"),
        T.any_has_word(["c_name"], FLAG_WORDS).alias("listed_flag"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"), "info_date")
    cleaned = label_missing_text(cleaned, exclude=["customer_key", "customer_hex"])
    cleaned = with_observation_dates(cleaned, "info_date")
    cleaned = key_columns_first(cleaned, ["customer_key", "_observ_start_dt", "_observ_end_dt"])

    keys = ["customer_key", "_observ_start_dt", "_observ_end_dt"]
    # the node's output is validated by month before it may be written (DQ-12)
    return prepare_for_save(cleaned, "cus", "_observ_end_dt", keys,
                            gate=lambda df: validate_before_save(df, "clean_customer", CLEAN_RULES,
                                                                 "_observ_end_dt"))


# --- SRC-01 / SRC-03 / SRC-04 / SRC-06 / SRC-08 / SRC-10 / QA-05 / QA-12 / QA-15 / SNK-06:
#     a node's inputs: loaded from a catalog (a missing user path falls back to the
#     shared one), listed as views minus excluded prefixes, the dated ones found by
#     their column, counted per day inside their run windows (held back two days, or
#     the previous calendar month), and documented with column comments
INPUT_DATE_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
HELD_BACK = held_back_range(_dt.date(1995, 1, 1), as_of=_dt.date(2001, 12, 31))
PREVIOUS_MONTH = previous_month_range(as_of=_dt.date(2001, 12, 15))


@register("node_inputs", f"""
SELECT 'customer' AS table_name, CAST(NULL AS DATE) AS info_date, CAST(count(*) AS BIGINT) AS records FROM customer
UNION ALL
SELECT 'orders', CAST(o_orderdate AS DATE), CAST(count(*) AS BIGINT) FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{HELD_BACK[0]}' AND DATE '{HELD_BACK[1]}' GROUP BY 2
UNION ALL
SELECT 'lineitem', CAST(l_shipdate AS DATE), CAST(count(*) AS BIGINT) FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{PREVIOUS_MONTH[0]}' AND DATE '{PREVIOUS_MONTH[1]}' GROUP BY 2
UNION ALL
SELECT 'leads', CAST(NULL AS DATE), CAST(0 AS BIGINT)
""")
def node_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sf_dir.rstrip("/")
    customers = load_dataset(spark, f"{root}/customer.parquet")  # SRC-01: empty is an error
    catalog = {
        "orders": {"path": f"{root}/orders.parquet"},
        # the user area has no copy: the shared path is read instead
        "lineitem": {"path": f"{root}/user_area/lineitem.parquet", "fallback": f"{root}/lineitem.parquet"},
    }
    frames = {"customer": customers, **load_many(spark, catalog)}
    # SRC-04: an optional input that is absent gives None and is left out
    optional = {"leads": load_optional(spark, path=f"{root}/user_area/leads.parquet")}
    frames.update({n: df for n, df in optional.items() if df is not None})
    tag = uuid.uuid4().hex[:8]
    views = {f"in_{tag}_{n}": df for n, df in frames.items()}
    for v, df in views.items():
        df.createOrReplaceTempView(v)
    frames["orders"].limit(0).createOrReplaceTempView(f"tmp_{tag}_scratch")
    listed = [v for v in list_tables(spark, exclude_prefixes=["tmp_"]) if v in views]
    # QA-05 over schema metadata: one row per (table, column), bounded by the schemas
    columns = spark.createDataFrame([(v, c) for v in listed for c in spark.table(v).columns],
                                    "table_name string, column_name string")
    windows = {"orders": HELD_BACK, "lineitem": PREVIOUS_MONTH}
    parts = []
    for v in listed:
        name = v[len(f"in_{tag}_"):]
        date_col = INPUT_DATE_COLUMNS.get(name)
        if date_col is None or v not in tables_with_column(columns, date_col):
            parts.append(rows_per_date(spark.table(v), None, name))
        else:
            df = date_range_filter(spark.table(v), date_col, *windows[name])
            parts.append(rows_per_date(df, date_col, name))
    for v in [*views, f"tmp_{tag}_scratch"]:
        spark.catalog.dropTempView(v)
    # an input that cannot be read is counted as one zero row (SRC-06 on a path)
    parts += [rows_per_date_at(spark, f"{root}/user_area/{n}.parquet", None, n)
              for n, df in optional.items() if df is None]
    out = reduce(DataFrame.unionByName, parts)
    return document_columns(out, {"table_name": "input dataset", "info_date": "day of the rows",
                                  "records": "rows on that day (all rows for an undated table)"})
