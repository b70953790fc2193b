"""Stand-in inputs derived from the driver tables (FIXTURES.md §3).

The domain roles of the reference are played by the TPC-H-like tables:

* customer             -> ``customer``
* account              -> (o_custkey, o_orderpriority)
* transactions         -> ``lineitem`` joined to ``orders``; date = ship day
* movement kind / dir. -> l_returnflag / l_linestatus
* currency             -> 1 (home) for even supplier keys, else 2 (foreign)
* daily rates          -> one row per distinct order day, derived from
                          ``orders``; day 31 has no rate (missing-rate path)
* snapshot per month   -> last order per account and month end

Everything is derived by Spark from the given tables, so the work grows
with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.operators.joins import fact_join
from featuremart.sources.readers import date_range_filter, load_table

HOME, FOREIGN = 1, 2
CURRENCIES = {"home": HOME, "foreign": FOREIGN}
KINDS = ["A", "N", "R"]  # l_returnflag values
DIRECTIONS = ["F", "O"]  # l_linestatus values
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


def money(c) -> "F.Column":
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rate table: one row per day that has orders, except day 31."""
    d = F.to_date("o_orderdate")
    return (t(spark, sf_dir, "orders").select(d.alias("rate_date")).distinct()
            .where(F.dayofmonth("rate_date") != 31)
            .select("rate_date",
                    (F.lit(7.5) + (F.dayofmonth("rate_date") % 10) / F.lit(100.0))
                    .cast("decimal(10,4)").alias("rate")))


RATES_SQL = """
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date,
         CAST(7.5 + (day(CAST(o_orderdate AS DATE)) % 10) / 100.0 AS DECIMAL(10,4)) AS rate
  FROM orders WHERE day(CAST(o_orderdate AS DATE)) <> 31
"""


def transactions(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """Card-style movements: one row per line item, keyed by account.

    The ship-date range is applied on the raw column (pushed to the scan).
    """
    li = t(spark, sf_dir, "lineitem")
    if start is not None or end is not None:
        li = date_range_filter(li, "l_shipdate", start, end)
    li = li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
                   F.to_date("l_shipdate").alias("trx_date"),
                   F.col("l_returnflag").alias("kind"),
                   F.col("l_linestatus").alias("direction"),
                   F.when(F.col("l_suppkey") % 2 == 0, F.lit(HOME)).otherwise(F.lit(FOREIGN))
                    .alias("currency_id"),
                   money("l_extendedprice").alias("amount"),
                   F.col("l_quantity"), F.col("l_discount"))
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_key"),
        F.col("o_orderpriority").alias("account_key"))
    return fact_join(li, o).drop("o_orderkey")


TRANSACTIONS_SQL = """
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey,
         CAST(l.l_shipdate AS DATE) AS trx_date, l.l_returnflag AS kind,
         l.l_linestatus AS direction,
         CASE WHEN l.l_suppkey % 2 = 0 THEN 1 ELSE 2 END AS currency_id,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, l.l_quantity, l.l_discount,
         o.o_custkey AS customer_key, o.o_orderpriority AS account_key
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


def account_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot per account and month end: the month's last order (ties by
    order key) gives status and balance."""
    from featuremart.operators.windows import top_n_per_group
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"),
        F.last_day(F.to_date("o_orderdate")).alias("info_date"),
        F.to_date("o_orderdate").alias("order_date"), "o_orderkey",
        F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("balance"))
    return top_n_per_group(o, ["customer_key", "account_key", "info_date"],
                           [("order_date", "desc"), ("o_orderkey", "desc")])


SNAPSHOTS_SQL = """
  SELECT customer_key, account_key, info_date, order_date, o_orderkey, status, balance FROM (
    SELECT o_custkey AS customer_key, o_orderpriority AS account_key,
           last_day(CAST(o_orderdate AS DATE)) AS info_date, CAST(o_orderdate AS DATE) AS order_date,
           o_orderkey, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
           row_number() OVER (PARTITION BY o_custkey, o_orderpriority, last_day(CAST(o_orderdate AS DATE))
                              ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1
"""
