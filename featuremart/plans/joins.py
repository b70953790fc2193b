"""Join queries (JN-01..JN-08 and every join kind of SURVEY §2.3)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions.currency import money, to_home_currency
from featuremart.operators.broadcast import join_small
from featuremart.operators.joins import (add_rate, exclude_reviewed, first_per_group, join_all,
                                         sum_across, translate_ids)
from featuremart.plans.inputs import (HOME, RATES_SQL, SNAPSHOTS_SQL, TRANSACTIONS_SQL,
                                      account_snapshots, rates, t, transactions)
from featuremart.plans.registry import register


# --- JN-03 daily: rate of the transaction day, missing rate -> null
@register("rate_lookup_daily", f"""
WITH r AS ({RATES_SQL}), x AS ({TRANSACTIONS_SQL})
SELECT x.l_orderkey, x.l_linenumber, x.l_partkey, x.trx_date, x.currency_id, x.amount, r.rate,
       CAST(round(CASE WHEN x.currency_id = 1 THEN x.amount ELSE x.amount * r.rate END, 2) AS DECIMAL(19,2)) AS amount_home
FROM x LEFT JOIN r ON x.trx_date = r.rate_date
""")
def rate_lookup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = add_rate(transactions(spark, sf_dir), rates(spark, sf_dir), "trx_date")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "trx_date", "currency_id", "amount",
                    "rate", money(to_home_currency("currency_id", "amount", "rate", HOME))
                    .alias("amount_home"))


# --- JN-03 snapshot: rate of the month end (month ends on day 31 have none)
@register("rate_lookup_month_end", f"""
WITH r AS ({RATES_SQL}), s AS ({SNAPSHOTS_SQL})
SELECT s.customer_key, s.account_key, s.info_date, s.balance, r.rate,
       CAST(round(CASE WHEN s.customer_key % 2 = 0 THEN s.balance ELSE s.balance * r.rate END, 2) AS DECIMAL(19,2)) AS balance_home
FROM s LEFT JOIN r ON s.info_date = r.rate_date
""")
def rate_lookup_month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = account_snapshots(spark, sf_dir)
    s = add_rate(s, rates(spark, sf_dir), "info_date", snapshot=True)
    cur = F.when(F.col("customer_key") % 2 == 0, F.lit(HOME)).otherwise(F.lit(2))
    return s.select("customer_key", "account_key", "info_date", "balance", "rate",
                    money(to_home_currency(cur, "balance", "rate", HOME)).alias("balance_home"))


# --- inner join with USING keys
@register("join_inner", """
SELECT p_type, CAST(count(*) AS BIGINT) AS lines, sum(l_quantity) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(19,2)) AS revenue
FROM (SELECT l_partkey AS partkey, l_quantity, l_extendedprice FROM lineitem)
JOIN (SELECT p_partkey AS partkey, p_type FROM part) USING (partkey)
GROUP BY p_type
""")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("partkey"), "l_quantity",
                                             "l_extendedprice")
    p = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), "p_type")
    # part is a dimension: broadcast only behind the size check
    j = join_small(li, p, ["partkey"], "inner")
    return j.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"),
        F.sum(money_raw("l_extendedprice")).cast("decimal(19,2)").alias("revenue"))


def money_raw(c):
    return F.col(c).cast("decimal(18,2)")


# --- JN-01 / JN-02: fold several per-customer frames with one ``how``
@register("join_left_fold", """
WITH c AS (SELECT c_custkey AS customer_key, c_nationkey AS nation_key, c_mktsegment AS segment FROM customer),
o AS (SELECT o_custkey AS customer_key, CAST(count(*) AS BIGINT) AS orders_cnt,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(19,2)) AS orders_val
      FROM orders GROUP BY 1),
l AS (SELECT o.o_custkey AS customer_key, CAST(count(*) AS BIGINT) AS lines_cnt, max(CAST(l.l_shipdate AS DATE)) AS last_ship
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
n AS (SELECT n_nationkey AS nation_key, n_name FROM nation)
SELECT * FROM c LEFT JOIN o USING (customer_key) LEFT JOIN l USING (customer_key) LEFT JOIN n USING (nation_key)
""")
def join_left_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"),
                                            F.col("c_nationkey").alias("nation_key"),
                                            F.col("c_mktsegment").alias("segment"))
    o = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer_key")).agg(
        F.count(F.lit(1)).alias("orders_cnt"),
        F.sum(money_raw("o_totalprice")).cast("decimal(19,2)").alias("orders_val"))
    x = transactions(spark, sf_dir).groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("lines_cnt"), F.max("trx_date").alias("last_ship"))
    folded = join_all([c, o, x], ["customer_key"], "left")
    n = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation_key"), "n_name")
    return join_small(folded, n, ["nation_key"], "left")


# --- JN-04: full outer null-safe sum of one measure over several tables
@register("join_full_sum", """
WITH c AS (SELECT c_nationkey AS nation_key, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS v FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS nation_key, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS v FROM supplier GROUP BY 1),
o AS (SELECT c.c_nationkey AS nation_key, -sum(CAST(o.o_totalprice AS DECIMAL(18,2))) * 0.001 AS v
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      WHERE o.o_orderstatus = 'O' GROUP BY 1)
SELECT coalesce(c.nation_key, s.nation_key, o.nation_key) AS nation_key,
       CAST(round(greatest(coalesce(c.v, 0) + coalesce(s.v, 0) + coalesce(o.v, 0), 0), 2) AS DECIMAL(19,2)) AS net_position
FROM c FULL JOIN s ON c.nation_key = s.nation_key
       FULL JOIN o ON coalesce(c.nation_key, s.nation_key) = o.nation_key
""")
def join_full_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = t(spark, sf_dir, "customer")
    c = cust.select(F.col("c_nationkey").alias("nation_key"), money_raw("c_acctbal").alias("v"))
    s = t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation_key"),
                                            money_raw("s_acctbal").alias("v"))
    o = (t(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
         .join(cust.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .select(F.col("c_nationkey").alias("nation_key"),
                 (-money_raw("o_totalprice") * F.lit(Decimal("0.001"))).alias("v")))
    out = sum_across([c, s, o], ["nation_key"], "net_position", replace_negative=True)
    return out.withColumn("net_position", F.round("net_position", 2).cast("decimal(19,2)"))


# --- right outer join: every expected date appears, 0 where no rows
@register("join_right_dates", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS info_date, CAST(count(*) AS BIGINT) AS orders_cnt FROM orders GROUP BY 1),
g AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS info_date FROM orders)
SELECT g.info_date, coalesce(d.orders_cnt, 0) AS orders_cnt FROM d RIGHT JOIN g ON d.info_date = g.info_date
""")
def join_right_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("info_date"))
    counts = o.groupBy("info_date").agg(F.count(F.lit(1)).alias("orders_cnt"))
    grid = o.agg(F.min("info_date").alias("lo"), F.max("info_date").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("info_date"))
    return counts.join(grid, "info_date", "right").select(
        "info_date", F.coalesce("orders_cnt", F.lit(0)).alias("orders_cnt"))


# --- left anti join: customers with no urgent order
@register("join_anti", """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = (t(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
         .select(F.col("o_custkey").alias("c_custkey")))
    return c.join(o, "c_custkey", "left_anti")


# --- equi join with a range residual; one grant (max) per request (TR-30 shape)
@register("join_range_residual", """
SELECT o.o_orderkey, max(CAST(l.l_shipdate AS DATE)) AS granted_on, CAST(count(*) AS BIGINT) AS grants
FROM orders o JOIN lineitem l
  ON l.l_orderkey = o.o_orderkey AND CAST(l.l_shipdate AS DATE) >= CAST(o.o_orderdate AS DATE) + 60
GROUP BY o.o_orderkey
""")
def join_range_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("created"))
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("granted"))
    cond = (li.l_orderkey == o.o_orderkey) & (li.granted >= F.date_add(o.created, 60))
    return o.join(li, cond, "inner").groupBy("o_orderkey").agg(
        F.max("granted").alias("granted_on"), F.count(F.lit(1)).alias("grants"))


# --- JN-05: external ids -> internal ids through bridge tables
@register("bridge_translate", """
SELECT n.n_name, CAST(count(*) AS BIGINT) AS lines, sum(l.l_quantity) AS quantity
FROM lineitem l JOIN (SELECT DISTINCT s_suppkey, s_nationkey FROM supplier) s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
GROUP BY n.n_name
""")
def bridge_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    x = translate_ids(li, t(spark, sf_dir, "supplier"), "l_suppkey", "s_nationkey", "s_suppkey")
    x = translate_ids(x, t(spark, sf_dir, "nation"), "s_nationkey", "n_name", "n_nationkey")
    return x.groupBy("n_name").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))


# --- JN-06: left joins to candidates and known entities, first entity per request
@register("first_entity_per_request", """
WITH c AS (
  SELECT l.l_orderkey, l.l_suppkey, l.l_linenumber, s.s_suppkey IS NOT NULL AS known
  FROM lineitem l LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey),
r AS (
  SELECT o.o_orderkey, c.l_suppkey AS entity_key, coalesce(c.known, false) AS known,
         row_number() OVER (PARTITION BY o.o_orderkey ORDER BY coalesce(c.known, false) DESC,
                            c.l_suppkey ASC NULLS LAST, c.l_linenumber ASC NULLS LAST) AS rn
  FROM orders o LEFT JOIN c ON c.l_orderkey = o.o_orderkey)
SELECT o_orderkey, entity_key, known FROM r WHERE rn = 1
""")
def first_entity_per_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey")
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    known = t(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0).select("s_suppkey")
    cand = join_small(li, known, li.l_suppkey == known.s_suppkey, "left").select(
        "l_orderkey", "l_suppkey", "l_linenumber", F.col("s_suppkey").isNotNull().alias("known"))
    j = o.join(cand, o.o_orderkey == cand.l_orderkey, "left").select(
        "o_orderkey", F.col("l_suppkey").alias("entity_key"),
        F.coalesce("known", F.lit(False)).alias("known"), "l_linenumber")
    first = first_per_group(j, ["o_orderkey"], [F.col("known").desc(),
                                                 F.col("entity_key").asc_nulls_last(),
                                                 F.col("l_linenumber").asc_nulls_last()])
    return first.select("o_orderkey", "entity_key", "known")


# --- JN-07: drop rows already reviewed (left anti)
@register("exclude_reviewed", """
WITH m AS (SELECT o_custkey AS customer_key, last_day(CAST(o_orderdate AS DATE)) AS info_date,
                  CAST(count(*) AS BIGINT) AS orders_cnt FROM orders GROUP BY 1, 2),
rv AS (SELECT DISTINCT o.o_custkey AS customer_key, last_day(CAST(o.o_orderdate AS DATE)) AS info_date
       FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R')
SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM rv WHERE rv.customer_key = m.customer_key AND rv.info_date = m.info_date)
""")
def exclude_reviewed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_key"),
        F.last_day(F.to_date("o_orderdate")).alias("info_date"))
    m = o.groupBy("customer_key", "info_date").agg(F.count(F.lit(1)).alias("orders_cnt"))
    li = t(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    reviewed = o.join(li, o.o_orderkey == li.l_orderkey).select("customer_key", "info_date")
    return exclude_reviewed(m, reviewed, ["customer_key", "info_date"])
