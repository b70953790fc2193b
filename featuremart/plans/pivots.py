"""Pivot and aggregation queries (AG family, TR-03 / TR-33 shapes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions.arith import matching_columns
from featuremart.functions.lookup import map_lookup
from featuremart.operators.aggregates import (any_flag, bucket, first_by_condition,
                                              half_count_pairs, horizontal_total, pivot_aggs,
                                              pivot_measures, worst_grade_pivot)
from featuremart.operators.broadcast import join_small
from featuremart.operators.columns import drop_zero_measures, to_val_columns
from featuremart.plans.inputs import PRIORITIES, STATUSES, TRANSACTIONS_SQL, t, transactions
from featuremart.plans.registry import register


def _val(expr: str, alias: str) -> str:
    return f"CAST(round({expr}, 2) AS DECIMAL(19,2)) AS {alias}"


def _cnt(cond: str, alias: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT) AS {alias}"


def _pname(v: str) -> str:
    return v.strip().lower().replace(" ", "_").replace("-", "_")


# --- AG-03 / AG-05 / AG-06: count + sum per category, explicit values, nulls -> 0
_PCS = ",\n       ".join(
    f"{_cnt(f'o_orderpriority = {chr(39)}{p}{chr(39)}', 'priority_' + _pname(p) + '_cnt')}, "
    + _val(f"coalesce(sum(CASE WHEN o_orderpriority = '{p}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0)",
           'priority_' + _pname(p) + "_amount_val") for p in PRIORITIES)


@register("pivot_counts_sums", f"""
SELECT o_custkey AS customer_key,
       {_PCS}
FROM orders GROUP BY o_custkey
""")
def pivot_counts_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_key"), "o_orderpriority",
                                          F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    p = pivot_measures(o, ["customer_key"], "o_orderpriority", PRIORITIES,
                       {"cnt": ("count", None), "amount": ("sum", "total")},
                       name_fmt="priority_{value}_{measure}")
    return to_val_columns(p)


# --- TR-03 shape: six measures per kind, zero columns dropped, max flag
SIX_KINDS = ["A", "N", "R", "X"]  # "X" never occurs: its columns are dropped


def _six_sql() -> str:
    parts = []
    for k in ["a", "n", "r"]:
        K = k.upper()
        hit = f"kind = '{K}'"
        parts += [
            _cnt(hit, f"{k}_cnt"),
            _val(f"coalesce(sum(CASE WHEN {hit} THEN amount END), 0)", f"{k}_amount_val"),
            _val(f"max(CASE WHEN {hit} THEN amount END)", f"{k}_max_amount_val"),
            _val(f"min(CASE WHEN {hit} THEN amount END)", f"{k}_min_amount_val"),
            _val(f"coalesce(sum(CASE WHEN {hit} THEN l_quantity END), 0)", f"{k}_quantity_val"),
            f"CAST(count(DISTINCT CASE WHEN {hit} THEN l_orderkey END) AS BIGINT) AS {k}_orders",
        ]
    return ",\n       ".join(parts)


@register("pivot_six_measures", f"""
WITH x AS ({TRANSACTIONS_SQL})
SELECT customer_key, account_key, last_day(trx_date) AS info_date,
       {_six_sql()},
       CAST(max(CASE WHEN kind = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS returned_flag
FROM x GROUP BY 1, 2, 3
""")
def pivot_six_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = transactions(spark, sf_dir).withColumn("info_date", F.last_day("trx_date"))
    keys = ["customer_key", "account_key", "info_date"]
    # Level 1 per (keys, kind, order): distinct orders become plain counts in
    # level 2, so no Expand (one copy of every row per distinct aggregate).
    lvl1 = x.groupBy(*keys, "kind", "l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"),
        F.max("amount").alias("max_amount"), F.min("amount").alias("min_amount"),
        F.sum("l_quantity").alias("quantity"))
    measures = {"cnt": ("sum", "n"), "amount": ("sum", "amount"), "max_amount": ("max", "max_amount"),
                "min_amount": ("min", "min_amount"), "quantity": ("sum", "quantity"),
                "orders": ("count", None)}
    wide = lvl1.groupBy(*keys).agg(*pivot_aggs("kind", SIX_KINDS, measures),
                                   any_flag(F.col("kind") == "R").alias("returned_flag"))
    measure_cols = [c for c in wide.columns if c.startswith("x_")]
    # a kind without movements has all its columns zero: its movements are counted in a scan of
    # the kind column alone, the wide table is not evaluated for it
    count = F.count_if(F.col("l_returnflag") == "X")
    totals = t(spark, sf_dir, "lineitem").agg(*[count.alias(c) for c in measure_cols])
    return to_val_columns(drop_zero_measures(wide, measure_cols, totals))


# --- AG-04 / AG-07: horizontal totals over pivoted columns chosen by name
@register("horizontal_totals", f"""
WITH p AS (
  SELECT o_custkey AS customer_key,
         {", ".join(f"{_cnt(chr(39).join(['o_orderpriority = ', p, '']), '_' + _pname(p) + '_cnt')}" for p in PRIORITIES)},
         {", ".join(f"coalesce(sum(CASE WHEN o_orderpriority = '{p}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS _{_pname(p)}_amount" for p in PRIORITIES)}
  FROM orders GROUP BY 1)
SELECT customer_key,
       CAST(_1_urgent_cnt + _2_high_cnt + _3_medium_cnt + _4_not_specified_cnt AS BIGINT) AS kept_cnt,
       {_val("_1_urgent_amount + _2_high_amount + _3_medium_amount + _4_not_specified_amount", "kept_amount_val")},
       {_val("_1_urgent_amount + _2_high_amount", "urgent_high_amount_val")}
FROM p
""")
def horizontal_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_key"), "o_orderpriority",
                                          F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    p = pivot_measures(o, ["customer_key"], "o_orderpriority", PRIORITIES,
                       {"cnt": ("count", None), "amount": ("sum", "total")}, name_fmt="_{value}_{measure}")
    # totals exclude the low-priority category; a second total picks by fixed part + variants
    kept = [c for c in p.columns if c.endswith("_cnt") and "low" not in c]
    p = horizontal_total(p, "kept_cnt", kept)
    p = horizontal_total(p, "kept_amount", [c for c in p.columns if c.endswith("_amount") and "low" not in c])
    p = horizontal_total(p, "urgent_high_amount", matching_columns(p.columns, "_amount", ["urgent", "high"]))
    return to_val_columns(p.select("customer_key", "kept_cnt", "kept_amount", "urgent_high_amount"))


# --- AG-18 / AG-19: pivot on a numeric bucket (30-day cycles, overflow bucket)
BUCKETS = [0, 30, 60, 90, 120, 150, 180, 210, 240]


@register("pivot_numeric_buckets", f"""
WITH x AS (
  SELECT o.o_custkey AS customer_key, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(floor((CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) / 30) AS BIGINT) AS cycles
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
b AS (SELECT customer_key, amount, CASE WHEN cycles > 7 THEN 240 ELSE cycles * 30 END AS days_bucket FROM x)
SELECT customer_key,
       {", ".join(_cnt(f"days_bucket = {b}", f"d{b}_cnt") + ", " + _val(f"coalesce(sum(CASE WHEN days_bucket = {b} THEN amount END), 0)", f"d{b}_amount_val") for b in BUCKETS)}
FROM b GROUP BY 1
""")
def pivot_numeric_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("od"))
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("sd"),
                                             F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    x = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("customer_key"), "amount",
        bucket(F.floor(F.datediff("sd", "od") / 30), 30, 7).alias("days_bucket"))
    p = pivot_measures(x, ["customer_key"], "days_bucket", BUCKETS,
                       {"cnt": ("count", None), "amount": ("sum", "amount")}, name_fmt="d{value}_{measure}")
    return to_val_columns(p)


# --- AG-11 / AG-12 / AG-13: rows reported once per currency count as ceil(n/2)
@register("half_count_pairs", f"""
WITH x AS ({TRANSACTIONS_SQL}),
f AS (SELECT customer_key, l_suppkey, amount, coalesce(direction = 'O', false) AS pair, count(*) AS n
      FROM x GROUP BY 1, 2, 3, 4),
g AS (SELECT *, CAST(CASE WHEN pair THEN ceil(n / 2.0) ELSE n END AS BIGINT) AS c FROM f)
SELECT customer_key, CAST(sum(c) AS BIGINT) AS debt_cnt, {_val("sum(amount * c)", "limit_amount_val")}
FROM g GROUP BY 1
""")
def half_count_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = transactions(spark, sf_dir)
    out = half_count_pairs(x, ["customer_key"], "l_suppkey", "amount", F.col("direction") == "O")
    return to_val_columns(out)


# --- AG-17: deterministic "first value where cond", sums and max flags
@register("first_by_condition", f"""
WITH x AS (SELECT *, last_day(trx_date) AS info_date FROM ({TRANSACTIONS_SQL})),
h AS (SELECT customer_key, account_key, info_date, amount AS last_home,
             row_number() OVER (PARTITION BY customer_key, account_key, info_date
                                ORDER BY trx_date DESC, l_orderkey DESC, l_linenumber DESC, amount DESC) AS rn
      FROM x WHERE currency_id = 1),
f AS (SELECT customer_key, account_key, info_date, amount AS last_foreign,
             row_number() OVER (PARTITION BY customer_key, account_key, info_date
                                ORDER BY trx_date DESC, l_orderkey DESC, l_linenumber DESC, amount DESC) AS rn
      FROM x WHERE currency_id = 2),
g AS (SELECT customer_key, account_key, info_date, sum(amount) AS total,
             CAST(max(CASE WHEN kind = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS returned_flag
      FROM x GROUP BY 1, 2, 3)
SELECT g.customer_key, g.account_key, g.info_date, {_val("g.total", "total_val")}, g.returned_flag,
       {_val("h.last_home", "last_home_val")}, {_val("f.last_foreign", "last_foreign_val")}
FROM g LEFT JOIN h ON h.rn = 1 AND h.customer_key = g.customer_key AND h.account_key = g.account_key AND h.info_date = g.info_date
       LEFT JOIN f ON f.rn = 1 AND f.customer_key = g.customer_key AND f.account_key = g.account_key AND f.info_date = g.info_date
""")
def first_by_condition_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = transactions(spark, sf_dir).withColumn("info_date", F.last_day("trx_date"))
    order = F.struct("trx_date", "l_orderkey", "l_linenumber", "amount")
    out = x.groupBy("customer_key", "account_key", "info_date").agg(
        F.sum("amount").alias("total"), any_flag(F.col("kind") == "R").alias("returned_flag"),
        first_by_condition(F.col("currency_id") == 1, "amount", order).alias("last_home"),
        first_by_condition(F.col("currency_id") == 2, "amount", order).alias("last_foreign"))
    return to_val_columns(out)


# --- AG-15 / AG-16: worst grade per key pivoted by category, described from a catalog
@register("worst_grade_pivot", """
WITH o AS (SELECT o_custkey AS customer_key, o_orderstatus, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS grade FROM orders),
p AS (SELECT customer_key,
             max(CASE WHEN o_orderstatus = 'F' THEN grade END) AS f_worst_grade,
             max(CASE WHEN o_orderstatus = 'O' THEN grade END) AS o_worst_grade,
             max(CASE WHEN o_orderstatus = 'P' THEN grade END) AS p_worst_grade
      FROM o GROUP BY 1),
cat AS (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS grade, o_orderpriority AS grade_desc FROM orders)
SELECT p.*, cat.grade_desc AS f_worst_desc FROM p LEFT JOIN cat ON cat.grade = p.f_worst_grade
""")
def worst_grade_pivot_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), "o_orderstatus", "o_orderpriority",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("grade"))
    p = worst_grade_pivot(o, ["customer_key"], "o_orderstatus", STATUSES, "grade")
    cat = o.select(F.col("grade").alias("cat_grade"), F.col("o_orderpriority").alias("f_worst_desc")).distinct()
    return join_small(p, cat, F.col("f_worst_grade") == F.col("cat_grade"), "left").drop("cat_grade")


# --- TR-33: worst state by precedence
STATE_PRECEDENCE = {"F": 1, "O": 2, "P": 3}
STATE_BY_RANK = {v: k for k, v in STATE_PRECEDENCE.items()}


@register("precedence_state", """
SELECT o_custkey AS customer_key, last_day(CAST(o_orderdate AS DATE)) AS info_date,
       CASE max(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END)
            WHEN 1 THEN 'F' WHEN 2 THEN 'O' WHEN 3 THEN 'P' END AS worst_state,
       CAST(count(*) AS BIGINT) AS orders_cnt
FROM orders GROUP BY 1, 2
""")
def precedence_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    g = o.groupBy(F.col("o_custkey").alias("customer_key"),
                  F.last_day(F.to_date("o_orderdate")).alias("info_date")).agg(
        F.max(map_lookup("o_orderstatus", STATE_PRECEDENCE)).alias("rank"),
        F.count(F.lit(1)).alias("orders_cnt"))
    return g.select("customer_key", "info_date", map_lookup("rank", STATE_BY_RANK).alias("worst_state"),
                    "orders_cnt")
