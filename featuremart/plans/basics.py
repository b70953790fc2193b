"""Queries for scans, projections, scalar expressions and set operations
(SRC, PRJ, SC, ST families)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions import dates as D
from featuremart.functions import lookup as L
from featuremart.functions import text as T
from featuremart.operators.columns import (add_suffix, drop_zero_measures, key_columns_first,
                                           label_missing_text, remove_prefix, remove_suffix)
from featuremart.operators.setops import union_missing_as_null
from featuremart.plans.inputs import SEGMENTS, t
from featuremart.plans.registry import register
from featuremart.sources.readers import date_range_filter, rows_per_date, union_tagged


# --- SRC-02: inclusive date range on the stored column (pushed to the scan)
@register("date_range_scan", """
SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
""")
def date_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return date_range_filter(li, "l_shipdate", "1997-01-01", "1998-12-31", out_col="ship_date")


# --- SRC-07 + ST-03: one projection over several tables, tagged, unioned
@register("table_union_tagged", """
SELECT c_custkey AS entity_key, c_name AS entity_name, c_nationkey AS nation_key,
       CAST(c_acctbal AS DECIMAL(18,2)) AS balance, 'customer' AS table_name FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)), 'supplier' FROM supplier
""")
def table_union_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity_key"), F.col("c_name").alias("entity_name"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    supp = t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity_key"), F.col("s_name").alias("entity_name"),
        F.col("s_nationkey").alias("nation_key"), F.col("s_acctbal").cast("decimal(18,2)").alias("balance"))
    return union_tagged({"customer": cust, "supplier": supp},
                        ["entity_key", "entity_name", "nation_key", "balance"])


# --- SRC-06: rows per date of one dataset
@register("rows_per_date", """
SELECT 'orders' AS table_name, CAST(o_orderdate AS DATE) AS info_date, count(*) AS records
FROM orders GROUP BY 2
""")
def rows_per_date_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_date(t(spark, sf_dir, "orders"), "o_orderdate", "orders")


# --- PRJ-01, PRJ-05..07: key columns first, suffix added and removed, prefix stripped
@register("key_columns_first", """
SELECT o_orderkey AS orderkey, o_custkey AS custkey, CAST(o_orderdate AS DATE) AS info_date,
       o_orderstatus AS orderstatus_m, o_totalprice AS totalprice_m, o_orderpriority AS orderpriority_m
FROM orders
""")
def key_columns_first_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    o = remove_prefix(o, "o_").withColumnRenamed("orderdate", "info_date")
    o = add_suffix(o, "month", exclude=["orderkey", "custkey", "info_date"])
    o = remove_suffix(o, "onth")  # ``_month`` -> ``_m``: suffix removal on a suffix part
    return key_columns_first(o, ["info_date", "custkey", "orderkey"])


# --- PRJ-10: null / empty / padded text -> squeezed text or "unknown"
@register("label_missing_text", """
SELECT p_partkey,
       CASE WHEN p_name_raw IS NULL OR trim(regexp_replace(p_name_raw, '\\s+', ' ', 'g')) = '' THEN 'unknown'
            ELSE trim(regexp_replace(p_name_raw, '\\s+', ' ', 'g')) END AS p_name,
       CASE WHEN p_type_raw IS NULL THEN 'unknown' ELSE p_type_raw END AS p_type,
       p_size
FROM (SELECT p_partkey, p_size,
             CASE WHEN p_size % 5 = 0 THEN '   ' ELSE '  ' || replace(p_name, ' ', '   ') || ' ' END AS p_name_raw,
             nullif(p_type, 'ECONOMY') AS p_type_raw
      FROM part)
""")
def label_missing_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part").select(
        "p_partkey", "p_size",
        F.when(F.col("p_size") % 5 == 0, F.lit("   "))
         .otherwise(F.concat(F.lit("  "), F.regexp_replace("p_name", " ", "   "), F.lit(" ")))
         .alias("p_name"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("p_type"))
    return label_missing_text(p, exclude=["p_partkey"])


# --- PRJ-09: drop measures whose total is zero
@register("drop_zero_measures", """
SELECT c_nationkey,
       CAST(count_if(c_mktsegment = 'AUTOMOBILE') AS BIGINT) AS automobile_cnt,
       CAST(count_if(c_mktsegment = 'BUILDING') AS BIGINT) AS building_cnt,
       CAST(count_if(c_mktsegment = 'FURNITURE') AS BIGINT) AS furniture_cnt,
       CAST(count_if(c_mktsegment = 'HOUSEHOLD') AS BIGINT) AS household_cnt,
       CAST(count_if(c_mktsegment = 'MACHINERY') AS BIGINT) AS machinery_cnt
FROM customer GROUP BY c_nationkey
""")
def drop_zero_measures_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    segs = SEGMENTS + ["UNKNOWN SEGMENT"]  # a listed value with no rows -> dropped
    wide = c.groupBy("c_nationkey").agg(*[
        F.count_if(F.col("c_mktsegment") == s).alias(s.lower().replace(" ", "_") + "_cnt")
        for s in segs])
    return drop_zero_measures(wide, [c for c in wide.columns if c.endswith("_cnt")])


# --- SC-01..SC-03: whole years / whole months / days between dates
def _months_sql(a: str, b: str) -> str:
    """Spark's whole-month rule, written out for DuckDB."""
    m = f"((year({a}) - year({b})) * 12 + month({a}) - month({b}))"
    return (f"CASE WHEN ({a} = last_day({a}) AND {b} = last_day({b})) OR day({a}) >= day({b}) "
            f"THEN {m} ELSE {m} - 1 END")


AGE_SQL = f"""
WITH s AS (
  SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_date, max(CAST(l.l_shipdate AS DATE)) AS last_ship
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)
SELECT o_orderkey, order_date, last_ship,
       CAST(greatest({_months_sql('last_ship', 'order_date')}, 0) AS INTEGER) AS months_to_ship,
       CAST(floor(greatest({_months_sql("DATE '2002-01-01'", 'order_date')}, 0) / 12) AS INTEGER) AS years_open,
       CAST(last_ship - order_date AS INTEGER) AS days_to_ship
FROM s
"""


@register("age_in_months_years_days", AGE_SQL)
def age_in_months_years_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    li = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.to_date("l_shipdate")).alias("last_ship"))
    j = o.join(li, o.o_orderkey == li.l_orderkey).drop("l_orderkey")
    return j.select("o_orderkey", "order_date", "last_ship",
                    D.whole_months_between("last_ship", "order_date").alias("months_to_ship"),
                    D.whole_years_between("order_date", F.lit("2002-01-01")).alias("years_open"),
                    D.days_between("order_date", "last_ship").alias("days_to_ship"))


# --- SC-04: hex keys, null stays null
@register("hex_keys", """
SELECT c_custkey, '0x' || hex(c_custkey) AS customer_hex,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE '0x' || hex(c_name) END AS name_hex
FROM customer
""")
def hex_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    return c.select("c_custkey", T.hex_key("c_custkey").alias("customer_hex"),
                    T.hex_key(F.nullif(F.col("c_name"), F.when(F.col("c_mktsegment") == "BUILDING",
                                                                F.col("c_name"))))
                    .alias("name_hex"))


# --- SC-05 / SC-07 / SC-09 / SC-10 / SC-36: dictionary lookups and flags
STATUS_LABELS = {"F": "closed", "O": "open"}
PRIORITY_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}


@register("status_lookup", """
SELECT o_orderkey,
       coalesce(CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' END, 'unknown') AS status_label,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS priority_code,
       CASE WHEN upper(trim(substr(o_orderstatus, 1, 1))) IN ('S','SI','Y','YES','1','A') THEN 1 ELSE 0 END AS status_truthy,
       CAST(coalesce(o_orderstatus IN ('F', 'P'), false) AS INTEGER) AS settled_flag,
       CAST(NOT coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) AS INTEGER) AS not_urgent_flag,
       CASE WHEN o_orderstatus IN ('O') AND o_totalprice > 100000 THEN 1 ELSE 0 END AS open_large_flag
FROM orders
""")
def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        L.map_lookup("o_orderstatus", STATUS_LABELS, default="unknown").alias("status_label"),
        L.map_lookup("o_orderpriority", PRIORITY_CODES).alias("priority_code"),
        T.truthy_flag(F.substring("o_orderstatus", 1, 1)).alias("status_truthy"),
        L.in_list_flag("o_orderstatus", ["F", "P"]).alias("settled_flag"),
        L.in_list_flag("o_orderpriority", ["1-URGENT", "2-HIGH"], negate=True).alias("not_urgent_flag"),
        L.in_list_and_positive("o_orderstatus", ["O"], F.col("o_totalprice") - 100000)
         .alias("open_large_flag"))


# --- SC-14 / SC-15 / SC-31 / SC-30 / SC-22 / SC-16: ordered rule chains
PART_RULES = [
    ("eq", "ECONOMY", "basic"),
    ([("like", "%STANDARD%"), ("like", "%ST%")], "standard"),
    ("contains", "PROMO", "promotion"),
    ("startswith", "LARGE", "large"),
    ("rlike", "^(MEDIUM|SMALL)", "medium_small"),
]
NAME_RULES = [
    ("like", "%ring%", "ring"),
    ("like", "%widget%", "widget"),
]


@register("rule_categories", """
SELECT p_partkey,
       CASE WHEN p_type = 'ECONOMY' THEN 'basic'
            WHEN p_type LIKE '%STANDARD%' AND p_type LIKE '%ST%' THEN 'standard'
            WHEN contains(p_type, 'PROMO') THEN 'promotion'
            WHEN starts_with(p_type, 'LARGE') THEN 'large'
            WHEN regexp_matches(p_type, '^(MEDIUM|SMALL)') THEN 'medium_small'
            ELSE 'other' END AS type_group,
       CASE WHEN p_name LIKE '%ring%' THEN 'ring' WHEN p_name LIKE '%widget%' THEN 'widget' END AS name_group,
       CASE WHEN length(p_brand) >= 2 THEN p_brand WHEN length(p_type) >= 2 THEN p_type
            ELSE p_name END AS last_part,
       CAST(coalesce(p_brand IN ('Brand#1'), false) OR coalesce(p_brand LIKE 'Brand#2%', false) AS INTEGER) AS brand_flag,
       CASE WHEN trim(nullif(p_type, 'ECONOMY')) IS NULL OR trim(nullif(p_type, 'ECONOMY')) IN ('', '-') THEN 'S'
            ELSE trim(nullif(p_type, 'ECONOMY')) END AS type_marker
FROM part
""")
def rule_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        L.rule_chain("p_type", PART_RULES, default="other").alias("type_group"),
        L.rule_chain("p_name", NAME_RULES).alias("name_group"),
        L.last_meaningful("p_name", "p_type", "p_brand").alias("last_part"),
        L.prefix_or_list_flag("p_brand", ["Brand#1"], ["Brand#2"]).alias("brand_flag"),
        L.missing_marker_to(F.nullif(F.col("p_type"), F.lit("ECONOMY")), ["", "-"], "S")
         .alias("type_marker"))


# --- SC-13: slug of whole texts
@register("slug_text", """
WITH s AS (
  SELECT doc_id,
         replace(regexp_replace(regexp_replace(regexp_replace(text, '[^\\p{L}\\p{N} ]+', ' ', 'g'),
                 '^\\s+|\\s+$', '', 'g'), ' {2,}', ' ', 'g'), ' ', '_') AS slug
  FROM documents)
SELECT doc_id, CAST(length(slug) AS INTEGER) AS slug_len, md5(slug) AS slug_md5 FROM s
""")
def slug_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", T.slug("text").alias("slug"))
    return d.select("doc_id", F.length("slug").alias("slug_len"), F.md5("slug").alias("slug_md5"))


# --- SC-12: left pad keeping the rightmost characters
@register("pad_code", """
SELECT s_suppkey,
       right(repeat('0', 4) || CAST(s_nationkey AS VARCHAR), 4) AS nation_code,
       right(repeat('0', 6) || CAST(s_suppkey * 1000 + s_nationkey AS VARCHAR), 6) AS supplier_code
FROM supplier
""")
def pad_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "supplier")
    return s.select("s_suppkey", T.left_pad_keep_right("s_nationkey", 4).alias("nation_code"),
                    T.left_pad_keep_right(F.col("s_suppkey") * 1000 + F.col("s_nationkey"), 6)
                    .alias("supplier_code"))


# --- SC-27: eight-digit text dates, day-first then month-first
@register("dual_format_date", """
WITH s AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN 'x' || strftime(CAST(o_orderdate AS DATE), '%d%m%Y')
              WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%d%m%Y')
              ELSE strftime(CAST(o_orderdate AS DATE), '%m%d%Y') END AS raw_date
  FROM orders)
SELECT o_orderkey, raw_date,
       CASE WHEN length(trim(raw_date)) = 8 THEN coalesce(
         CASE WHEN year(try_strptime(trim(raw_date), '%d%m%Y')) BETWEEN 1900 AND year(current_date)
              THEN CAST(try_strptime(trim(raw_date), '%d%m%Y') AS DATE) END,
         CASE WHEN year(try_strptime(trim(raw_date), '%m%d%Y')) BETWEEN 1900 AND year(current_date)
              THEN CAST(try_strptime(trim(raw_date), '%m%d%Y') AS DATE) END) END AS parsed_date
FROM s
""")
def dual_format_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    raw = (F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("x"), F.date_format(d, "ddMMyyyy")))
            .when(F.col("o_orderkey") % 2 == 0, F.date_format(d, "ddMMyyyy"))
            .otherwise(F.date_format(d, "MMddyyyy")))
    return o.select("o_orderkey", raw.alias("raw_date")).withColumn(
        "parsed_date", D.parse_day_first_date("raw_date"))


# --- ST-01: union by name with missing columns -> null
@register("union_missing_columns", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment,
       NULL::DOUBLE AS s_acctbal FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier
""")
def union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    s = t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), "s_acctbal")
    return union_missing_as_null([c, s])
