"""Row-level lookups and categorisations not shown elsewhere (SC-08, SC-11,
SC-25, SC-37, PRJ-08) and the latest report per customer and month from one
source (WN-02). Code lists are the queries' parameters on the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions import lookup as L
from featuremart.functions.arith import sum_fields
from featuremart.operators.broadcast import join_small
from featuremart.operators.columns import columns_with_suffix, to_val_columns
from featuremart.operators.windows import top_n_per_group
from featuremart.plans.inputs import t
from featuremart.plans.registry import register

# Query parameters on the driver tables.
CURRENCY_SYNONYMS = {"LOCAL": "home", "L": "home", "USD": "foreign", "US$": "foreign"}
CARD_CATEGORIES = {"ECONOMY": "classic", "STANDARD": "classic", "MEDIUM": "gold", "LARGE": "platinum",
                   "PROMO": "classic", "SMALL": "classic"}
SIGNATURE_BRAND = "Brand#11"
BUSINESS_BRAND, BUSINESS_TYPE = "Brand#55", "LARGE"
PRODUCT_SHORT_NAMES = {"A": "fixed_term", "N": "savings_plan", "R": "fund"}
LARGE_AMOUNT = 50000


def _currency_text():
    """The currency as the source writes it: spaced, mixed case, one unknown code."""
    return (F.when(F.col("l_suppkey") % 4 == 0, F.lit(" local")).when(F.col("l_suppkey") % 4 == 1, F.lit("L"))
            .when(F.col("l_suppkey") % 4 == 2, F.lit("usd ")).otherwise(F.lit("EUR")))


def _fee(rate_col: str):
    """Price x rate in exact decimals, rounded to cents."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return F.round(price * F.col(rate_col).cast("decimal(18,2)"), 2).cast("decimal(18,2)")


def _currency_text_sql() -> str:
    return ("CASE WHEN l.l_suppkey % 4 = 0 THEN ' local' WHEN l.l_suppkey % 4 = 1 THEN 'L' "
            "WHEN l.l_suppkey % 4 = 2 THEN 'usd ' ELSE 'EUR' END")


# --- SC-25 / SC-11 / SC-37 / SC-08 / PRJ-08: card category from a dictionary with two brand
#     special cases; currency synonyms -> code; threshold flag and product short name; a
#     null-propagating sum of the columns picked by their suffix
@register("card_category_codes", f"""
WITH x AS (
  SELECT l.l_orderkey, l.l_linenumber, p.p_type, p.p_brand, l.l_returnflag, l.l_extendedprice,
         {_currency_text_sql()} AS currency_text,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS tax_fee,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS discount_fee,
         CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE CAST(l.l_quantity AS DECIMAL(18,2)) END AS handling_fee
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
SELECT l_orderkey, l_linenumber,
       CASE WHEN p_brand = '{SIGNATURE_BRAND}' THEN 'signature'
            WHEN p_brand = '{BUSINESS_BRAND}' AND p_type = '{BUSINESS_TYPE}' THEN 'business'
            ELSE coalesce(CASE p_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CARD_CATEGORIES.items())} END, 'unknown')
       END AS card_category,
       coalesce(CASE upper(trim(currency_text)) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CURRENCY_SYNONYMS.items())} END,
                'unknown') AS currency_code,
       CASE WHEN l_extendedprice >= {LARGE_AMOUNT} THEN 1 ELSE 0 END AS large_flag,
       CASE l_returnflag {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRODUCT_SHORT_NAMES.items())} END AS product_short_name,
       CAST(round(tax_fee + discount_fee + handling_fee, 2) AS DECIMAL(19,2)) AS fees_total_val
FROM x
""")
def card_category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    p = t(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    # part grows with the data: broadcast only under the checked bound
    x = join_small(li, p, li.l_partkey == p.p_partkey, "inner").select(
        "l_orderkey", "l_linenumber", "p_type", "p_brand", "l_returnflag", "l_extendedprice",
        _currency_text().alias("currency_text"),
        _fee("l_tax").alias("tax_fee"), _fee("l_discount").alias("discount_fee"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("decimal(18,2)")).alias("handling_fee"))
    category = (F.when(F.col("p_brand") == SIGNATURE_BRAND, F.lit("signature"))
                .when((F.col("p_brand") == BUSINESS_BRAND) & (F.col("p_type") == BUSINESS_TYPE), F.lit("business"))
                .otherwise(L.map_lookup("p_type", CARD_CATEGORIES, default="unknown")))
    fees = columns_with_suffix(x, "_fee")  # PRJ-08: the fee columns, picked by name
    out = x.select("l_orderkey", "l_linenumber", category.alias("card_category"),
                   L.map_lookup("currency_text", CURRENCY_SYNONYMS, default="unknown", normalize=True)
                   .alias("currency_code"),
                   F.when(F.col("l_extendedprice") >= LARGE_AMOUNT, 1).otherwise(0).alias("large_flag"),
                   L.map_lookup("l_returnflag", PRODUCT_SHORT_NAMES).alias("product_short_name"),
                   sum_fields(fees).alias("fees_total"))
    return to_val_columns(out)


# --- WN-02: reports of one source only, the latest per customer and month, the report id
#     breaking ties
REPORT_SOURCES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@register("latest_report_per_month", f"""
SELECT customer_key, report_month, report_key, report_date, report_status FROM (
  SELECT o_custkey AS customer_key, last_day(CAST(o_orderdate AS DATE)) AS report_month, o_orderkey AS report_key,
         CAST(o_orderdate AS DATE) AS report_date, o_orderstatus AS report_status,
         row_number() OVER (PARTITION BY o_custkey, last_day(CAST(o_orderdate AS DATE))
                            ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderpriority IN ({", ".join(f"'{s}'" for s in REPORT_SOURCES)})) WHERE rn = 1
""")
def latest_report_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin(*REPORT_SOURCES))
    r = o.select(F.col("o_custkey").alias("customer_key"),
                 F.last_day(F.to_date("o_orderdate")).alias("report_month"),
                 F.col("o_orderkey").alias("report_key"), F.to_date("o_orderdate").alias("report_date"),
                 F.col("o_orderstatus").alias("report_status"))
    return top_n_per_group(r, ["customer_key", "report_month"], [("report_date", "desc"), ("report_key", "desc")])
