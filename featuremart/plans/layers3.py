"""Further layer nodes: leads and exclusions, card-event categories, several
sources with a pivot key, company form with the customer base, branch
operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions import dates as D
from featuremart.functions import lookup as L
from featuremart.functions import text as T
from featuremart.operators import aggregates as A
from featuremart.operators import windows as W
from featuremart.operators.broadcast import join_small
from featuremart.operators.columns import key_columns_first, label_missing_text, to_val_columns
from featuremart.operators.setops import union_same_shape
from featuremart.plans.inputs import t, transactions
from featuremart.plans.registry import register


# --- CL-23 / CL-52: leads full join exclusions (hex keys, SI/NO flag, labelled text)
@register("leads_with_exclusions", """
WITH ex AS (SELECT '0x' || hex(c_custkey) AS customer, c_nationkey AS exclusion_reason,
                   CASE WHEN (CASE WHEN c_mktsegment = 'BUILDING' THEN 'SI' ELSE 'NO' END) = 'SI' THEN 1 ELSE 0 END AS exclusion_flag
            FROM customer),
ld AS (SELECT '0x' || hex(o_custkey) AS customer, CAST(o_orderdate AS DATE) AS lead_start,
              CAST(o_orderdate AS DATE) + 90 AS lead_end, CAST(o_totalprice AS DECIMAL(18,2)) AS pre_approved,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS lead_channel
       FROM orders)
SELECT coalesce(ld.customer, ex.customer) AS customer, ex.exclusion_reason, ex.exclusion_flag,
       ld.lead_start, ld.lead_end, CAST(round(ld.pre_approved, 2) AS DECIMAL(19,2)) AS pre_approved_val,
       CASE WHEN ld.lead_channel IS NULL OR trim(ld.lead_channel) = '' THEN 'unknown' ELSE ld.lead_channel END AS lead_channel
FROM ld FULL JOIN ex ON ld.customer = ex.customer
""")
def leads_with_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    excl_text = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("SI")).otherwise(F.lit("NO"))
    ex = c.select(T.hex_key("c_custkey").alias("customer"), F.col("c_nationkey").alias("exclusion_reason"),
                  F.when(excl_text == "SI", 1).otherwise(0).alias("exclusion_flag"))
    o = t(spark, sf_dir, "orders")
    ld = o.select(T.hex_key("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("lead_start"),
                  F.date_add(F.to_date("o_orderdate"), 90).alias("lead_end"),
                  F.col("o_totalprice").cast("decimal(18,2)").alias("pre_approved"),
                  F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("lead_channel"))
    j = ld.join(ex, "customer", "full")
    out = label_missing_text(to_val_columns(j), exclude=["customer"])
    return key_columns_first(out, ["customer"])


# --- CL-01: card events: category by nested rules, network, purchase kind
@register("card_event_categories", """
SELECT l.l_orderkey, l.l_linenumber,
       CASE WHEN l.l_quantity > 40 THEN CASE WHEN contains(p.p_type, 'PROMO') THEN 'bulk_promo' ELSE 'bulk' END
            WHEN p.p_type IN ('SMALL', 'MEDIUM') THEN CASE WHEN l.l_discount >= 0.05 THEN 'discounted' ELSE 'regular' END
            ELSE 'other' END AS category,
       CASE substr(CAST(l.l_suppkey AS VARCHAR), 1, 1) WHEN '4' THEN 'network_a' WHEN '5' THEN 'network_b' ELSE 'network_other' END AS network,
       CASE WHEN l.l_linestatus = 'F' THEN 'in_person' ELSE 'remote' END AS purchase_kind
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""")
def card_event_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    p = t(spark, sf_dir, "part").select("p_partkey", "p_type")
    x = li.join(p, li.l_partkey == p.p_partkey)
    bulk = L.rule_chain("p_type", [("contains", "PROMO", "bulk_promo")], default="bulk")
    small = F.when(F.col("l_discount") >= 0.05, F.lit("discounted")).otherwise(F.lit("regular"))
    category = (F.when(F.col("l_quantity") > 40, bulk)
                .when(F.col("p_type").isin("SMALL", "MEDIUM"), small).otherwise(F.lit("other")))
    network = L.map_lookup(F.substring(F.col("l_suppkey").cast("string"), 1, 1),
                           {"4": "network_a", "5": "network_b"}, default="network_other")
    return x.select("l_orderkey", "l_linenumber", category.alias("category"), network.alias("network"),
                    F.when(F.col("l_linestatus") == "F", F.lit("in_person")).otherwise(F.lit("remote"))
                    .alias("purchase_kind"))


# --- CL-09 / SC-35 / ST-02: several sources, one shape, pivot key from two lookups
MODULES = {"purchase": "payments", "click": "transfers", "view": "queries", "signup": "enrolment",
           "error": "incidents"}
OPERATIONS = {"purchase": "card", "click": "ach", "view": "balance"}
MODULE_ONLY = ["signup", "error"]


@register("sources_pivot_key", """
WITH u AS (SELECT user_id AS customer_key, event_type, CAST(value AS DECIMAL(18,2)) AS amount FROM events),
k AS (SELECT customer_key, amount,
             CASE event_type WHEN 'purchase' THEN 'payments' WHEN 'click' THEN 'transfers' WHEN 'view' THEN 'queries'
                             WHEN 'signup' THEN 'enrolment' WHEN 'error' THEN 'incidents' END AS module,
             CASE WHEN event_type IN ('signup', 'error') THEN NULL
                  ELSE CASE event_type WHEN 'purchase' THEN 'card' WHEN 'click' THEN 'ach' WHEN 'view' THEN 'balance' END END AS operation
      FROM u)
SELECT customer_key, concat_ws('_', module, operation) AS pivot_key, CAST(count(*) AS BIGINT) AS operations,
       CAST(round(sum(amount), 2) AS DECIMAL(19,2)) AS amount_val
FROM k GROUP BY 1, 2
""")
def sources_pivot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the lookups tell the sources apart, so one pass reads them all; an event type without a
    # module keeps its rows under an empty key
    u = t(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_key"), "event_type",
        F.col("value").cast("decimal(18,2)").alias("amount"))
    module = L.map_lookup("event_type", MODULES)
    operation = F.when(~F.col("event_type").isin(*MODULE_ONLY), L.map_lookup("event_type", OPERATIONS))
    k = u.select("customer_key", "amount", L.compound_key(module, operation).alias("pivot_key"))
    return to_val_columns(k.groupBy("customer_key", "pivot_key").agg(
        F.count(F.lit(1)).alias("operations"), F.sum("amount").alias("amount")))


# --- CL-39 / TR-15 / TR-18: company form ranked newest first, newest kept, customer base
#     with form and employee flag by left joins
@register("customer_base_with_form", """
WITH f AS (SELECT o_custkey AS customer_key, o_orderkey, o_orderstatus AS form,
                  CAST(o_orderdate AS DATE) AS registered, CAST(o_orderdate AS DATE) + 30 AS updated,
                  strftime(CAST(o_orderdate AS DATE), '%d%m%Y') AS raw_date FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY customer_key ORDER BY greatest(registered, updated) DESC, o_orderkey DESC) AS rk FROM f),
newest AS (SELECT customer_key, form, CAST(try_strptime(raw_date, '%d%m%Y') AS DATE) AS form_date FROM r WHERE rk = 1),
emp AS (SELECT DISTINCT s_suppkey AS customer_key, 1 AS employee_flag FROM supplier)
SELECT c.c_custkey AS customer_key, c.c_mktsegment AS segment, coalesce(n.form, 'none') AS company_form,
       n.form_date, coalesce(e.employee_flag, 0) AS employee_flag
FROM customer c LEFT JOIN newest n ON n.customer_key = c.c_custkey LEFT JOIN emp e ON e.customer_key = c.c_custkey
""")
def customer_base_with_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), "o_orderkey", F.col("o_orderstatus").alias("form"),
        F.to_date("o_orderdate").alias("registered"), F.date_add(F.to_date("o_orderdate"), 30).alias("updated"),
        F.date_format(F.to_date("o_orderdate"), "ddMMyyyy").alias("raw_date"))
    newest = W.top_n_per_group(o, ["customer_key"], [(F.greatest("registered", "updated"), "desc"),
                                                     ("o_orderkey", "desc")]).select(
        "customer_key", "form", D.parse_day_first_date("raw_date", max_year=9999).alias("form_date"))
    emp = (t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("customer_key")).distinct()
           .withColumn("employee_flag", F.lit(1)))
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"),
                                            F.col("c_mktsegment").alias("segment"))
    j = c.join(newest, "customer_key", "left").join(emp, "customer_key", "left")
    return j.select("customer_key", "segment", F.coalesce("form", F.lit("none")).alias("company_form"),
                    "form_date", F.coalesce("employee_flag", F.lit(0)).alias("employee_flag"))


# --- TR-39 / CL-43 / CL-44: branch operations with a padded branch catalog, totals,
#     pivot by product, last branch seen (max_by instead of an unordered ``last``)
@register("branch_operations", """
WITH x AS (SELECT o.o_custkey AS customer_key, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, p.p_type,
                  right(repeat('0', 5) || CAST(s.s_nationkey AS VARCHAR), 5) AS branch_code,
                  CAST(l.l_shipdate AS DATE) AS d, last_day(CAST(l.l_shipdate AS DATE)) AS m, l.l_orderkey, l.l_linenumber
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
                JOIN supplier s ON s.s_suppkey = l.l_suppkey),
lastb AS (SELECT customer_key, m, branch_code AS last_branch FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_key, m ORDER BY d DESC, l_orderkey DESC, l_linenumber DESC, branch_code DESC) AS rn
            FROM x) WHERE rn = 1)
SELECT x.customer_key, x.m AS _observ_end_dt, CAST(count(*) AS BIGINT) AS operations_cnt, CAST(round(sum(amount), 2) AS DECIMAL(19,2)) AS total_val,
       CAST(round(coalesce(sum(CASE WHEN p_type = 'PROMO' THEN amount END), 0), 2) AS DECIMAL(19,2)) AS promo_val,
       CAST(round(coalesce(sum(CASE WHEN p_type = 'STANDARD' THEN amount END), 0), 2) AS DECIMAL(19,2)) AS standard_val,
       CAST(round(coalesce(sum(CASE WHEN p_type = 'ECONOMY' THEN amount END), 0), 2) AS DECIMAL(19,2)) AS economy_val,
       CAST(round(coalesce(sum(CASE WHEN p_type = 'LARGE' THEN amount END), 0), 2) AS DECIMAL(19,2)) AS large_val,
       CAST(round(coalesce(sum(CASE WHEN p_type = 'MEDIUM' THEN amount END), 0), 2) AS DECIMAL(19,2)) AS medium_val,
       CAST(round(coalesce(sum(CASE WHEN p_type = 'SMALL' THEN amount END), 0), 2) AS DECIMAL(19,2)) AS small_val,
       CAST(count(DISTINCT branch_code) AS BIGINT) AS branches_cnt, min(lastb.last_branch) AS last_branch
FROM x JOIN lastb USING (customer_key, m) GROUP BY 1, 2
""")
def branch_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = transactions(spark, sf_dir)
    p = t(spark, sf_dir, "part").select("p_partkey", "p_type")
    branches = t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey"), T.left_pad_keep_right("s_nationkey", 5).alias("branch_code"))
    x = x.join(p, x.l_partkey == p.p_partkey)
    x = join_small(x, branches, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
    order = F.struct("trx_date", "l_orderkey", "l_linenumber", "branch_code")
    g = x.groupBy("customer_key", F.last_day("trx_date").alias("_observ_end_dt")).agg(
        F.count(F.lit(1)).alias("operations_cnt"), F.sum("amount").alias("total"),
        *A.pivot_aggs("p_type", ["PROMO", "STANDARD", "ECONOMY", "LARGE", "MEDIUM", "SMALL"], {"": ("sum", "amount")}, name_fmt="{value}"),
        F.count_distinct("branch_code").alias("branches_cnt"),
        F.max_by("branch_code", order).alias("last_branch"))
    return to_val_columns(g)
