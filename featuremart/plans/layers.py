"""Layer nodes recast on the driver tables: cleaning (CL), transformation
(TR) and integration (IN) shapes, each a composition of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions import dates as D
from featuremart.functions import lookup as L
from featuremart.functions.arith import matching_columns
from featuremart.operators import aggregates as A
from featuremart.operators import windows as W
from featuremart.operators.columns import (fill_numeric_zero, remove_prefix, remove_suffix,
                                           to_val_columns)
from featuremart.operators.joins import fact_join
from featuremart.operators.setops import union_missing_as_null, union_same_shape
from featuremart.plans.inputs import t, transactions
from featuremart.plans.registry import register

MONTH = ["customer_key", "_observ_end_dt"]


def _val(expr: str, alias: str) -> str:
    return f"CAST(round({expr}, 2) AS DECIMAL(19,2)) AS {alias}"


def _cnt(cond: str, alias: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT) AS {alias}"


# --- TR-19 / TR-20 / CL-05 / CL-06: login flags and last login per customer and month
@register("login_flags", """
WITH b AS (SELECT c_custkey AS user_id, c_custkey AS customer_key FROM customer),
e AS (SELECT b.customer_key, CAST(ts AS DATE) AS d, last_day(CAST(ts AS DATE)) AS _observ_end_dt, event_type
      FROM events JOIN b USING (user_id)),
web AS (SELECT customer_key, _observ_end_dt,
               CAST(max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS INTEGER) AS web_login_flag,
               CASE WHEN max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) > 0
                    THEN max(CASE WHEN event_type = 'view' THEN d END) END AS web_last_login,
               1 AS has_web_flag
        FROM e GROUP BY 1, 2),
app AS (SELECT customer_key, _observ_end_dt, 1 AS app_login_flag, max(d) AS app_last_login
        FROM e WHERE event_type LIKE '%sign%' OR event_type LIKE '%click%' GROUP BY 1, 2)
SELECT web.customer_key, web._observ_end_dt, web.web_login_flag, web.web_last_login, web.has_web_flag,
       coalesce(app.app_login_flag, 0) AS app_login_flag, app.app_last_login
FROM web LEFT JOIN app USING (customer_key, _observ_end_dt)
""")
def login_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"),
                                                 F.col("c_custkey").alias("customer_key"))
    ev = t(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("d"))
    e = ev.join(bridge, "user_id").withColumn("_observ_end_dt", F.last_day("d"))
    is_view = F.col("event_type") == "view"
    web = e.groupBy(*MONTH).agg(
        A.any_flag(is_view).alias("web_login_flag"),
        F.when(A.any_flag(is_view) > 0, F.max(F.when(is_view, F.col("d")))).alias("web_last_login"),
        F.lit(1).alias("has_web_flag"))
    app = (e.where(F.col("event_type").like("%sign%") | F.col("event_type").like("%click%"))
           .groupBy(*MONTH).agg(F.lit(1).alias("app_login_flag"), F.max("d").alias("app_last_login")))
    out = web.join(app, MONTH, "left")
    return out.withColumn("app_login_flag", F.coalesce("app_login_flag", F.lit(0)))


# --- TR-09 / CL-16 / SC-23: arrears from cycles, flags, balances in arrears
STATUS_GROUPS = {"F": "settled", "O": "current", "P": "in_arrears"}


def card_account_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card movements joined to their accounts (one shuffle of each side),
    with arrears cycles turned into days (CL-16)."""
    li = t(spark, sf_dir, "lineitem")
    o = t(spark, sf_dir, "orders")
    return fact_join(li, o).select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"),
        F.last_day(F.to_date("l_shipdate")).alias("_observ_end_dt"), "o_orderstatus",
        F.col("l_linestatus").alias("direction"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        (F.floor(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")) / 30).cast("int") * 30)
        .alias("arrears_days"),
        F.round(F.col("l_discount") * 100).cast("int").alias("promo_days"))


def card_account_aggs() -> list:
    """TR-06 / TR-09 measures per account and month, as aggregate expressions
    so a caller can compute them in the same pass as its own."""
    days = F.col("arrears_days")
    return [L.map_lookup(F.max("o_orderstatus"), STATUS_GROUPS, default="unknown").alias("status_group"),
            A.any_flag(days >= 30).alias("arrears_30_flag"),
            A.any_flag(days >= 60).alias("arrears_60_flag"),
            A.any_flag(days >= 90).alias("arrears_90_flag"),
            F.coalesce(A.sum_if(days >= 30, "amount"), F.lit(0)).alias("arrears_balance"),
            F.sum("amount").alias("balance"),
            F.max(F.greatest("arrears_days", "promo_days")).alias("max_arrears_days")]


@register("card_account_features", f"""
WITH x AS (
  SELECT o.o_custkey AS customer_key, o.o_orderpriority AS account_key,
         last_day(CAST(l.l_shipdate AS DATE)) AS _observ_end_dt, o.o_orderstatus,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(floor((CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE)) / 30) AS INTEGER) * 30 AS arrears_days,
         CAST(round(l.l_discount * 100) AS INTEGER) AS promo_days
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT customer_key, account_key, _observ_end_dt,
       coalesce(CASE max(o_orderstatus) WHEN 'F' THEN 'settled' WHEN 'O' THEN 'current' WHEN 'P' THEN 'in_arrears' END, 'unknown') AS status_group,
       CAST(max(CASE WHEN arrears_days >= 30 THEN 1 ELSE 0 END) AS INTEGER) AS arrears_30_flag,
       CAST(max(CASE WHEN arrears_days >= 60 THEN 1 ELSE 0 END) AS INTEGER) AS arrears_60_flag,
       CAST(max(CASE WHEN arrears_days >= 90 THEN 1 ELSE 0 END) AS INTEGER) AS arrears_90_flag,
       {_val("coalesce(sum(CASE WHEN arrears_days >= 30 THEN amount END), 0)", "arrears_balance_val")},
       {_val("sum(amount)", "balance_val")},
       max(greatest(arrears_days, promo_days)) AS max_arrears_days
FROM x GROUP BY 1, 2, 3
""")
def card_account_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = card_account_facts(spark, sf_dir).groupBy("customer_key", "account_key", "_observ_end_dt") \
        .agg(*card_account_aggs())
    return to_val_columns(g)


# --- TR-13 / TR-42 / CL-20 / CL-46: direction x currency sums, kind pivot from text, channel pivot
CHANNELS = [1, 2, 3]


@register("movement_pivots", f"""
WITH x AS (
  SELECT o.o_custkey AS customer_key, last_day(CAST(l.l_shipdate AS DATE)) AS _observ_end_dt,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, l.l_linestatus AS direction, l.l_linenumber AS channel,
         CASE WHEN l.l_suppkey % 2 = 0 THEN 1 ELSE 2 END AS currency_id,
         regexp_split_to_array('MV' || CASE WHEN l.l_linestatus = 'F' THEN '+' ELSE '-' END || l.l_returnflag, '[+-]')[2] AS kind
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT customer_key, _observ_end_dt,
       {_cnt("direction = 'F' AND currency_id = 1", "credit_home_cnt")}, {_val("coalesce(sum(CASE WHEN direction = 'F' AND currency_id = 1 THEN amount END), 0)", "credit_home_val")},
       {_cnt("direction = 'F' AND currency_id = 2", "credit_foreign_cnt")}, {_val("coalesce(sum(CASE WHEN direction = 'F' AND currency_id = 2 THEN amount END), 0)", "credit_foreign_val")},
       {_cnt("direction = 'O' AND currency_id = 1", "debit_home_cnt")}, {_val("coalesce(sum(CASE WHEN direction = 'O' AND currency_id = 1 THEN amount END), 0)", "debit_home_val")},
       {_cnt("direction = 'O' AND currency_id = 2", "debit_foreign_cnt")}, {_val("coalesce(sum(CASE WHEN direction = 'O' AND currency_id = 2 THEN amount END), 0)", "debit_foreign_val")},
       {_cnt("kind = 'A'", "kind_a_cnt")}, {_cnt("kind = 'N'", "kind_n_cnt")}, {_cnt("kind = 'R'", "kind_r_cnt")},
       {", ".join(_val(f"coalesce(sum(CASE WHEN channel = {c} THEN amount END), 0)", f"channel_{c}_val") for c in CHANNELS)}
FROM x GROUP BY 1, 2
""")
def movement_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = transactions(spark, sf_dir).select(
        "customer_key", F.last_day("trx_date").alias("_observ_end_dt"), "amount", "direction",
        F.col("l_linenumber").alias("channel"), "currency_id",
        # movement text "MV<sign><kind>": the kind is the text after the sign (CL-46)
        F.get(F.split(F.concat(F.lit("MV"), F.when(F.col("direction") == "F", F.lit("+"))
                                .otherwise(F.lit("-")), F.col("kind")), "[+-]"), 1).alias("kind"))
    aggs = []
    for dname, d in [("credit", "F"), ("debit", "O")]:
        for cname, c in [("home", 1), ("foreign", 2)]:
            cond = (F.col("direction") == d) & (F.col("currency_id") == c)
            aggs += [A.count_if(cond).alias(f"{dname}_{cname}_cnt"),
                     F.coalesce(A.sum_if(cond, "amount"), F.lit(0)).alias(f"{dname}_{cname}")]
    aggs += A.pivot_aggs("kind", ["A", "N", "R"], {"cnt": ("count", None)}, name_fmt="kind_{value}_{measure}")
    aggs += A.pivot_aggs("channel", CHANNELS, {"amount": ("sum", "amount")}, name_fmt="channel_{value}")
    return to_val_columns(x.groupBy(*MONTH).agg(*aggs))


# --- CL-41 / IN-14 / SC-36 / AG-07 / AG-08 / AG-09: loans cleaned (select, status
#     lookup), loan features and their node entry, rolled up per customer and month
LOAN_STATUS_MERGE = {"F": "closed", "O": "open", "P": "open"}
LOAN_PRODUCTS = ["p1", "p2", "p3", "p4", "p5"]
LOAN_KEYS = [f"{p}_{s}" for p in LOAN_PRODUCTS for s in ["closed", "open"]]


def _loan_sql() -> str:
    piv = ", ".join(_cnt(f"product_status = '{k}'", f"{k}_cnt") for k in LOAN_KEYS)
    return f"""
WITH o AS (
  SELECT o_custkey AS customer_key, last_day(CAST(o_orderdate AS DATE)) AS _observ_end_dt, o_orderkey,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS grade,
         'p' || substr(o_orderpriority, 1, 1) || '_' || CASE o_orderstatus WHEN 'F' THEN 'closed' ELSE 'open' END AS product_status,
         o_orderstatus, CAST(o_orderdate AS DATE) AS d,
         CAST(NOT coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) AS INTEGER) AS late_bucket_flag
  FROM orders),
w AS (SELECT customer_key, _observ_end_dt, o_orderkey AS worst_loan FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_key, _observ_end_dt ORDER BY grade DESC, o_orderkey DESC) AS rn FROM o)
      WHERE rn = 1),
g AS (SELECT customer_key, _observ_end_dt, {_val("sum(amount)", "loans_val")}, CAST(count(*) AS BIGINT) AS loans_cnt,
             {piv},
             CAST(max(CASE WHEN o_orderstatus = 'O' AND d <= CAST(date_trunc('month', d) AS DATE) + 14 THEN 1 ELSE 0 END) AS INTEGER) AS credit_line_flag,
             CAST(max(late_bucket_flag) AS INTEGER) AS late_bucket_flag
      FROM o GROUP BY 1, 2)
SELECT g.*, CAST(p1_open_cnt + p2_open_cnt AS BIGINT) AS urgent_open_cnt, w.worst_loan
FROM g JOIN w USING (customer_key, _observ_end_dt)
"""


@register("loan_features", _loan_sql())
def loan_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), F.last_day(F.to_date("o_orderdate")).alias("_observ_end_dt"),
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("grade"), "o_orderstatus",
        F.to_date("o_orderdate").alias("d"),
        # statuses merged first, then the product_status key (AG-08)
        L.compound_key(F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)),
                       L.map_lookup("o_orderstatus", LOAN_STATUS_MERGE)).alias("product_status"),
        L.in_list_flag("o_orderpriority", ["1-URGENT", "2-HIGH"], negate=True).alias("late_bucket_flag"))
    g = o.groupBy(*MONTH).agg(
        F.sum("amount").alias("loans"), F.count(F.lit(1)).alias("loans_cnt"),
        *A.pivot_aggs("product_status", LOAN_KEYS, {"cnt": ("count", None)}),
        A.any_flag((F.col("o_orderstatus") == "O")
                   & (F.col("d") <= F.date_add(F.trunc("d", "month"), 14))).alias("credit_line_flag"),
        F.max("late_bucket_flag").alias("late_bucket_flag"),
        F.max_by("o_orderkey", F.struct("grade", "o_orderkey")).alias("worst_loan"))
    # horizontal total over pivoted names with a fixed part and variants (AG-07)
    g = A.horizontal_total(g, "urgent_open_cnt", matching_columns(g.columns, "_open_cnt", ["p1", "p2"]))
    return to_val_columns(g)


# --- CL-37 / CL-38 / CL-57: investments merged from three
#     products, months in force, term statistics pivoted by product
INV_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _inv_sql() -> str:
    piv = []
    for p in INV_TYPES:
        k = p.lower()
        hit = f"p_type = '{p}'"
        piv += [f"max(CASE WHEN {hit} THEN term END) AS {k}_term_max",
                f"min(CASE WHEN {hit} THEN term END) AS {k}_term_min",
                f"CAST(sum(CASE WHEN {hit} THEN term END) AS BIGINT) AS {k}_term_sum",
                f"round(avg(CASE WHEN {hit} THEN term END), 6) AS {k}_term_avg"]
    months = ("CASE WHEN (last_ship = last_day(last_ship) AND first_order = last_day(first_order)) "
              "OR day(last_ship) >= day(first_order) "
              "THEN (year(last_ship) - year(first_order)) * 12 + month(last_ship) - month(first_order) "
              "ELSE (year(last_ship) - year(first_order)) * 12 + month(last_ship) - month(first_order) - 1 END")
    return f"""
WITH x AS (
  SELECT o.o_custkey AS customer_key, p.p_type, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(o.o_orderdate AS DATE) AS od, CAST(l.l_shipdate AS DATE) AS sd
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
inv AS (SELECT customer_key, p_type, sum(amount) AS amount, min(od) AS first_order, max(sd) AS last_ship
        FROM x GROUP BY 1, 2),
y AS (SELECT *, CAST(coalesce(greatest({months}, 0), 0) AS INTEGER) AS term FROM inv)
SELECT customer_key, {_val("sum(amount)", "invested_val")},
       CAST(max(CASE WHEN amount > 100000 THEN 1 ELSE 0 END) AS INTEGER) AS large_investment_flag,
       {", ".join(piv)}
FROM y GROUP BY 1
"""


@register("investment_features", _inv_sql())
def investment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    o = t(spark, sf_dir, "orders")
    p = t(spark, sf_dir, "part").select("p_partkey", "p_type")
    x = (fact_join(li, o)
         .join(p, li.l_partkey == p.p_partkey)
         .select(F.col("o_custkey").alias("customer_key"), "p_type",
                 F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
                 F.to_date("o_orderdate").alias("od"), F.to_date("l_shipdate").alias("sd")))
    # every product counts into the totals, listed in the pivot or not; the sources of CL-37
    # share one shape here, so one pass replaces a split by product and a union
    inv = x.groupBy("customer_key", "p_type").agg(
        F.sum("amount").alias("amount"), F.min("od").alias("first_order"), F.max("sd").alias("last_ship"))
    y = inv.withColumn("term", D.whole_months_between("last_ship", "first_order"))
    aggs = [F.sum("amount").alias("invested"),
            A.any_flag(F.col("amount") > 100000).alias("large_investment_flag")]
    for ptype in INV_TYPES:
        hit = F.col("p_type") == ptype
        k = ptype.lower()
        aggs += [F.max(F.when(hit, F.col("term"))).alias(f"{k}_term_max"),
                 F.min(F.when(hit, F.col("term"))).alias(f"{k}_term_min"),
                 F.sum(F.when(hit, F.col("term"))).alias(f"{k}_term_sum"),
                 F.round(F.avg(F.when(hit, F.col("term"))), 6).alias(f"{k}_term_avg")]
    g = y.groupBy("customer_key").agg(*aggs)
    return g.withColumn("invested_val", F.round("invested", 2).cast("decimal(19,2)")).drop("invested")


# --- TR-02 / TR-45 / IN-01 / IN-02 / CL-03 / CL-04 / CL-07 / ST-02: two channels, one shape,
#     success rule by era, account kind from products, pivot by channel_operation, sums
CHANNEL_OPS = ["app_purchase", "app_signup", "web_click", "web_view"]


@register("channel_sums", """
WITH b AS (SELECT c_custkey, c_mktsegment FROM customer),
app AS (SELECT user_id AS customer_key, 'app' AS channel, event_type AS operation, CAST(ts AS DATE) AS d,
               CAST(value AS DECIMAL(18,2)) AS amount FROM events WHERE event_type IN ('purchase', 'signup')),
web AS (SELECT user_id AS customer_key, 'web' AS channel, event_type AS operation, CAST(ts AS DATE) AS d,
               CAST(value AS DECIMAL(18,2)) AS amount FROM events WHERE event_type NOT IN ('purchase', 'signup')),
u AS (SELECT * FROM app UNION ALL SELECT * FROM web),
ok AS (SELECT u.*, coalesce(b.c_mktsegment, 'unknown') AS account_kind, channel || '_' || operation AS channel_operation
       FROM u LEFT JOIN b ON b.c_custkey = u.customer_key
       WHERE (d < DATE '2024-01-15' AND amount > 5) OR (d >= DATE '2024-01-15' AND amount > 10)),
g AS (SELECT customer_key, last_day(d) AS _observ_end_dt, min(account_kind) AS account_kind,
             CAST(count_if(channel_operation = 'app_purchase') AS BIGINT) AS app_purchase_cnt,
             coalesce(sum(CASE WHEN channel_operation = 'app_purchase' THEN amount END), 0) AS app_purchase_amount,
             CAST(count_if(channel_operation = 'app_signup') AS BIGINT) AS app_signup_cnt,
             coalesce(sum(CASE WHEN channel_operation = 'app_signup' THEN amount END), 0) AS app_signup_amount,
             CAST(count_if(channel_operation = 'web_click') AS BIGINT) AS web_click_cnt,
             coalesce(sum(CASE WHEN channel_operation = 'web_click' THEN amount END), 0) AS web_click_amount,
             CAST(count_if(channel_operation = 'web_view') AS BIGINT) AS web_view_cnt,
             coalesce(sum(CASE WHEN channel_operation = 'web_view' THEN amount END), 0) AS web_view_amount,
             CAST(count(*) AS BIGINT) AS operations_cnt,
             coalesce(sum(CASE WHEN channel = 'app' THEN amount END), 0) AS app_amount,
             coalesce(sum(CASE WHEN channel = 'web' THEN amount END), 0) AS web_amount
      FROM ok GROUP BY 1, 2)
SELECT customer_key, _observ_end_dt, account_kind, app_purchase_cnt, app_signup_cnt, web_click_cnt, web_view_cnt,
       CAST(round(app_purchase_amount, 2) AS DECIMAL(19,2)) AS app_purchase_amount_val,
       CAST(round(app_signup_amount, 2) AS DECIMAL(19,2)) AS app_signup_amount_val,
       CAST(round(web_click_amount, 2) AS DECIMAL(19,2)) AS web_click_amount_val,
       CAST(round(web_view_amount, 2) AS DECIMAL(19,2)) AS web_view_amount_val,
       operations_cnt, CAST(round(app_amount, 2) AS DECIMAL(19,2)) AS app_amount_val,
       CAST(round(web_amount, 2) AS DECIMAL(19,2)) AS web_amount_val
FROM g
""")
def channel_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events")

    def shape(df: DataFrame) -> DataFrame:
        return df.select(F.col("user_id").alias("customer_key"), "channel",
                         F.col("event_type").alias("operation"), F.to_date("ts").alias("d"),
                         F.col("value").cast("decimal(18,2)").alias("amount"))

    # two sources brought to one shape with the same clean-up, unioned by name (ST-02, S-21)
    app = e.where(F.col("event_type").isin("purchase", "signup")).withColumn("channel", F.lit("app"))
    web = e.where(~F.col("event_type").isin("purchase", "signup")).withColumn("channel", F.lit("web"))
    u = union_same_shape([app, web], shape)
    # success rule changes with the era of the record (CL-04)
    era = F.col("d") < F.lit("2024-01-15").cast("date")
    ok = u.where((era & (F.col("amount") > 5)) | (~era & (F.col("amount") > 10)))
    # missing account kind taken from the product bridge by left join (CL-07)
    kinds = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"),
                                                F.col("c_mktsegment").alias("account_kind"))
    ok = ok.join(kinds, "customer_key", "left").withColumn(
        "account_kind", F.coalesce("account_kind", F.lit("unknown")))
    ok = ok.withColumn("channel_operation", F.concat_ws("_", "channel", "operation"))
    g = ok.groupBy("customer_key", F.last_day("d").alias("_observ_end_dt")).agg(
        F.min("account_kind").alias("account_kind"),
        *A.pivot_aggs("channel_operation", CHANNEL_OPS, {"cnt": ("count", None), "amount": ("sum", "amount")}),
        # totals over every operation, listed in the pivot or not
        F.count(F.lit(1)).alias("operations_cnt"),
        *A.pivot_aggs("channel", ["app", "web"], {"amount": ("sum", "amount")}))
    return to_val_columns(g)


# --- TR-24 / CL-26: status pivot + total, usage sums, left join,
#     dropped columns, one dummy customer removed
@register("debit_card_features", """
WITH a AS (SELECT o_custkey AS customer_key,
                  CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS status_f_cnt,
                  CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS status_o_cnt,
                  CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS status_p_cnt
           FROM orders WHERE o_custkey <> 0 GROUP BY 1),
u AS (SELECT o.o_custkey AS customer_key, CAST(count(*) AS BIGINT) AS uses_cnt,
             CAST(round(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))), 2) AS DECIMAL(19,2)) AS uses_val
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag <> 'R' GROUP BY 1)
SELECT a.*, CAST(status_f_cnt + status_o_cnt + status_p_cnt AS BIGINT) AS cards_cnt,
       coalesce(u.uses_cnt, 0) AS uses_cnt, CAST(coalesce(u.uses_val, 0) AS DECIMAL(19,2)) AS uses_val
FROM a LEFT JOIN u USING (customer_key)
""")
def debit_card_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").where(F.col("o_custkey") != 0)  # dummy customer removed
    cards = o.select(F.col("o_custkey").alias("customer_key"), "o_orderstatus", "o_orderdate",
                     "o_totalprice").drop("o_orderdate", "o_totalprice")  # TR-24: two columns dropped
    a = A.pivot_measures(cards, ["customer_key"], "o_orderstatus", ["F", "O", "P"],
                         {"cnt": ("count", None)}, name_fmt="status_{value}_{measure}")
    a = A.horizontal_total(a, "cards_cnt", ["status_f_cnt", "status_o_cnt", "status_p_cnt"])
    u = (transactions(spark, sf_dir).where(F.col("kind") != "R").groupBy("customer_key")
         .agg(F.count(F.lit(1)).alias("uses_cnt"), F.sum("amount").alias("uses")))
    return fill_numeric_zero(to_val_columns(a.join(u, "customer_key", "left")), ["uses_cnt", "uses_val"])


# --- IN-10 / PRJ-06 / PRJ-07: latest report per customer over all months
@register("latest_per_customer", """
SELECT customer_key, report_date, report_total FROM (
  SELECT o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS report_date, o_totalprice AS report_total,
         row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""")
def latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("inc_customer_key_x"), F.to_date("o_orderdate").alias("inc_report_date_x"),
        F.col("o_totalprice").alias("inc_report_total_x"), F.col("o_orderkey").alias("inc_orderkey_x"))
    top = W.top_one_by(o, ["inc_customer_key_x"],
                       ["inc_customer_key_x", "inc_report_date_x", "inc_report_total_x"],
                       ["inc_report_date_x", "inc_orderkey_x"])
    return remove_suffix(remove_prefix(top, "inc_"), "_x")


# --- savings per customer over all months, incl. months since the first account
@register("saving_features", """
WITH s AS (SELECT o_custkey AS customer_key, o_orderpriority AS account_key, CAST(o_orderdate AS DATE) AS d,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS balance, o_orderstatus FROM orders),
first AS (SELECT customer_key, min(d) AS first_open, max(d) AS as_of FROM s GROUP BY 1),
g AS (SELECT customer_key, CAST(count(DISTINCT account_key) AS BIGINT) AS accounts_cnt,
             CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS active_cnt,
             sum(balance) AS total_balance, max(balance) AS max_balance, min(balance) AS min_balance
      FROM s GROUP BY 1)
SELECT g.customer_key, g.accounts_cnt, g.active_cnt,
       CAST(round(g.total_balance, 2) AS DECIMAL(19,2)) AS total_balance_val,
       CAST(round(g.max_balance, 2) AS DECIMAL(19,2)) AS max_balance_val,
       CAST(round(g.min_balance, 2) AS DECIMAL(19,2)) AS min_balance_val,
       CAST(greatest(CASE WHEN (as_of = last_day(as_of) AND first_open = last_day(first_open)) OR day(as_of) >= day(first_open)
                 THEN (year(as_of) - year(first_open)) * 12 + month(as_of) - month(first_open)
                 ELSE (year(as_of) - year(first_open)) * 12 + month(as_of) - month(first_open) - 1 END, 0) AS INTEGER) AS months_since_first
FROM g JOIN first USING (customer_key)
""")
def saving_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"),
        F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").cast("decimal(18,2)").alias("balance"),
        "o_orderstatus")
    g = s.groupBy("customer_key").agg(
        F.count_distinct("account_key").alias("accounts_cnt"),
        A.count_if(F.col("o_orderstatus") == "O").alias("active_cnt"),
        F.sum("balance").alias("total_balance"), F.max("balance").alias("max_balance"),
        F.min("balance").alias("min_balance"),
        D.whole_months_between(F.max("d"), F.min("d")).alias("months_since_first"))
    return to_val_columns(g)
