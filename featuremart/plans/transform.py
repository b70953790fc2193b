"""Transformation nodes (account x month and customer features) that are
compositions of other nodes: card features onto products (TR-01), six-measure
pivot onto products (TR-04), the credit-card node (TR-07, TR-08, TR-11), the
customer node (TR-23) and regulator / bureau debt features (TR-31, TR-43).

Each composition reuses the builders of its parts, and its oracle reuses the
parts' oracle SQL, so both sides are built from the same pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions import lookup as L
from featuremart.functions.currency import currency_views, to_home_currency
from featuremart.operators import aggregates as A
from featuremart.operators.columns import fill_numeric_zero, to_val_columns
from featuremart.operators.joins import add_rate, join_all
from featuremart.operators.windows import keep_ratio
from featuremart.session import staged
from featuremart.plans import cleaning, layers, pivots  # noqa: F401  (parts registered first)
from featuremart.plans.cleaning import (CUSTOMER_CLEANED_SQL, EMPLOYEES_SQL, PRODUCTS_SQL,
                                        customer_cleaned, employees_cleaned, products_bridge)
from featuremart.plans.inputs import (CURRENCIES, FOREIGN, HOME, RATES_SQL, SNAPSHOTS_SQL,
                                      TRANSACTIONS_SQL, account_snapshots, rates, t, transactions)
from featuremart.plans.layers import card_account_aggs, card_account_facts
from featuremart.plans.pivots import pivot_six_measures
from featuremart.plans.registry import ORACLES, register

ACCOUNT_MONTH = ["customer_key", "account_key", "_observ_end_dt"]


def _val(expr: str, alias: str) -> str:
    return f"CAST(round({expr}, 2) AS DECIMAL(19,2)) AS {alias}"


def _currency_sql(col: str = "customer_key") -> str:
    return f"CASE WHEN {col} % 2 = 0 THEN {HOME} ELSE {FOREIGN} END"


# --- TR-07: balances in three currency views at the month-end rate (JN-03 snapshot)
def card_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = account_snapshots(spark, sf_dir).withColumnRenamed("info_date", "_observ_end_dt")
    s = add_rate(s, rates(spark, sf_dir), "_observ_end_dt", snapshot=True)
    s = s.withColumn("currency_id", F.when(F.col("customer_key") % 2 == 0, F.lit(HOME))
                     .otherwise(F.lit(FOREIGN)))
    return to_val_columns(s.select(*ACCOUNT_MONTH, *currency_views("currency_id", "balance", "rate",
                                                                    CURRENCIES, HOME, value_name="balance")))


# --- TR-08: payments pivoted by two kinds (credit / debit movements)
PAYMENT_KINDS = ["F", "O"]


def payment_aggs() -> list:
    return A.pivot_aggs("direction", PAYMENT_KINDS, {"cnt": ("count", None), "amount": ("sum", "amount")},
                        name_fmt="payment_{value}_{measure}")


_BAL_SQL = f"""
SELECT s.customer_key, s.account_key, s.info_date AS _observ_end_dt,
       {_val(f"CASE WHEN {_currency_sql('s.customer_key')} = {HOME} THEN s.balance ELSE 0 END", "balance_home_val")},
       {_val(f"CASE WHEN {_currency_sql('s.customer_key')} = {FOREIGN} THEN s.balance ELSE 0 END", "balance_foreign_val")},
       {_val(f"CASE WHEN {_currency_sql('s.customer_key')} = {HOME} THEN s.balance ELSE s.balance * r.rate END", "balance_unified_val")}
FROM ({SNAPSHOTS_SQL}) s LEFT JOIN ({RATES_SQL}) r ON r.rate_date = s.info_date
"""

_PAY_SQL = f"""
SELECT customer_key, account_key, last_day(trx_date) AS _observ_end_dt,
       {", ".join(f"CAST(count_if(direction = '{k}') AS BIGINT) AS payment_{k.lower()}_cnt, "
                  + _val(f"coalesce(sum(CASE WHEN direction = '{k}' THEN amount END), 0)", f"payment_{k.lower()}_amount_val")
                  for k in PAYMENT_KINDS)}
FROM ({TRANSACTIONS_SQL}) x GROUP BY 1, 2, 3
"""

PAYMENT_MEASURES = [f"payment_{k.lower()}_{m}" for k in PAYMENT_KINDS for m in ("cnt", "amount_val")]


# --- TR-11 / PRJ-11: the credit-card node: balances (TR-07) left join payments (TR-08) left join
#     account status, arrears flags and arrears days (TR-06 / TR-09)
@register("credit_card_node", f"""
WITH bal AS ({_BAL_SQL}), pay AS ({_PAY_SQL}), acc AS ({ORACLES['card_account_features']})
SELECT bal.*, {", ".join(f"coalesce(pay.{m}, 0) AS {m}" for m in PAYMENT_MEASURES)},
       acc.status_group, acc.arrears_30_flag, acc.arrears_60_flag, acc.arrears_90_flag,
       acc.arrears_balance_val, acc.balance_val AS statement_balance_val, acc.max_arrears_days
FROM bal LEFT JOIN pay USING (customer_key, account_key, _observ_end_dt)
LEFT JOIN acc USING (customer_key, account_key, _observ_end_dt)
""")
def credit_card_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    # payments (TR-08) and account status / arrears (TR-06 / TR-09) share one join of the
    # movements to their accounts and one grouped pass: the fact table is shuffled once
    acc = card_account_facts(spark, sf_dir).groupBy(*ACCOUNT_MONTH).agg(*payment_aggs(), *card_account_aggs())
    acc = to_val_columns(acc.withColumnRenamed("balance", "statement_balance"))
    out = card_balances(spark, sf_dir).join(acc, ACCOUNT_MONTH, "left")
    return fill_numeric_zero(out, PAYMENT_MEASURES)


# --- TR-01: card features: daily rate, merchant catalog, pivot by merchant group (AG-05),
#     one category counted only (AG-06), totals (AG-04), joined onto products
MERCHANT_GROUPS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("pos_card_features", f"""
WITH x AS (SELECT x.*, p.p_type AS merchant_group,
                  CASE WHEN x.currency_id = {HOME} THEN x.amount ELSE x.amount * r.rate END AS amount_home
           FROM ({TRANSACTIONS_SQL}) x LEFT JOIN ({RATES_SQL}) r ON r.rate_date = x.trx_date
           LEFT JOIN part p ON p.p_partkey = x.l_partkey),
f AS (SELECT customer_key, account_key, last_day(trx_date) AS _observ_end_dt,
             CAST(count(*) AS BIGINT) AS total_cnt, sum(amount_home) AS total_amount_home,
             CAST(count_if(kind = 'N') AS BIGINT) AS consult_cnt,
             {", ".join(f"coalesce(sum(CASE WHEN merchant_group = '{g}' THEN amount_home END), 0) AS group_{g.lower()}_amount" for g in MERCHANT_GROUPS)}
      FROM x GROUP BY 1, 2, 3),
pr AS (SELECT DISTINCT customer_key, account_key FROM ({PRODUCTS_SQL}))
SELECT f.customer_key, f.account_key, f._observ_end_dt, f.total_cnt, f.consult_cnt,
       {_val("f.total_amount_home", "total_amount_home_val")},
       {", ".join(_val(f"f.group_{g.lower()}_amount", f"group_{g.lower()}_amount_val") for g in MERCHANT_GROUPS)}
FROM f JOIN pr USING (customer_key, account_key)
""")
def pos_card_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = add_rate(transactions(spark, sf_dir), rates(spark, sf_dir), "trx_date")
    x = x.withColumn("amount_home", to_home_currency("currency_id", "amount", "rate", HOME))
    # merchant catalog: part grows with the data, so it is a size-checked join
    x = L.lookup_join(x, "l_partkey", t(spark, sf_dir, "part"), "p_partkey", ["p_type"]) \
        .withColumnRenamed("p_type", "merchant_group")
    x = x.withColumn("_observ_end_dt", F.last_day("trx_date"))
    f = x.groupBy(*ACCOUNT_MONTH).agg(
        F.count(F.lit(1)).alias("total_cnt"),
        F.sum("amount_home").alias("total_amount_home"),
        A.count_if(F.col("kind") == "N").alias("consult_cnt"),
        *A.pivot_aggs("merchant_group", MERCHANT_GROUPS, {"amount": ("sum", "amount_home")},
                      name_fmt="group_{value}_{measure}"))
    pr = products_bridge(spark, sf_dir).select("customer_key", "account_key").distinct()
    return to_val_columns(f.join(pr, ["customer_key", "account_key"]))


# --- TR-04: the six-measure pivot (TR-03) left joined onto the accounts of each month
SIX_MEASURES = [f"{k}_{m}" for k in "anr"
                for m in ("cnt", "amount_val", "max_amount_val", "min_amount_val", "quantity_val", "orders")] \
    + ["returned_flag"]


@register("bibanking_with_products", f"""
WITH s AS ({SNAPSHOTS_SQL}), p AS ({ORACLES['pivot_six_measures']})
SELECT s.customer_key, s.account_key, s.info_date,
       {", ".join(f"coalesce(p.{m}, 0) AS {m}" for m in SIX_MEASURES)}
FROM s LEFT JOIN p USING (customer_key, account_key, info_date)
""")
def bibanking_with_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["customer_key", "account_key", "info_date"]
    s = account_snapshots(spark, sf_dir).select(*keys)
    p = pivot_six_measures(spark, sf_dir)
    out = s.join(p, keys, "left")
    return fill_numeric_zero(out, [c for c in out.columns if c not in keys])


# --- customer node, first parts: cleaned customers (TR-15) left join employees (CL-27),
#     paid income (TR-16), web-login flag (TR-19) and products held (TR-40 / CL-25)
@register("customer_node", f"""
WITH c AS ({CUSTOMER_CLEANED_SQL}), e AS ({EMPLOYEES_SQL}),
inc AS (SELECT o_custkey AS customer_key, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS income
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
lg AS (SELECT user_id AS customer_key, CAST(max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS INTEGER) AS web_login_flag
       FROM events GROUP BY 1),
pr AS (SELECT customer_key, CAST(count(*) AS BIGINT) AS products_cnt FROM ({PRODUCTS_SQL}) GROUP BY 1)
SELECT c.*, CASE WHEN e.employee_key IS NOT NULL THEN 1 ELSE 0 END AS employee_flag,
       coalesce(e.active_flag, 0) AS employee_active_flag, {_val("coalesce(inc.income, 0)", "income_val")},
       coalesce(lg.web_login_flag, 0) AS web_login_flag, coalesce(pr.products_cnt, 0) AS products_cnt
FROM c LEFT JOIN e ON e.employee_key = c.customer_key LEFT JOIN inc USING (customer_key)
LEFT JOIN lg USING (customer_key) LEFT JOIN pr USING (customer_key)
""")
def customer_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customer_cleaned(spark, sf_dir)
    e = employees_cleaned(spark, sf_dir).select(
        F.col("employee_key").alias("customer_key"), F.lit(1).alias("employee_flag"),
        F.col("active_flag").alias("employee_active_flag"))
    o = t(spark, sf_dir, "orders")
    inc = o.where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("customer_key")) \
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("income"))
    inc = to_val_columns(inc)
    lg = t(spark, sf_dir, "events").groupBy(F.col("user_id").alias("customer_key")) \
        .agg(A.any_flag(F.col("event_type") == "view").alias("web_login_flag"))
    pr = products_bridge(spark, sf_dir).groupBy("customer_key").agg(F.count(F.lit(1)).alias("products_cnt"))
    out = join_all([c, e, inc, lg, pr], ["customer_key"], "left")
    return fill_numeric_zero(out, ["employee_flag", "employee_active_flag", "income_val", "web_login_flag",
                                   "products_cnt"])


# --- TR-43 / TR-31: regulator debt features per customer. Repeated reports of a day are cut
#     first (WN-07: first ceil(rows / reports) rows per report); then counts per status
#     (AG-14), worst grade by link, direct / indirect (AG-15), and liabilities per link
#     where card rows, reported once per currency, count as ceil(n / 2) (AG-11 / AG-13)
DEBT_STATUSES = ["A", "N", "R"]
LINKS = {"F": "direct", "O": "indirect"}
DEBT_ORDER = ["l_linenumber", "l_suppkey", "l_partkey", "amount", "direction", "kind", "account_key"]


@register("debt_features", f"""
WITH x AS ({TRANSACTIONS_SQL}),
d AS (SELECT l_orderkey, count(DISTINCT direction) AS reports FROM x GROUP BY 1),
n AS (SELECT x.*, d.reports, count(*) OVER (PARTITION BY x.l_orderkey) AS n_rows,
             row_number() OVER (PARTITION BY x.l_orderkey ORDER BY {", ".join(DEBT_ORDER)}) AS rn
      FROM x JOIN d USING (l_orderkey)),
k AS (SELECT customer_key, l_suppkey, amount, kind,
             CASE direction WHEN 'F' THEN 'direct' WHEN 'O' THEN 'indirect' END AS link,
             CAST(substr(account_key, 1, 1) AS INTEGER) AS grade
      FROM n WHERE rn <= ceil(n_rows / reports)),
s AS (SELECT customer_key,
             {", ".join(f"CAST(count_if(kind = '{v}') AS BIGINT) AS status_{v.lower()}_cnt" for v in DEBT_STATUSES)},
             {", ".join(f"max(CASE WHEN link = '{lk}' THEN grade END) AS {lk}_worst_grade" for lk in LINKS.values())}
      FROM k GROUP BY 1),
h1 AS (SELECT customer_key, link, l_suppkey, amount, coalesce(kind = 'R', false) AS pair, count(*) AS c
       FROM k GROUP BY 1, 2, 3, 4, 5),
h2 AS (SELECT customer_key, link, CAST(CASE WHEN pair THEN ceil(c / 2.0) ELSE c END AS BIGINT) AS c, amount FROM h1),
h AS (SELECT customer_key,
             {", ".join(f"CAST(coalesce(sum(CASE WHEN link = '{lk}' THEN c END), 0) AS BIGINT) AS {lk}_debt_cnt, "
                        + _val(f"coalesce(sum(CASE WHEN link = '{lk}' THEN amount * c END), 0)", f"{lk}_limit_val")
                        for lk in LINKS.values())}
      FROM h2 GROUP BY 1)
SELECT s.*, {", ".join(f"h.{lk}_debt_cnt, h.{lk}_limit_val" for lk in LINKS.values())}
FROM s JOIN h USING (customer_key)
""")
def debt_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = transactions(spark, sf_dir).select("l_orderkey", "customer_key", *DEBT_ORDER)
    kept = keep_ratio(x, ["l_orderkey"], DEBT_ORDER, distinct_col="direction")
    # equal rows first: pairs are halved per entity, amount and link (AG-11), everything else adds up
    equal = kept.groupBy("customer_key", L.map_lookup("direction", LINKS).alias("link"), "l_suppkey", "amount", "kind").agg(
        F.count(F.lit(1)).alias("rows_cnt"), F.max(F.substring("account_key", 1, 1).cast("int")).alias("grade"))
    debts = F.when(F.col("kind") == "R", F.ceil(F.col("rows_cnt") / 2)).otherwise(F.col("rows_cnt")).cast("long")
    equal = equal.withColumn("debts", debts).withColumn("limit_amount", F.col("amount") * F.col("debts"))
    return to_val_columns(equal.groupBy("customer_key").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == v, F.col("rows_cnt"))), F.lit(0)).alias(f"status_{v.lower()}_cnt")
          for v in DEBT_STATUSES],
        *[F.max(F.when(F.col("link") == lk, F.col("grade"))).alias(f"{lk}_worst_grade") for lk in LINKS.values()],
        *A.pivot_aggs("link", list(LINKS.values()), {"debt_cnt": ("sum", "debts"), "limit": ("sum", "limit_amount")},
                      name_fmt="{value}_{measure}")))
