"""Remaining cleaning nodes at their full shape, and the compositions that need
them: card catalog, instalment plans, coded movements, payroll income, bureau
debts, two-sided forex rows, current accounts per month, the whole customer
node and the whole credit-card node."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featuremart.functions import dates as D
from featuremart.functions import lookup as L
from featuremart.functions import text as T
from featuremart.operators import aggregates as A
from featuremart.operators.columns import fill_numeric_zero, to_val_columns
from featuremart.operators.broadcast import join_small
from featuremart.operators.columns import label_missing_text
from featuremart.operators.joins import add_rate, fact_join, fact_tasks, join_all
from featuremart.plans import layers2, layers3  # noqa: F401  (their oracles are parts of the whole nodes')
from featuremart.plans.cleaning import _case_sql, _slug_sql, cleaned_columns
from featuremart.plans.customer import ratio4
from featuremart.plans.customer_month import (ACCOUNTS_SQL, MONTH, _cnt_sql, _months_sql, _sum_sql, _val, accounts,
                                              card_month_columns, card_month_measures, total)
from featuremart.plans.inputs import FOREIGN, HOME, TRANSACTIONS_SQL, rates, t, transactions
from featuremart.plans.layers import card_account_aggs
from featuremart.plans.layers2 import INSTALMENT_GROUPS
from featuremart.plans.registry import ORACLES, register
from featuremart.plans.transform import _BAL_SQL, _PAY_SQL, PAYMENT_MEASURES, card_balances, payment_aggs

# --- CL-13: card catalog: category from a dictionary, grade and next grade, premium and company flags
CATEGORIES = {"ECONOMY": "classic", "STANDARD": "classic", "SMALL": "silver", "MEDIUM": "gold", "LARGE": "platinum"}


@register("card_catalog", f"""
WITH b AS (SELECT DISTINCT p_brand AS card_code, p_type FROM part),
g AS (SELECT card_code, {_case_sql("p_type", CATEGORIES, "other")} AS category, CAST(substr(card_code, 7) AS INTEGER) AS grade, p_type FROM b),
n AS (SELECT DISTINCT grade, card_code FROM g)
SELECT g.card_code, g.category, g.grade, n.card_code AS next_card,
       CAST(CASE WHEN g.category IN ('gold', 'platinum') THEN 1 ELSE 0 END AS INTEGER) AS premium_flag,
       CAST(CASE WHEN g.p_type = 'PROMO' THEN 1 ELSE 0 END AS INTEGER) AS company_flag
FROM g LEFT JOIN n ON n.grade = g.grade + 1
""")
def card_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = t(spark, sf_dir, "part").select(F.col("p_brand").alias("card_code"), "p_type").distinct().select(
        "card_code", L.map_lookup("p_type", CATEGORIES, default="other").alias("category"),
        F.substr("card_code", F.lit(7)).cast("int").alias("grade"), "p_type")
    following = g.select((F.col("grade") - 1).alias("grade"), F.col("card_code").alias("next_card")).distinct()
    return g.join(following, "grade", "left").select(
        "card_code", "category", "grade", "next_card",
        L.in_list_flag("category", ["gold", "platinum"]).alias("premium_flag"),
        L.in_list_flag("p_type", ["PROMO"]).alias("company_flag"))


# --- CL-14: instalment plans: state from the remaining part, part due, promotion group by text
@register("instalment_plans", """
SELECT l_orderkey AS plan_key, l_linenumber AS plan_part,
       CASE WHEN l_linestatus = 'F' THEN 'settled' WHEN l_quantity > 25 THEN 'running' ELSE 'ending' END AS state,
       CAST(CASE WHEN l_linestatus = 'F' THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) END AS DECIMAL(19,2)) AS due_val,
       CASE WHEN p_name LIKE '%ring%' THEN 'rings' WHEN p_name LIKE '%widget%' THEN 'widgets' ELSE 'none' END AS promotion_group
FROM lineitem JOIN part ON p_partkey = l_partkey
""")
def instalment_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_quantity",
                                             "l_extendedprice", "l_tax")
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name")
    settled = F.col("l_linestatus") == "F"
    due = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("plan_key"), F.col("l_linenumber").alias("plan_part"),
        F.when(settled, "settled").when(F.col("l_quantity") > 25, "running").otherwise("ending").alias("state"),
        F.when(settled, F.lit(0)).otherwise(due).cast("decimal(19,2)").alias("due_val"),
        L.rule_chain("p_name", [("like", "%ring%", "rings"), ("like", "%widget%", "widgets")], default="none")
        .alias("promotion_group"))


# --- CL-20: current-account movements: code -> kind, description as a slug
MOVE_KINDS = {"A": "credit note", "N": "cash deposit", "R": "cheque, returned"}


@register("coded_movements", f"""
SELECT l_orderkey, l_linenumber, l_returnflag AS code, {_case_sql("l_returnflag", MOVE_KINDS, "unknown")} AS kind,
       {_slug_sql("lower(" + _case_sql("l_returnflag", MOVE_KINDS, "unknown") + " || ' - ' || p_name)")} AS description
FROM lineitem JOIN part ON p_partkey = l_partkey
""")
def coded_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name")
    kind = L.map_lookup("l_returnflag", MOVE_KINDS, default="unknown")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("code"), kind.alias("kind"),
        T.slug(F.lower(F.concat(kind, F.lit(" - "), F.col("p_name")))).alias("description"))


# --- CL-22: payroll income: amounts as decimal(10,2), distinct rows
@register("payroll_income", """
SELECT DISTINCT o_custkey AS customer_key, last_day(CAST(o_orderdate AS DATE)) AS _observ_end_dt,
       CAST(o_totalprice AS DECIMAL(10,2)) AS income FROM orders
""")
def payroll_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), F.last_day(F.to_date("o_orderdate")).alias("_observ_end_dt"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("income")).distinct()


# --- CL-33: regulator debts inside a bureau report: entity slug, asset kind and guarantee by rules
@register("bureau_debts", f"""
SELECT l_orderkey AS report_key, l_linenumber AS debt_no, {_slug_sql("lower(s_name)")} AS entity,
       CASE WHEN p_type = 'PROMO' THEN 'consumer' WHEN p_name LIKE '%widget%' AND l_quantity > 25 THEN 'mortgage' WHEN p_name LIKE '%widget%' THEN 'card' ELSE 'other' END AS asset_kind,
       CASE WHEN contains(p_brand, '#1') OR contains(p_brand, '#2') THEN 'secured' ELSE 'unsecured' END AS guarantee,
       CAST(l_extendedprice AS DECIMAL(19,2)) AS owed_val
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
""")
def bureau_debts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_extendedprice")
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    s = t(spark, sf_dir, "supplier").select("s_suppkey", T.slug(F.lower(F.col("s_name"))).alias("entity"))
    x = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
    widget = F.col("p_name").like("%widget%")
    return x.select(
        F.col("l_orderkey").alias("report_key"), F.col("l_linenumber").alias("debt_no"), "entity",
        F.when(F.col("p_type") == "PROMO", "consumer").when(widget & (F.col("l_quantity") > 25), "mortgage")
         .when(widget, "card").otherwise("other").alias("asset_kind"),
        L.rule_chain("p_brand", [("contains", "#1", "secured"), ("contains", "#2", "secured")], default="unsecured").alias("guarantee"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("decimal(19,2)").alias("owed_val"))


# --- CL-54: online forex rows: customer and account from the debit side of a sale, the credit side
#     of a purchase
@register("forex_sides", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS operation,
       CASE WHEN event_id % 2 = 0 THEN user_id ELSE user_id + 1 END AS customer_key,
       CASE WHEN event_id % 2 = 0 THEN event_type || '-credit' ELSE event_type || '-debit' END AS account_key,
       CAST(value AS DECIMAL(19,2)) AS amount
FROM events
""")
def forex_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select(
        "event_id", "value", F.when(F.col("event_id") % 2 == 0, "C").otherwise("V").alias("code"),
        F.col("user_id").alias("credit_customer"), (F.col("user_id") + 1).alias("debit_customer"),
        F.concat("event_type", F.lit("-credit")).alias("credit_account"),
        F.concat("event_type", F.lit("-debit")).alias("debit_account"))
    return e.select(
        "event_id", L.pick_by_code("code", "C", F.lit("buy"), "V", F.lit("sell")).alias("operation"),
        L.pick_by_code("code", "C", F.col("credit_customer"), "V", F.col("debit_customer")).alias("customer_key"),
        L.pick_by_code("code", "C", F.col("credit_account"), "V", F.col("debit_account")).alias("account_key"),
        F.col("value").cast("decimal(18,2)").cast("decimal(19,2)").alias("amount"))


# --- IN-06: current accounts per customer and month: movements by kind, direction and currency, and
#     the part of the active accounts (left joined)
MOVES = [("cheques", "A", "F"), ("transfers", "A", "O"), ("credit_notes", "N", "F"), ("deposits", "N", "O"),
         ("debit_notes", "R", "F"), ("withdrawals", "R", "O")]


@register("current_account_month", f"""
WITH m AS (SELECT customer_key, last_day(trx_date) AS _observ_end_dt,
  {", ".join(f"{_cnt_sql(f'''kind = '{k}' AND direction = '{d}' ''', f'{n}_cnt')}, {_sum_sql(f'''kind = '{k}' AND direction = '{d}' ''')} AS {n}" for n, k, d in MOVES)},
  {_cnt_sql("currency_id = 1 AND direction = 'F'", "credits_home_cnt")}, {_sum_sql("currency_id = 1 AND direction = 'F'")} AS credits_home,
  {_cnt_sql("currency_id = 2 AND direction = 'F'", "credits_foreign_cnt")}, {_sum_sql("currency_id = 2 AND direction = 'F'")} AS credits_foreign,
  {_cnt_sql("currency_id = 1 AND direction = 'O'", "debits_home_cnt")}, {_sum_sql("currency_id = 1 AND direction = 'O'")} AS debits_home
  FROM ({TRANSACTIONS_SQL}) GROUP BY 1, 2),
a AS (SELECT customer_key, _observ_end_dt, {_cnt_sql("state = 'current'", "active_cnt")},
             sum(CASE WHEN state = 'current' THEN balance END) AS active_balance, min(CASE WHEN state = 'current' THEN opened END) AS active_since,
             CAST(max(CASE WHEN state = 'current' THEN {_months_sql("_observ_end_dt", "opened")} END) AS INTEGER) AS active_months
      FROM ({ACCOUNTS_SQL}) GROUP BY 1, 2 HAVING count_if(state = 'current') > 0)
SELECT m.customer_key, m._observ_end_dt, {", ".join(f"{n}_cnt, {_val(n, f'{n}_val')}" for n, _, _ in MOVES)},
       credits_home_cnt, {_val("credits_home", "credits_home_val")}, credits_foreign_cnt, {_val("credits_foreign", "credits_foreign_val")},
       debits_home_cnt, {_val("debits_home", "debits_home_val")},
       coalesce(active_cnt, 0) AS active_cnt, {_val("coalesce(active_balance, 0)", "active_balance_val")}, active_since, active_months
FROM m LEFT JOIN a USING (customer_key, _observ_end_dt)
""")
def current_account_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, aggs = transactions(spark, sf_dir), []

    def both(name: str, hit) -> None:
        aggs.extend([A.count_if(hit).alias(f"{name}_cnt"), total(hit).alias(name)])

    for name, k, d in MOVES:
        both(name, (F.col("kind") == k) & (F.col("direction") == d))
    both("credits_home", (F.col("currency_id") == HOME) & (F.col("direction") == "F"))
    both("credits_foreign", (F.col("currency_id") == FOREIGN) & (F.col("direction") == "F"))
    both("debits_home", (F.col("currency_id") == HOME) & (F.col("direction") == "O"))
    m = x.groupBy("customer_key", F.last_day("trx_date").alias("_observ_end_dt")).agg(*aggs)
    a = accounts(spark, sf_dir).where(F.col("state") == "current").groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("active_cnt"), F.sum("balance").alias("active_balance"), F.min("opened").alias("active_since"),
        F.max(D.whole_months_between("_observ_end_dt", "opened")).alias("active_months"))
    return to_val_columns(fill_numeric_zero(m.join(a, MONTH, "left"), ["active_cnt", "active_balance"]))


# --- TR-23: the whole customer node: TR-15/16/19/40 joined with the main address, the company form,
#     the app login, the supplier flag and the leads
@register("customer_node_whole", f"""
WITH n AS ({ORACLES["customer_node"]}), f AS ({ORACLES["customer_base_with_form"]}), s AS ({ORACLES["income_and_supplier"]}),
l AS (SELECT customer_key, max(app_login_flag) AS app_login_flag, max(app_last_login) AS app_last_login FROM ({ORACLES["login_flags"]}) GROUP BY 1),
a AS (SELECT c_custkey AS customer_key, {_slug_sql("lower(n_name || ' ' || r_name)")} AS main_address
      FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
d AS (SELECT o_custkey AS customer_key, CAST(count(*) AS BIGINT) AS leads_cnt FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT n.*, f.company_form, f.form_date, coalesce(s.supplier_flag, 0) AS supplier_flag,
       coalesce(l.app_login_flag, 0) AS app_login_flag, l.app_last_login, a.main_address, coalesce(d.leads_cnt, 0) AS leads_cnt
FROM n LEFT JOIN f USING (customer_key) LEFT JOIN s USING (customer_key) LEFT JOIN l USING (customer_key)
LEFT JOIN a USING (customer_key) LEFT JOIN d USING (customer_key)
""")
def customer_node_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one grouped pass per table, each keyed by the customer; the joins find both sides already
    # partitioned by it, so a table is exchanged for its own aggregate and no more
    per_product = t(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority", "o_orderstatus").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"),
        F.max(F.struct(F.to_date("o_orderdate").alias("day"), "o_orderkey")).alias("last"), F.count(F.lit(1)).alias("orders"))
    status = F.col("o_orderstatus")
    orders = per_product.groupBy(F.col("o_custkey").alias("customer_key")).agg(
        F.min("first").alias("joined_on"), A.sum_if(status == "F", "amount").alias("income"), F.count(F.lit(1)).alias("products_cnt"),
        F.max(F.struct("last.day", "last.o_orderkey", status.alias("form"))).alias("form"),
        F.sum(F.when(status == "P", F.col("orders"))).alias("leads_cnt"))
    login = F.col("event_type").like("%sign%") | F.col("event_type").like("%click%")
    events = t(spark, sf_dir, "events").groupBy(F.col("user_id").alias("customer_key")).agg(
        A.any_flag(F.col("event_type") == "view").alias("web_login_flag"), A.any_flag(login).alias("app_login_flag"),
        F.max(F.when(login, F.to_date("ts"))).alias("app_last_login"))
    active = T.truthy_flag(F.when(F.col("s_acctbal") >= 0, F.lit("Y")).otherwise(F.lit(" n")))
    staff = t(spark, sf_dir, "supplier").groupBy(F.col("s_suppkey").alias("customer_key")).agg(
        F.max(active).alias("employee_active_flag"), F.lit(1).alias("employee_flag"), F.lit(1).alias("supplier_flag"))
    place = t(spark, sf_dir, "nation").join(F.broadcast(t(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    c = join_small(t(spark, sf_dir, "customer"), place, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    c = c.withColumn("customer_key", F.col("c_custkey"))
    x = join_all([c, orders, events, staff], ["customer_key"], "left").drop("customer_key")
    kept = {"employee_flag", "employee_active_flag", "income", "web_login_flag", "products_cnt", "supplier_flag", "app_login_flag", "leads_cnt"}
    address = T.slug(F.lower(F.concat("n_name", F.lit(" "), F.col("r_name"))))
    form_date = D.parse_day_first_date(F.date_format("form.day", "ddMMyyyy"), max_year=9999)
    out = x.select(*cleaned_columns(), *sorted(kept), "app_last_login", address.alias("main_address"),
                   F.coalesce("form.form", F.lit("none")).alias("company_form"), form_date.alias("form_date"))
    out = label_missing_text(out, exclude=["customer_key", "customer_hex", "main_address", "company_form"])
    return to_val_columns(fill_numeric_zero(out, sorted(kept)))


# --- TR-11: the whole credit-card node: account chain (TR-06) with balances (TR-07), payments by kind
#     (TR-08), status and arrears (TR-09), the card's category from the catalog (the card is the brand
#     of the account's newest movement in the month), and the customer's instalments (TR-10)
ACCOUNT_MONTH = ["customer_key", "account_key", "_observ_end_dt"]
STATUS_MEASURES = ["status_group", "arrears_30_flag", "arrears_60_flag", "arrears_90_flag", "arrears_balance", "max_arrears_days"]


@register("credit_card_node_whole", f"""
WITH a AS ({ORACLES["card_account_month"]}), bal AS ({_BAL_SQL}), pay AS ({_PAY_SQL}), acc AS ({ORACLES["card_account_features"]}),
i AS ({ORACLES["instalments"]}),
g AS (SELECT * FROM ({ORACLES["card_catalog"]})
      QUALIFY row_number() OVER (PARTITION BY card_code ORDER BY category, next_card NULLS FIRST, company_flag) = 1),
k AS (SELECT * FROM (
        SELECT o_custkey AS customer_key, o_orderpriority AS account_key, last_day(CAST(l_shipdate AS DATE)) AS _observ_end_dt, p_brand AS card_code,
               row_number() OVER (PARTITION BY o_custkey, o_orderpriority, last_day(CAST(l_shipdate AS DATE))
                                  ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey DESC, l_linenumber DESC, p_brand DESC) AS rn
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey) WHERE rn = 1)
SELECT a.*, bal.balance_unified_val AS snapshot_balance_val, {", ".join(f"pay.{m}" for m in PAYMENT_MEASURES)},
       acc.status_group, acc.arrears_30_flag, acc.arrears_60_flag, acc.arrears_90_flag, acc.arrears_balance_val, acc.max_arrears_days,
       k.card_code, coalesce(g.category, 'other') AS category, g.next_card, coalesce(g.premium_flag, 0) AS premium_flag,
       i.total_val AS instalments_val, i.paid_val AS instalments_paid_val, i.paid_ratio AS instalments_ratio,
       {", ".join(f"i.{x.lower()}_amount_val AS instalments_{x.lower()}_val" for x in INSTALMENT_GROUPS)}
FROM a LEFT JOIN bal USING (customer_key, account_key, _observ_end_dt) LEFT JOIN pay USING (customer_key, account_key, _observ_end_dt)
LEFT JOIN acc USING (customer_key, account_key, _observ_end_dt) LEFT JOIN k USING (customer_key, account_key, _observ_end_dt)
LEFT JOIN g USING (card_code) LEFT JOIN i USING (customer_key)
""")
def credit_card_node_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount",
                                             "l_returnflag", "l_linestatus", "l_shipdate")
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    p = t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    x = join_small(fact_join(li, o), p, F.col("l_partkey") == F.col("p_partkey"), "left")
    shipped, days = F.to_date("l_shipdate"), F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    x = x.select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"), F.last_day(shipped).alias("_observ_end_dt"),
        "o_orderstatus", "l_returnflag", (F.col("l_suppkey") % 2 == 0).alias("home"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        shipped.alias("shipped"), F.greatest(days, F.lit(0)).alias("late"), F.col("l_linestatus").alias("direction"),
        (F.floor(days / 30).cast("int") * 30).alias("arrears_days"), F.round(F.col("l_discount") * 100).cast("int").alias("promo_days"),
        "p_type", F.struct(shipped.alias("shipped"), "l_orderkey", "l_linenumber", "p_brand").alias("move"))
    # every part of the node in one grouped pass over one fact join; its customer grain (TR-10) is the
    # sum of the accounts' sums, added up after the pass. Movements and balances are dealt out by the
    # customer once, as narrow rows: the sixty measures are grouped, summed up per customer and meet
    # their balance where they are, and no wide row is exchanged
    balances = card_balances(spark, sf_dir).select(*ACCOUNT_MONTH, F.col("balance_unified_val").alias("snapshot_balance"))
    x = x.unionByName(balances, allowMissingColumns=True).repartition(fact_tasks(li), "customer_key")
    instalment = [F.sum("amount").alias("i_total"), total(F.col("l_returnflag") != "R").alias("i_paid"),
                  *[total(F.col("p_type") == g).alias(f"i_{g.lower()}") for g in INSTALMENT_GROUPS]]
    status = [c for c in card_account_aggs()]
    a = x.groupBy(*ACCOUNT_MONTH).agg(*card_month_measures(), *payment_aggs(), *status, F.max("move").alias("move"), *instalment,
                                      F.max("snapshot_balance").alias("snapshot_balance")).where(F.col("move").isNotNull())
    # as in a join, a null key meets no balance
    keyed = reduce(and_, [F.col(c).isNotNull() for c in ACCOUNT_MONTH])
    a = a.withColumn("snapshot_balance", F.when(keyed, F.col("snapshot_balance")))
    whole = Window.partitionBy("customer_key")
    sums = ["i_total", "i_paid", *[f"i_{g.lower()}" for g in INSTALMENT_GROUPS]]
    a = a.withColumns({c: F.sum(c).over(whole) for c in sums})
    a = add_rate(a, rates(spark, sf_dir), "_observ_end_dt", snapshot=True).withColumn("card_code", F.col("move.p_brand"))
    payments = [m.removesuffix("_val") for m in PAYMENT_MEASURES]
    a = card_month_columns(a, (*payments, *STATUS_MEASURES, "card_code", "snapshot_balance", F.col("i_total").alias("instalments"),
                               *[F.col(c).alias(f"instalments_{c[2:]}") for c in sums[1:]]))
    card = F.struct("category", "next_card", "company_flag", "premium_flag")
    cards = card_catalog(spark, sf_dir).groupBy("card_code").agg(F.min(card).alias("card")).select(
        "card_code", "card.category", "card.next_card", "card.premium_flag")
    out = join_small(a, cards, "card_code", "left")
    return fill_numeric_zero(out, ["premium_flag"]).withColumns({
        "category": F.coalesce("category", F.lit("other")),
        "instalments_ratio": F.when(F.col("instalments_val") > 0, ratio4("instalments_paid_val", "instalments_val"))})


# --- TR-31: debts of a bureau report: the applicant (customer) of the report and the bureau it came
#     from (one kind of source only), direct and indirect liabilities pivoted by kind with card rows
#     reported once per currency counted half, worst grade per link (one grade does not compete), and
#     the newest history row per link, shown only where the report holds such debt
BUREAU = {"1-URGENT": "north", "2-HIGH": "north", "3-MEDIUM": "south", "4-NOT SPECIFIED": "south"}   # others: another kind of source
DEBT_KINDS = {"A": "loan", "N": "mortgage", "R": "card"}
DEBT_LINKS = {"F": "direct", "O": "indirect"}
UNGRADED = 4


def _debt_link_sql(code: str, link: str) -> str:
    here = f"link = '{code}'"
    kinds = ", ".join(f"CAST(coalesce(sum(CASE WHEN {here} AND kind = '{k}' THEN n END), 0) AS BIGINT) AS {link}_{name}_cnt, "
                      + _val(f"coalesce(sum(CASE WHEN {here} AND kind = '{k}' THEN amount * n END), 0)", f"{link}_{name}_val")
                      for k, name in DEBT_KINDS.items())
    return (f"{kinds}, CAST(coalesce(sum(CASE WHEN {here} THEN n END), 0) AS BIGINT) AS {link}_cnt, "
            f"max(CASE WHEN {here} AND grade <> {UNGRADED} THEN grade END) AS {link}_worst_grade")


@register("debt_detail_whole", f"""
WITH x AS (SELECT l_orderkey AS report_key, l_linestatus AS link, l_returnflag AS kind, l_suppkey AS entity_key, l_linenumber AS grade,
                  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_shipdate AS DATE) AS history_date,
                  CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS late_capital FROM lineitem),
e AS (SELECT report_key, link, kind, entity_key, amount, max(CASE WHEN grade <> {UNGRADED} THEN grade END) AS grade,
             CAST(CASE WHEN kind = 'R' THEN ceil(count(*) / 2.0) ELSE count(*) END AS BIGINT) AS n FROM x GROUP BY 1, 2, 3, 4, 5),
d AS (SELECT report_key, {", ".join(_debt_link_sql(c, n) for c, n in DEBT_LINKS.items())} FROM e GROUP BY 1),
h AS (SELECT report_key, link, history_date, late_capital,
             row_number() OVER (PARTITION BY report_key, link ORDER BY history_date DESC, grade DESC, late_capital DESC) AS rn FROM x),
n AS (SELECT report_key, {", ".join(f"max(CASE WHEN link = '{c}' THEN history_date END) AS {n}_date, max(CASE WHEN link = '{c}' THEN late_capital END) AS {n}_late" for c, n in DEBT_LINKS.items())}
      FROM h WHERE rn = 1 GROUP BY 1)
SELECT d.*, o_custkey AS customer_key, last_day(CAST(o_orderdate AS DATE)) AS _observ_end_dt, c_mktsegment AS applicant_segment,
       CASE o_orderpriority {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BUREAU.items())} END AS bureau,
       {", ".join(f"CASE WHEN {n}_cnt > 0 THEN {n}_date END AS {n}_date, {_val(f'CASE WHEN {n}_cnt > 0 THEN {n}_late END', f'{n}_late_val')}" for n in DEBT_LINKS.values())}
FROM d JOIN n USING (report_key) JOIN orders ON o_orderkey = d.report_key JOIN customer ON c_custkey = o_custkey
WHERE o_orderpriority IN ({", ".join(f"'{k}'" for k in BUREAU)})
""")
def debt_detail_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("report_key"), F.col("l_linestatus").alias("link"), F.col("l_returnflag").alias("kind"),
        F.col("l_suppkey").alias("entity_key"), F.col("l_linenumber").alias("grade"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.to_date("l_shipdate").alias("history_date"), F.col("l_tax").cast("decimal(4,2)").alias("share"))
    # equal debts first (AG-11), then the report: two grouped steps over one scan, the newest history
    # row is the greatest struct of the same steps
    history = F.struct("history_date", "grade", (F.col("amount") * F.col("share")).alias("late"))
    equal = x.groupBy("report_key", "link", "kind", "entity_key", "amount").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.when(F.col("grade") != UNGRADED, F.col("grade"))).alias("grade"), F.max(history).alias("history"))
    n = F.when(F.col("kind") == "R", F.ceil(F.col("rows") / 2)).otherwise(F.col("rows")).cast("long")
    equal = equal.withColumns({"n": n, "owed": F.col("amount") * n})
    aggs = []
    for code, link in DEBT_LINKS.items():
        here = F.col("link") == code
        for k, name in DEBT_KINDS.items():
            hit = here & (F.col("kind") == k)
            aggs += [total(hit, "n").alias(f"{link}_{name}_cnt"), total(hit, "owed").alias(f"{link}_{name}")]
        aggs += [total(here, "n").alias(f"{link}_cnt"), F.max(F.when(here, F.col("grade"))).alias(f"{link}_worst_grade"),
                 F.max(F.when(here, F.col("history"))).alias(f"{link}_history")]
    d = equal.groupBy("report_key").agg(*aggs)
    for link in DEBT_LINKS.values():
        shown = F.col(f"{link}_cnt") > 0
        d = d.withColumns({f"{link}_date": F.when(shown, F.col(f"{link}_history.history_date")),
                           f"{link}_late": F.when(shown, F.col(f"{link}_history.late"))}).drop(f"{link}_history")
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_key"),
                                          F.last_day(F.to_date("o_orderdate")).alias("_observ_end_dt"),
                                          L.map_lookup("o_orderpriority", BUREAU).alias("bureau")).where(F.col("bureau").isNotNull())
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"), F.col("c_mktsegment").alias("applicant_segment"))
    reports = join_small(o, c, "customer_key", "inner")
    return to_val_columns(d.join(reports.hint("shuffle_merge"), F.col("report_key") == F.col("o_orderkey")).drop("o_orderkey"))
