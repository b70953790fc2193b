"""Integration and transformation nodes at their full grain: one row per
customer and month (or account and month), with the nodes' whole measures.

Roles on the driver tables: an account is (o_custkey, o_orderpriority), its
month the month of the order, its state o_orderstatus; movements are line
items in their shipping month. Facts are joined once per query; measures are
conditional sums of that one grouped pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions import dates as D
from featuremart.functions import lookup as L
from featuremart.functions.currency import to_home_currency
from featuremart.operators import aggregates as A
from featuremart.operators import windows as W
from featuremart.operators.columns import fill_numeric_zero, to_val_columns
from featuremart.plans.customer import _ratio4_sql, ratio4
from featuremart.operators.broadcast import join_small
from featuremart.operators.joins import add_rate, fact_join, fact_tasks, greatest_on_or_after
from featuremart.plans.inputs import FOREIGN, HOME, RATES_SQL, TRANSACTIONS_SQL, rates, t, transactions
from featuremart.plans.registry import register

MONTH = ["customer_key", "_observ_end_dt"]
STATES = {"F": "closed", "O": "current", "P": "blocked"}
MONTHS_SQL = ("CASE WHEN ({a} = last_day({a}) AND {b} = last_day({b})) OR day({a}) >= day({b}) "
              "THEN (year({a}) - year({b})) * 12 + month({a}) - month({b}) "
              "ELSE (year({a}) - year({b})) * 12 + month({a}) - month({b}) - 1 END")


def _months_sql(a: str, b: str) -> str:
    return MONTHS_SQL.format(a=a, b=b)


def _val(expr: str, name: str) -> str:
    return f"CAST(round({expr}, 2) AS DECIMAL(19,2)) AS {name}"


def _sum_sql(cond: str, value: str = "amount") -> str:
    return f"coalesce(sum(CASE WHEN {cond} THEN {value} END), 0)"


def _cnt_sql(cond: str, name: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT) AS {name}"


def total(cond: Column, value="amount") -> Column:
    return F.coalesce(A.sum_if(cond, value), F.lit(0))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account rows: key, month, state, opening day, balance, currency."""
    return t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"),
        F.last_day(F.to_date("o_orderdate")).alias("_observ_end_dt"), F.to_date("o_orderdate").alias("opened"),
        F.coalesce(L.map_lookup("o_orderstatus", STATES), F.lit("unknown")).alias("state"),
        F.when(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), FOREIGN).otherwise(HOME).alias("currency_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("balance"), "o_orderkey")


ACCOUNTS_SQL = """
  SELECT o_custkey AS customer_key, o_orderpriority AS account_key, last_day(CAST(o_orderdate AS DATE)) AS _observ_end_dt,
         CAST(o_orderdate AS DATE) AS opened,
         CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'current' WHEN 'P' THEN 'blocked' ELSE 'unknown' END AS state,
         CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 2 ELSE 1 END AS currency_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS balance, o_orderkey
  FROM orders"""


# --- IN-07 / IN-08 / IN-09: debit cards per customer and month: accounts of the card product
#     pivoted by state with their total, left joined with the month's card use
CARD_STATES = ["closed", "current", "blocked", "unknown"]


@register("debit_card_month", f"""
WITH a AS (SELECT customer_key, _observ_end_dt,
             {", ".join(_cnt_sql(f"state = '{s}'", f"{s}_cnt") for s in CARD_STATES)},
             CAST(count(*) AS BIGINT) AS cards_cnt
           FROM ({ACCOUNTS_SQL}) WHERE account_key <> '5-LOW' GROUP BY 1, 2),
u AS (SELECT customer_key, last_day(trx_date) AS _observ_end_dt, CAST(count(*) AS BIGINT) AS uses_cnt, sum(amount) AS uses,
             {_cnt_sql("currency_id = 1", "home_cnt")}, {_sum_sql("currency_id = 1")} AS home,
             {_cnt_sql("currency_id = 2", "foreign_cnt")}, {_sum_sql("currency_id = 2")} AS foreign_use,
             {_cnt_sql("direction = 'F'", "withdrawals_cnt")}, {_sum_sql("direction = 'F'")} AS withdrawals,
             {_cnt_sql("l_quantity <= 5", "inquiries_cnt")}, {_cnt_sql("l_discount = 0", "fuel_cnt")},
             {_cnt_sql("l_discount > 0.08", "transport_cnt")}, {_sum_sql("l_discount > 0.08")} AS transport
      FROM ({TRANSACTIONS_SQL}) WHERE kind <> 'R' AND account_key <> '5-LOW' GROUP BY 1, 2)
SELECT a.*, coalesce(uses_cnt, 0) AS uses_cnt, coalesce(home_cnt, 0) AS home_cnt, coalesce(foreign_cnt, 0) AS foreign_cnt,
       coalesce(withdrawals_cnt, 0) AS withdrawals_cnt, coalesce(inquiries_cnt, 0) AS inquiries_cnt,
       coalesce(fuel_cnt, 0) AS fuel_cnt, coalesce(transport_cnt, 0) AS transport_cnt,
       {_val("coalesce(uses, 0)", "uses_val")}, {_val("coalesce(home, 0)", "home_val")},
       {_val("coalesce(foreign_use, 0)", "foreign_use_val")}, {_val("coalesce(withdrawals, 0)", "withdrawals_val")},
       {_val("coalesce(transport, 0)", "transport_val")}
FROM a LEFT JOIN u USING (customer_key, _observ_end_dt)
""")
def debit_card_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = accounts(spark, sf_dir).where(F.col("account_key") != "5-LOW").groupBy(*MONTH).agg(
        *A.pivot_aggs("state", CARD_STATES, {"cnt": ("count", None)}), F.count(F.lit(1)).alias("cards_cnt"))
    x = transactions(spark, sf_dir).where((F.col("kind") != "R") & (F.col("account_key") != "5-LOW"))
    home, foreign, out = F.col("currency_id") == HOME, F.col("currency_id") == FOREIGN, F.col("direction") == "F"
    ride = F.col("l_discount") > 0.08
    u = x.groupBy("customer_key", F.last_day("trx_date").alias("_observ_end_dt")).agg(
        F.count(F.lit(1)).alias("uses_cnt"), F.sum("amount").alias("uses"),
        A.count_if(home).alias("home_cnt"), total(home).alias("home"),
        A.count_if(foreign).alias("foreign_cnt"), total(foreign).alias("foreign_use"),
        A.count_if(out).alias("withdrawals_cnt"), total(out).alias("withdrawals"),
        A.count_if(F.col("l_quantity") <= 5).alias("inquiries_cnt"),
        A.count_if(F.col("l_discount") == 0).alias("fuel_cnt"),
        A.count_if(ride).alias("transport_cnt"), total(ride).alias("transport"))
    use = [c for c in u.columns if c not in MONTH]
    return to_val_columns(fill_numeric_zero(a.join(u, MONTH, "left"), use))


# --- TR-41 / TR-42 / TR-47 / CL-45: savings accounts per month: state looked up, days and months in
#     force, balance by currency, left joined with the account's movements by direction, currency
#     and kind; IN-15: the customer's seventeen measures
MOVES = [("credits", "F"), ("debits", "O")]
CURRENCIES = [("home", HOME), ("foreign", FOREIGN)]
KINDS = [("notes", "A"), ("deposits", "N"), ("withdrawals", "R")]


def _moves_sql() -> str:
    parts = []
    for name, d in MOVES:
        for cur, code in CURRENCIES:
            hit = f"direction = '{d}' AND currency_id = {code}"
            parts += [_cnt_sql(hit, f"{name}_{cur}_cnt"), f"{_sum_sql(hit)} AS {name}_{cur}"]
    for name, k in KINDS:
        parts += [_cnt_sql(f"kind = '{k}'", f"{name}_cnt"), f"{_sum_sql(f'''kind = '{k}' ''')} AS {name}"]
    return ", ".join(parts)


SAVINGS_SQL = f"""
  SELECT a.*, m.* EXCLUDE (customer_key, account_key, _observ_end_dt) FROM (
    SELECT customer_key, account_key, _observ_end_dt, min(opened) AS opened, max(state) AS state,
           {_sum_sql("currency_id = 1", "balance")} AS balance_home, {_sum_sql("currency_id = 2", "balance")} AS balance_foreign
    FROM ({ACCOUNTS_SQL}) GROUP BY 1, 2, 3) a
  LEFT JOIN (SELECT customer_key, account_key, last_day(trx_date) AS _observ_end_dt, {_moves_sql()}
             FROM ({TRANSACTIONS_SQL}) GROUP BY 1, 2, 3) m
  ON m.customer_key = a.customer_key AND m.account_key = a.account_key AND m._observ_end_dt = a._observ_end_dt"""
SAVING_SUMS = [f"{m}_{c}" for m, _ in MOVES for c, _ in CURRENCIES] + [k for k, _ in KINDS]
SAVING_COUNTS = [f"{c}_cnt" for c in SAVING_SUMS]


@register("saving_account_month", f"""
SELECT customer_key, account_key, _observ_end_dt, opened, state,
       CAST(_observ_end_dt - opened AS INTEGER) AS days_in_force, CAST({_months_sql("_observ_end_dt", "opened")} AS INTEGER) AS months_in_force,
       {_val("balance_home", "balance_home_val")}, {_val("balance_foreign", "balance_foreign_val")},
       {", ".join(f"coalesce({c}, 0) AS {c}" for c in SAVING_COUNTS)},
       {", ".join(_val(f"coalesce({c}, 0)", f"{c}_val") for c in SAVING_SUMS)}
FROM ({SAVINGS_SQL})
""")
def saving_account_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_val_columns(savings(spark, sf_dir))


def savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["customer_key", "account_key", "_observ_end_dt"]
    a = accounts(spark, sf_dir).groupBy(*key).agg(
        F.min("opened").alias("opened"), F.max("state").alias("state"),
        total(F.col("currency_id") == HOME, "balance").alias("balance_home"),
        total(F.col("currency_id") == FOREIGN, "balance").alias("balance_foreign")) \
        .withColumn("days_in_force", F.datediff("_observ_end_dt", "opened")) \
        .withColumn("months_in_force", D.whole_months_between("_observ_end_dt", "opened"))
    aggs = []
    for name, d in MOVES:
        for cur, code in CURRENCIES:
            hit = (F.col("direction") == d) & (F.col("currency_id") == code)
            aggs += [A.count_if(hit).alias(f"{name}_{cur}_cnt"), total(hit).alias(f"{name}_{cur}")]
    for name, k in KINDS:
        aggs += [A.count_if(F.col("kind") == k).alias(f"{name}_cnt"), total(F.col("kind") == k).alias(name)]
    m = transactions(spark, sf_dir).groupBy(
        "customer_key", "account_key", F.last_day("trx_date").alias("_observ_end_dt")).agg(*aggs)
    return fill_numeric_zero(a.join(m, key, "left"), SAVING_COUNTS + SAVING_SUMS)


@register("saving_month", f"""
WITH s AS (SELECT customer_key, account_key, _observ_end_dt, opened, state, balance_home, balance_foreign,
                  {", ".join(f"coalesce({c}, 0) AS {c}" for c in SAVING_COUNTS + SAVING_SUMS)} FROM ({SAVINGS_SQL}))
SELECT customer_key, _observ_end_dt,
       {_val(_sum_sql("state = 'current'", "balance_home"), "balance_home_sum_val")},
       {_val(_sum_sql("state = 'current'", "balance_foreign"), "balance_foreign_sum_val")},
       {_val("sum(credits_home)", "credits_home_val")}, {_val("sum(credits_home + credits_foreign)", "credits_all_val")},
       CAST(sum(credits_home_cnt + credits_foreign_cnt) AS BIGINT) AS credits_all_cnt,
       {_val("sum(debits_home)", "debits_home_val")}, {_val("sum(debits_home + debits_foreign)", "debits_all_val")},
       CAST(sum(debits_home_cnt) AS BIGINT) AS debits_home_cnt,
       CAST(sum(debits_home_cnt + debits_foreign_cnt) AS BIGINT) AS debits_all_cnt,
       {_val("sum(notes)", "notes_val")}, CAST(sum(notes_cnt) AS BIGINT) AS notes_cnt,
       {_val("sum(deposits)", "deposits_val")}, CAST(sum(deposits_cnt) AS BIGINT) AS deposits_cnt,
       {_val("sum(withdrawals)", "withdrawals_val")}, CAST(sum(withdrawals_cnt) AS BIGINT) AS withdrawals_cnt,
       min(opened) AS first_opened, CAST({_months_sql("_observ_end_dt", "min(opened)")} AS INTEGER) AS months_since_first_cnt,
       CAST(max(CASE WHEN state = 'current' THEN {_months_sql("_observ_end_dt", "opened")} END) AS INTEGER) AS current_months_cnt
FROM s GROUP BY 1, 2
""")
def saving_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = F.col("state") == "current"

    def both(name: str) -> Column:
        return F.sum(F.col(f"{name}_home") + F.col(f"{name}_foreign"))

    def counts(name: str) -> Column:
        return F.sum(F.col(f"{name}_home_cnt") + F.col(f"{name}_foreign_cnt")).alias(f"{name}_all_cnt")

    return to_val_columns(savings(spark, sf_dir).groupBy(*MONTH).agg(
        total(current, "balance_home").alias("balance_home_sum"), total(current, "balance_foreign").alias("balance_foreign_sum"),
        F.sum("credits_home").alias("credits_home"), both("credits").alias("credits_all"), counts("credits"),
        F.sum("debits_home").alias("debits_home"), both("debits").alias("debits_all"),
        F.sum("debits_home_cnt").alias("debits_home_cnt"), counts("debits"),
        *[F.sum(c).alias(c) for k, _ in KINDS for c in (k, f"{k}_cnt")],
        F.min("opened").alias("first_opened"),
        D.whole_months_between("_observ_end_dt", F.min("opened")).alias("months_since_first_cnt"),
        F.max(F.when(current, F.col("months_in_force"))).alias("current_months_cnt")))


# --- TR-38 / TR-46: loans: six ageing flags from the bucket, three amounts in home, foreign and
#     converted views at the rate of the month's last day (a month end without a rate leaves the
#     converted foreign amounts null), product flags
AGEING = ["current", "30_days", "60_days", "90_days", "120_days", "180_days", "over_180"]


def _three_sql(amount: str, name: str) -> str:
    return (f"{_val(f'CASE WHEN currency_id = 1 THEN {amount} ELSE 0 END', f'{name}_home_val')}, "
            f"{_val(f'CASE WHEN currency_id = 2 THEN {amount} ELSE 0 END', f'{name}_foreign_val')}, "
            f"{_val(f'CASE WHEN currency_id = 2 THEN {amount} * rate ELSE {amount} END', f'{name}_converted_val')}")


def three_views(amount: str, name: str) -> list[Column]:
    a, foreign, none = F.col(amount), F.col("currency_id") == FOREIGN, F.lit(0).cast("decimal(18,4)")
    return [F.when(foreign, none).otherwise(a).alias(f"{name}_home"), F.when(foreign, a).otherwise(none).alias(f"{name}_foreign"),
            to_home_currency("currency_id", amount, "rate", HOME).alias(f"{name}_converted")]


@register("loan_ageing", f"""
WITH r AS ({RATES_SQL}),
l AS (SELECT l_orderkey AS loan_key, l_linenumber AS part_no, o_custkey AS customer_key, last_day(CAST(l_shipdate AS DATE)) AS _observ_end_dt,
                  CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 2 END AS currency_id,
                  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS saldo,
                  CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS quota,
                  CAST(floor((CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE)) / 15) AS INTEGER) AS late,
                  l_returnflag, o_orderpriority, r.rate
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN r ON r.rate_date = last_day(CAST(l_shipdate AS DATE)))
SELECT loan_key, part_no, customer_key, _observ_end_dt,
       {", ".join(f"CAST(CASE WHEN late > {i} THEN 1 ELSE 0 END AS INTEGER) AS aged_{d}_flag" for i, d in enumerate((30, 60, 90, 120, 180, 181)))},
       {_three_sql("amount", "loan")}, {_three_sql("saldo", "balance")}, {_three_sql("quota", "quota")},
       CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND l_returnflag = 'N' THEN 1 ELSE 0 END AS INTEGER) AS consumer_flag,
       CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS INTEGER) AS secured_flag
FROM l
""")
def loan_ageing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    x = fact_join(li, o)
    steps = F.floor(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")) / 15).cast("int")
    bucket = F.element_at(F.array(*map(F.lit, AGEING)), F.least(F.greatest(steps, F.lit(0)), F.lit(len(AGEING) - 1)) + 1)
    money = lambda e: e.cast("decimal(18,2)")
    share = lambda c: money(F.col("l_extendedprice")) * F.col(c).cast("decimal(4,2)")
    x = x.select(F.col("l_orderkey").alias("loan_key"), F.col("l_linenumber").alias("part_no"),
                 F.col("o_custkey").alias("customer_key"), F.last_day(F.to_date("l_shipdate")).alias("_observ_end_dt"),
                 F.when(F.col("l_suppkey") % 2 == 0, HOME).otherwise(FOREIGN).alias("currency_id"), bucket.alias("ageing"),
                 money(F.col("l_extendedprice")).alias("amount"), share("l_discount").alias("saldo"),
                 share("l_tax").alias("quota"), "l_returnflag", "o_orderpriority")
    x = add_rate(x, rates(spark, sf_dir), "_observ_end_dt", snapshot=True)
    flags = [L.in_list_flag("ageing", AGEING[:i + 1], negate=True).alias(f"aged_{d}_flag")
             for i, d in enumerate((30, 60, 90, 120, 180, 181))]
    consumer = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("l_returnflag") == "N")
    return to_val_columns(x.select(
        "loan_key", "part_no", "customer_key", "_observ_end_dt", *flags, *three_views("amount", "loan"),
        *three_views("saldo", "balance"), *three_views("quota", "quota"),
        F.when(consumer, 1).otherwise(0).alias("consumer_flag"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("secured_flag")))


# --- IN-05: card profile per customer and month: first opening, company cards, balances and
#     utilisation of valid accounts, arrears maxima, newest past-due account, best account (highest
#     grade, newest first) with and without valid add-ons, states with total, arrears pivoted by
#     days late and by cycle, valid add-ons, card use with the average purchase
VALID = ["current", "blocked"]
LATE_STEP, LATE_BUCKETS, CYCLES = 5, [0, 5, 10, 15, 20], ["late_10", "late_20", "late_over_20"]
CARD_USES = ["addons_cnt", "uses_cnt", "uses", "withdrawals_cnt", "withdrawals", "purchases_cnt", "purchases", "home_uses_cnt", "foreign_uses_cnt"]
_VALID_SQL = "state IN ('current', 'blocked')"


def _bucket_sql(cur: str, code: int) -> str:
    parts = []
    for b in LATE_BUCKETS:
        hit = f"{_VALID_SQL} AND currency_id = {code} AND late_days <= {LATE_BUCKETS[-1]} AND late_days // {LATE_STEP} * {LATE_STEP} = {b}"
        parts.append(f"{_cnt_sql(hit, f'{cur}_late_{b}_cnt')}, {_sum_sql(hit, 'balance')} AS {cur}_late_{b}_balance")
    return ", ".join(parts)


_CYCLE_SQL = f"CASE WHEN {_VALID_SQL} AND late_days >= 10 THEN CASE WHEN late_days // 10 <= 2 THEN 'late_' || late_days // 10 * 10 ELSE 'late_over_20' END END"
_USES_SQL = f"""
  SELECT l_orderkey, {_cnt_sql("l_linestatus = 'F' AND l_returnflag IN ('A', 'N')", "addons_cnt")}, CAST(count(*) AS BIGINT) AS uses_cnt, sum(amount) AS uses,
         {_cnt_sql("l_returnflag = 'R'", "withdrawals_cnt")}, {_sum_sql("l_returnflag = 'R'")} AS withdrawals,
         {_cnt_sql("l_returnflag = 'N'", "purchases_cnt")}, {_sum_sql("l_returnflag = 'N'")} AS purchases,
         {_cnt_sql("l_suppkey % 2 = 0", "home_uses_cnt")}, {_cnt_sql("l_suppkey % 2 <> 0", "foreign_uses_cnt")}
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem) GROUP BY 1"""


@register("card_profile_month", f"""
WITH u AS ({_USES_SQL}),
a AS (SELECT x.*, CAST(substr(account_key, 1, 1) AS INTEGER) AS grade, balance * 2 AS credit_limit,
             CAST(_observ_end_dt - opened AS INTEGER) AS late_days, {", ".join(f"coalesce(u.{c}, 0) AS {c}" for c in CARD_USES)}
      FROM ({ACCOUNTS_SQL}) x LEFT JOIN u ON u.l_orderkey = x.o_orderkey),
c AS (SELECT *, {_CYCLE_SQL} AS cycle,
             row_number() OVER (PARTITION BY customer_key, _observ_end_dt ORDER BY CASE WHEN late_days >= 20 THEN 1 ELSE 0 END DESC, opened DESC, o_orderkey DESC) AS rn,
             row_number() OVER (PARTITION BY customer_key, _observ_end_dt ORDER BY grade DESC, opened DESC, o_orderkey DESC) AS best,
             row_number() OVER (PARTITION BY customer_key, _observ_end_dt, addons_cnt = 0 ORDER BY grade DESC, opened DESC, o_orderkey DESC) AS best_alone FROM a),
g AS (SELECT customer_key, _observ_end_dt, min(opened) AS first_opened,
             CAST(max(CASE WHEN grade = 1 THEN 1 ELSE 0 END) AS INTEGER) AS company_flag, {_cnt_sql("grade = 1", "company_cnt")},
             sum(CASE WHEN {_VALID_SQL} THEN balance END) AS balance, sum(CASE WHEN {_VALID_SQL} THEN credit_limit END) AS credit_limit,
             CAST(max(CASE WHEN {_VALID_SQL} AND late_days >= 10 THEN 1 WHEN {_VALID_SQL} THEN 0 END) AS INTEGER) AS late_10_flag,
             CAST(max(CASE WHEN {_VALID_SQL} AND late_days >= 20 THEN 1 WHEN {_VALID_SQL} THEN 0 END) AS INTEGER) AS late_20_flag,
             max(CASE WHEN {_VALID_SQL} THEN late_days END) AS max_late_days,
             max(CASE WHEN {_VALID_SQL} AND currency_id = 1 THEN late_days END) AS max_late_home,
             max(CASE WHEN {_VALID_SQL} AND currency_id = 2 THEN late_days END) AS max_late_foreign,
             max(CASE WHEN rn = 1 THEN opened END) AS past_due_opened, max(CASE WHEN best = 1 THEN account_key END) AS best_account,
             max(CASE WHEN best_alone = 1 AND addons_cnt = 0 THEN account_key END) AS best_account_no_addon,
             {", ".join(_cnt_sql(f"state = '{s}'", f"{s}_cnt") for s in CARD_STATES)},
             {_bucket_sql("home", 1)}, {_bucket_sql("foreign", 2)},
             {", ".join(_sum_sql(f"cycle = '{k}'", "balance") + f" AS {k}_balance" for k in CYCLES)},
             {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" if c.endswith("_cnt") else f"sum({c}) AS {c}" for c in CARD_USES)}
      FROM c GROUP BY 1, 2)
SELECT customer_key, _observ_end_dt, first_opened, company_flag, company_cnt, late_10_flag, late_20_flag, max_late_days, max_late_home, max_late_foreign,
       past_due_opened, best_account, best_account_no_addon, {", ".join(f"{s}_cnt" for s in CARD_STATES)},
       {", ".join(f"{cur}_late_{b}_cnt, {_val(f'{cur}_late_{b}_balance', f'{cur}_late_{b}_balance_val')}" for cur, _ in CURRENCIES for b in LATE_BUCKETS)},
       {", ".join(_val(f"{k}_balance", f"{k}_balance_val") for k in CYCLES)},
       {", ".join(c if c.endswith("_cnt") else _val(c, f"{c}_val") for c in CARD_USES)},
       {_val("CASE WHEN purchases_cnt > 0 THEN CAST((CAST(purchases * 100 AS HUGEINT) * 2 + purchases_cnt) // (2 * purchases_cnt) AS DECIMAL(19,2)) * 0.01 END", "average_purchase_val")},
       {_val("balance", "balance_val")}, {_val("credit_limit", "credit_limit_val")},
       CASE WHEN credit_limit > 0 THEN {_ratio4_sql("balance", "credit_limit")} END AS utilisation_ratio,
       CAST(current_cnt + blocked_cnt AS BIGINT) AS cards_total_cnt,
       CAST(CASE WHEN first_opened >= DATE '1998-06-01' THEN 0 ELSE 1 END AS INTEGER) AS opened_before_flag
FROM g
""")
def card_profile_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    # card use and add-ons per account first: one pass over the movements, one join to the accounts
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus",
                                             F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    kind, home_use = F.col("l_returnflag"), F.col("l_suppkey") % 2 == 0
    uses = li.groupBy("l_orderkey").agg(
        A.count_if((F.col("l_linestatus") == "F") & kind.isin("A", "N")).alias("addons_cnt"), F.count(F.lit(1)).alias("uses_cnt"), F.sum("amount").alias("uses"),
        A.count_if(kind == "R").alias("withdrawals_cnt"), total(kind == "R").alias("withdrawals"),
        A.count_if(kind == "N").alias("purchases_cnt"), total(kind == "N").alias("purchases"),
        A.count_if(home_use).alias("home_uses_cnt"), A.count_if(~home_use).alias("foreign_uses_cnt"))
    a = accounts(spark, sf_dir).join(uses.hint("shuffle_merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    a = fill_numeric_zero(a, CARD_USES).withColumns({
        "grade": F.substring("account_key", 1, 1).cast("int"), "credit_limit": F.col("balance") * 2,
        "late_days": F.datediff("_observ_end_dt", "opened")})
    valid = F.col("state").isin(*VALID)
    cycle = F.when(valid & (F.col("late_days") >= 10), F.when(F.floor(F.col("late_days") / 10) <= 2, F.concat(
        F.lit("late_"), (F.floor(F.col("late_days") / 10) * 10).cast("string"))).otherwise("late_over_20"))
    a = a.withColumns({"cycle": cycle, "late_bucket": F.when(valid & (F.col("late_days") <= LATE_BUCKETS[-1]), A.bucket(
        F.floor(F.col("late_days") / LATE_STEP), LATE_STEP, LATE_BUCKETS[-1] // LATE_STEP))})

    def late(days: int) -> Column:
        return F.max(F.when(valid, (F.col("late_days") >= days).cast("int")))

    # the newest past-due and the best account are greatest structs of the same pass, no window
    newest = F.max(F.struct((F.col("late_days") >= 20).cast("int").alias("due"), "opened", "o_orderkey"))
    rank = F.struct("grade", "opened", "o_orderkey", "account_key")
    buckets = []
    for cur, code in CURRENCIES:
        for b in LATE_BUCKETS:
            hit = (F.col("late_bucket") == b) & (F.col("currency_id") == code)
            buckets += [A.count_if(hit).alias(f"{cur}_late_{b}_cnt"), total(hit, "balance").alias(f"{cur}_late_{b}_balance")]
    g = a.groupBy(*MONTH).agg(
        F.min("opened").alias("first_opened"), A.any_flag(F.col("grade") == 1).alias("company_flag"),
        A.count_if(F.col("grade") == 1).alias("company_cnt"),
        A.sum_if(valid, "balance").alias("balance"), A.sum_if(valid, "credit_limit").alias("credit_limit"),
        late(10).alias("late_10_flag"), late(20).alias("late_20_flag"),
        F.max(F.when(valid, F.col("late_days"))).alias("max_late_days"),
        *[F.max(F.when(valid & (F.col("currency_id") == code), F.col("late_days"))).alias(f"max_late_{cur}")
          for cur, code in CURRENCIES],
        newest.alias("newest"), F.max(rank).alias("best"), F.max(F.when(F.col("addons_cnt") == 0, rank)).alias("alone"),
        *A.pivot_aggs("state", CARD_STATES, {"cnt": ("count", None)}), *buckets,
        *[total(F.col("cycle") == k, "balance").alias(f"{k}_balance") for k in CYCLES], *[F.sum(c).alias(c) for c in CARD_USES])
    g = g.withColumns({
        "past_due_opened": F.col("newest.opened"), "best_account": F.col("best.account_key"),
        "best_account_no_addon": F.col("alone.account_key"), "cards_total_cnt": F.col("current_cnt") + F.col("blocked_cnt"),
        "average_purchase": F.when(F.col("purchases_cnt") > 0, F.col("purchases") / F.col("purchases_cnt")),
        "opened_before_flag": F.when(F.col("first_opened") >= F.lit("1998-06-01").cast("date"), 0).otherwise(1)})
    return to_val_columns(g.drop("newest", "best", "alone")).withColumn("utilisation_ratio", F.when(
        F.col("credit_limit_val") > 0, ratio4("balance_val", "credit_limit_val")))


# --- IN-11: the latest report per customer and month
@register("latest_report_customer_month", """
SELECT customer_key, _observ_end_dt, report_key, report_date, CAST(amount AS DECIMAL(19,2)) AS amount_val FROM (
  SELECT o_custkey AS customer_key, last_day(CAST(o_orderdate AS DATE)) AS _observ_end_dt, o_orderkey AS report_key,
         CAST(o_orderdate AS DATE) AS report_date, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         row_number() OVER (PARTITION BY o_custkey, last_day(CAST(o_orderdate AS DATE)) ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""")
def latest_report_customer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), F.last_day(F.to_date("o_orderdate")).alias("_observ_end_dt"),
        F.col("o_orderkey").alias("report_key"), F.to_date("o_orderdate").alias("report_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return to_val_columns(W.top_n_per_group(o, MONTH, [("report_date", "desc"), ("report_key", "desc")]))


# --- IN-12: the latest debt row per customer, month, product, entity and state
@register("latest_debt_state", """
SELECT customer_key, _observ_end_dt, product, entity_key, state, debt_key, CAST(amount AS DECIMAL(19,2)) AS amount_val FROM (
  SELECT o_custkey AS customer_key, last_day(CAST(o_orderdate AS DATE)) AS _observ_end_dt, l_returnflag AS product,
         l_suppkey AS entity_key, l_linestatus AS state, l_orderkey AS debt_key, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         row_number() OVER (PARTITION BY o_custkey, last_day(CAST(o_orderdate AS DATE)), l_returnflag, l_suppkey, l_linestatus
                            ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey) WHERE rn = 1
""")
def latest_debt_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_key"),
                                          F.last_day(F.to_date("o_orderdate")).alias("_observ_end_dt"))
    li = t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("debt_key"), "l_linenumber", F.col("l_returnflag").alias("product"),
        F.col("l_suppkey").alias("entity_key"), F.col("l_linestatus").alias("state"),
        F.to_date("l_shipdate").alias("moved"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    x = fact_join(li, o, "debt_key")
    key = [*MONTH, "product", "entity_key", "state"]
    top = W.top_n_per_group(x, key, [("moved", "desc"), ("debt_key", "desc"), ("l_linenumber", "desc")])
    return to_val_columns(top.select(*key, "debt_key", "amount"))


# --- TR-30: request -> the greatest granted loan of the same customer and bureau id dated on or after
#     the request, else the greatest loan of the request's case and customer. Events play the requests
#     (26 years back, into the loans' calendar); a case is the loan office, here one per priority
CASES = {"1-URGENT": "click", "2-HIGH": "error", "3-MEDIUM": "purchase", "4-NOT SPECIFIED": "signup", "5-LOW": "view"}


@register("request_loan", f"""
WITH r AS (SELECT event_id AS request_key, user_id AS customer_key, event_type AS case_key,
                  CAST(CAST(ts AS DATE) - INTERVAL 312 MONTH AS DATE) AS asked_on, CAST(event_id % 5 + 1 AS VARCHAR) AS bureau_key FROM events),
l AS (SELECT o_custkey AS customer_key, substr(o_orderpriority, 1, 1) AS bureau_key, CAST(o_orderdate AS DATE) AS granted_on, o_orderkey AS loan
      FROM orders WHERE o_orderstatus = 'F'),
c AS (SELECT o_custkey AS customer_key, CASE o_orderpriority {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CASES.items())} END AS case_key,
             max(o_orderkey) AS case_loan FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1, 2),
d AS (SELECT r.request_key, max(l.loan) AS loan FROM r JOIN l ON l.customer_key = r.customer_key AND l.bureau_key = r.bureau_key
      AND l.granted_on >= r.asked_on GROUP BY 1)
SELECT r.request_key, r.customer_key, r.case_key, r.asked_on, coalesce(d.loan, c.case_loan) AS loan_key, d.loan IS NOT NULL AS direct
FROM r LEFT JOIN d USING (request_key) LEFT JOIN c ON c.customer_key = r.customer_key AND c.case_key = r.case_key
""")
def request_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = t(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_key"), F.col("user_id").alias("customer_key"), F.col("event_type").alias("case_key"),
        F.add_months(F.to_date("ts"), -312).alias("asked_on"), (F.col("event_id") % 5 + 1).cast("string").alias("bureau_key"))
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), "o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("granted_on"),
        F.col("o_orderkey").alias("loan"))
    granted = o.where(F.col("o_orderstatus") == "F").withColumn("bureau_key", F.substring("o_orderpriority", 1, 1))
    direct = greatest_on_or_after(r, granted, ["customer_key", "bureau_key"], "asked_on", "granted_on", "loan", "direct_loan")
    cases = o.where(F.col("o_orderstatus") != "O").groupBy(
        "customer_key", L.map_lookup("o_orderpriority", CASES).alias("case_key")).agg(F.max("loan").alias("case_loan"))
    return direct.join(cases, ["case_key", "customer_key"], "left").select(
        "request_key", "customer_key", "case_key", "asked_on", F.coalesce("direct_loan", "case_loan").alias("loan_key"),
        F.col("direct_loan").isNotNull().alias("direct"))


# --- TR-33: debts reported once per currency: the pair's worst state by precedence (an unreported
#     or current side gives way to the other), the amount counted once
PRECEDENCE = {"A": 2, "N": 1, "R": 3}  # N: current, gives way; R: worst


@register("two_currency_states", """
WITH x AS (SELECT o_custkey AS customer_key, l_orderkey AS report_key, l_partkey AS debt_key, l_suppkey % 2 AS cur,
                  l_returnflag AS state, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
p AS (SELECT customer_key, report_key, debt_key % 3 AS debt_kind,
             max(CASE WHEN cur = 0 THEN CASE state WHEN 'R' THEN 3 WHEN 'A' THEN 2 WHEN 'N' THEN 1 END END) AS home_rank,
             max(CASE WHEN cur = 1 THEN CASE state WHEN 'R' THEN 3 WHEN 'A' THEN 2 WHEN 'N' THEN 1 END END) AS foreign_rank,
             max(CASE WHEN cur = 0 THEN amount END) AS home_amount, max(CASE WHEN cur = 1 THEN amount END) AS foreign_amount
      FROM x GROUP BY 1, 2, 3)
SELECT customer_key, report_key, debt_kind,
       CASE greatest(coalesce(home_rank, 0), coalesce(foreign_rank, 0)) WHEN 3 THEN 'R' WHEN 2 THEN 'A' WHEN 1 THEN 'N' END AS worst_state,
       CAST(coalesce(home_amount, foreign_amount) AS DECIMAL(19,2)) AS granted_val,
       home_rank IS NOT NULL AND foreign_rank IS NOT NULL AS both_currencies
FROM p
""")
def two_currency_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_key"))
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    x = fact_join(li, o)
    rank = L.map_lookup("l_returnflag", PRECEDENCE)
    home, amount = F.col("l_suppkey") % 2 == 0, F.col("l_extendedprice").cast("decimal(18,2)")
    p = x.groupBy("customer_key", F.col("l_orderkey").alias("report_key"), (F.col("l_partkey") % 3).alias("debt_kind")).agg(
        F.max(F.when(home, rank)).alias("home_rank"), F.max(F.when(~home, rank)).alias("foreign_rank"),
        F.max(F.when(home, amount)).alias("home_amount"), F.max(F.when(~home, amount)).alias("foreign_amount"))
    worst = F.greatest("home_rank", "foreign_rank")  # greatest skips the side that is not reported
    return p.select("customer_key", "report_key", "debt_kind",
                    L.map_lookup(worst, {v: k for k, v in PRECEDENCE.items()}).alias("worst_state"),
                    F.coalesce("home_amount", "foreign_amount").cast("decimal(19,2)").alias("granted_val"),
                    (F.col("home_rank").isNotNull() & F.col("foreign_rank").isNotNull()).alias("both_currencies"))


# --- TR-32: bureau history: the newest 18 reports of a customer; the newest takes its grade from the
#     debt detail, older ones from the history itself
@register("history_18_graded", """
WITH d AS (SELECT l_orderkey, max(CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 ELSE 1 END) AS detail_grade FROM lineitem GROUP BY 1),
r AS (SELECT o_custkey AS customer_key, o_orderkey AS report_key, CAST(o_orderdate AS DATE) AS report_date,
             CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS own_grade,
             CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS INTEGER) AS record_no FROM orders)
SELECT r.customer_key, r.report_key, r.report_date, r.record_no,
       CASE WHEN record_no = 1 THEN coalesce(d.detail_grade, own_grade) ELSE own_grade END AS grade
FROM r LEFT JOIN d ON d.l_orderkey = r.report_key WHERE record_no <= 18
""")
def history_18_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderkey").alias("report_key"),
        F.to_date("o_orderdate").alias("report_date"), F.substring("o_orderpriority", 1, 1).cast("int").alias("own_grade"))
    last = W.last_n_records(o, ["customer_key"], [("report_date", "desc"), ("report_key", "desc")], 18)
    detail = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("report_key")).agg(
        F.max(F.coalesce(L.map_lookup("l_returnflag", {"R": 3, "A": 2}), F.lit(1))).alias("detail_grade"))
    j = last.join(detail.hint("shuffle_merge"), "report_key", "left")
    grade = F.when(F.col("record_no") == 1, F.coalesce("detail_grade", "own_grade")).otherwise(F.col("own_grade"))
    return j.select("customer_key", "report_key", "report_date", "record_no", grade.alias("grade"))


# --- AG-04 / AG-13: amount, balance and count pivoted by debt condition, row totals that leave one
#     condition out, and their average per movement
CONDITIONS = {"A": "overdue", "N": "current", "R": "written_off"}


@register("debt_conditions", f"""
WITH g AS (SELECT customer_key, last_day(trx_date) AS _observ_end_dt,
  {", ".join(f"{_sum_sql(f'''kind = '{k}' ''')} AS {n}_amount, {_sum_sql(f'''kind = '{k}' ''', 'amount * CAST(l_discount AS DECIMAL(4,2))')} AS {n}_balance, {_cnt_sql(f'''kind = '{k}' ''', f'{n}_cnt')}" for k, n in CONDITIONS.items())}
  FROM ({TRANSACTIONS_SQL}) GROUP BY 1, 2)
SELECT customer_key, _observ_end_dt, {", ".join(f"{n}_cnt" for n in CONDITIONS.values())},
       {", ".join(f"{_val(f'{n}_amount', f'{n}_amount_val')}, {_val(f'{n}_balance', f'{n}_balance_val')}" for n in CONDITIONS.values())},
       CAST(overdue_cnt + current_cnt AS BIGINT) AS open_cnt, {_val("overdue_amount + current_amount", "open_amount_val")},
       CASE WHEN overdue_cnt + current_cnt > 0 THEN {_ratio4_sql("(overdue_amount + current_amount)", "(overdue_cnt + current_cnt)")} END AS open_average
FROM g
""")
def debt_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = transactions(spark, sf_dir).withColumns({
        "condition": L.map_lookup("kind", CONDITIONS),
        "owed": F.col("amount") * F.col("l_discount").cast("decimal(4,2)")})
    g = x.groupBy("customer_key", F.last_day("trx_date").alias("_observ_end_dt")).agg(*A.pivot_aggs(
        "condition", list(CONDITIONS.values()),
        {"amount": ("sum", "amount"), "balance": ("sum", "owed"), "cnt": ("count", None)}))
    g = A.horizontal_total(g, "open_cnt", ["overdue_cnt", "current_cnt"])
    g = A.horizontal_total(g, "open_amount", ["overdue_amount", "current_amount"])
    return to_val_columns(g).withColumn("open_average", F.when(
        F.col("open_cnt") > 0, ratio4("open_amount_val", "open_cnt")))


# --- CL-10 / CL-12 / TR-06: card accounts per month: statement (returned items stand for it) beside
#     the account, limit with its fall-back, worst of the two currencies, payment date, row totals of
#     the balances, arrears by currency converted at the month end's rate, limit-change flag
@register("card_account_month", f"""
WITH r AS ({RATES_SQL}),
x AS (SELECT o_custkey AS customer_key, o_orderpriority AS account_key, last_day(CAST(l_shipdate AS DATE)) AS _observ_end_dt,
             o_orderstatus, l_suppkey % 2 = 0 AS home, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag,
             CAST(l_shipdate AS DATE) AS shipped, greatest(CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER), 0) AS late
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
a AS (SELECT customer_key, account_key, _observ_end_dt,
             {_sum_sql("o_orderstatus = 'O'")} AS limit_home, {_sum_sql("o_orderstatus <> 'O'")} AS limit_foreign,
             {_sum_sql("home")} AS balance_home, {_sum_sql("NOT home")} AS balance_foreign,
             coalesce(max(CASE WHEN home THEN late END), 0) AS late_home, coalesce(max(CASE WHEN NOT home THEN late END), 0) AS late_foreign,
             max(CASE WHEN l_returnflag = 'R' THEN shipped END) AS statement_date,
             sum(CASE WHEN l_returnflag = 'R' AND home THEN amount END) AS paid_home,
             sum(CASE WHEN l_returnflag = 'R' AND NOT home THEN amount END) AS paid_foreign,
             CAST(CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 1 ELSE 0 END AS INTEGER) AS limit_change_flag
      FROM x GROUP BY 1, 2, 3),
c AS (SELECT a.*, r.rate, greatest(late_home, late_foreign) AS late_days,
             CASE WHEN balance_home > 0 THEN late_home // 30 ELSE 0 END AS cycle_home,
             CASE WHEN balance_foreign > 0 THEN late_foreign // 30 ELSE 0 END AS cycle_foreign
      FROM a LEFT JOIN r ON r.rate_date = a._observ_end_dt)
SELECT customer_key, account_key, _observ_end_dt, statement_date,
       CASE WHEN account_key = '1-URGENT' THEN CAST(statement_date + INTERVAL 1 MONTH AS DATE) - 5
            WHEN account_key = '2-HIGH' THEN CAST(statement_date + INTERVAL 1 MONTH AS DATE) - 6
            ELSE CAST(statement_date + INTERVAL 1 MONTH AS DATE) END AS payment_date,
       {_val("CASE WHEN limit_home > 0 THEN limit_home ELSE limit_foreign * 8 END", "credit_limit_val")},
       {_val("balance_home", "balance_home_val")}, {_val("balance_foreign", "balance_foreign_val")},
       {_val("balance_home + balance_foreign * rate", "balance_converted_val")},
       {_val("paid_home", "paid_home_val")}, {_val("paid_foreign", "paid_foreign_val")},
       late_home, late_foreign, late_days, cycle_home, cycle_foreign, greatest(cycle_home, cycle_foreign) AS max_cycle,
       CAST(CASE WHEN late_days = 0 THEN 0 ELSE 1 END AS INTEGER) AS late_30_flag,
       CAST(CASE WHEN late_days < 60 THEN 0 ELSE 1 END AS INTEGER) AS late_60_flag,
       CAST(CASE WHEN late_days < 90 THEN 0 ELSE 1 END AS INTEGER) AS late_90_flag,
       {_val("CASE WHEN cycle_home > 0 THEN balance_home ELSE 0 END", "arrears_home_val")},
       {_val("CASE WHEN cycle_foreign > 0 THEN balance_foreign ELSE 0 END", "arrears_foreign_val")},
       {_val("CASE WHEN cycle_home > 0 AND cycle_foreign > 0 THEN balance_home + balance_foreign * rate WHEN cycle_home > 0 THEN balance_home WHEN cycle_foreign > 0 THEN balance_foreign * rate ELSE 0 END", "arrears_converted_val")},
       limit_change_flag
FROM c
""")
def card_account_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate")
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    x = fact_join(li, o).select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"),
        F.last_day(F.to_date("l_shipdate")).alias("_observ_end_dt"), "o_orderstatus", "l_returnflag",
        (F.col("l_suppkey") % 2 == 0).alias("home"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.to_date("l_shipdate").alias("shipped"), F.greatest(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")), F.lit(0)).alias("late"))
    a = x.groupBy("customer_key", "account_key", "_observ_end_dt").agg(*card_month_measures())
    return card_month_columns(add_rate(a, rates(spark, sf_dir), "_observ_end_dt", snapshot=True))


def card_month_measures() -> list[Column]:
    """CL-10 / CL-12 measures of an account's month, as aggregates for the
    caller's own pass."""
    home, paid = F.col("home"), F.col("l_returnflag") == "R"
    zero = F.lit(0)
    return [
        total(F.col("o_orderstatus") == "O").alias("limit_home"), total(F.col("o_orderstatus") != "O").alias("limit_foreign"),
        total(home).alias("balance_home"), total(~home).alias("balance_foreign"),
        F.coalesce(F.max(F.when(home, F.col("late"))), zero).alias("late_home"),
        F.coalesce(F.max(F.when(~home, F.col("late"))), zero).alias("late_foreign"),
        F.max(F.when(paid, F.col("shipped"))).alias("statement_date"),
        A.sum_if(paid & home, "amount").alias("paid_home"), A.sum_if(paid & ~home, "amount").alias("paid_foreign"),
        # states seen, as flags: no distinct aggregate needed
        sum((F.max(F.when(F.col("o_orderstatus") == s, 1).otherwise(0)) for s in ("F", "O", "P")), zero).alias("states")]


def card_month_columns(a: DataFrame, also: tuple = ()) -> DataFrame:
    """TR-06: the account chain from ``card_month_measures`` and the month
    end's rate; ``also`` names further columns to keep."""
    cycle = {k: F.when(F.col(f"balance_{k}") > 0, F.floor(F.col(f"late_{k}") / 30).cast("int")).otherwise(0)
             for k in ("home", "foreign")}
    c = a.withColumns({"cycle_home": cycle["home"], "cycle_foreign": cycle["foreign"],
                       "late_days": F.greatest("late_home", "late_foreign")})
    late, foreign_home = F.col("late_days"), F.col("balance_foreign") * F.col("rate")
    due_home, due_foreign = F.col("cycle_home") > 0, F.col("cycle_foreign") > 0
    none = F.lit(0).cast("decimal(28,2)")
    return to_val_columns(c.select(
        "customer_key", "account_key", "_observ_end_dt", "statement_date",
        D.next_payment_date("statement_date", "account_key", early_types=["1-URGENT"], earlier_types=["2-HIGH"]).alias("payment_date"),
        F.when(F.col("limit_home") > 0, F.col("limit_home")).otherwise(F.col("limit_foreign") * 8).alias("credit_limit"),
        "balance_home", "balance_foreign", (F.col("balance_home") + foreign_home).alias("balance_converted"),
        "paid_home", "paid_foreign", "late_home", "late_foreign", "late_days", "cycle_home", "cycle_foreign",
        F.greatest("cycle_home", "cycle_foreign").alias("max_cycle"),
        F.when(late == 0, 0).otherwise(1).alias("late_30_flag"), F.when(late < 60, 0).otherwise(1).alias("late_60_flag"),
        F.when(late < 90, 0).otherwise(1).alias("late_90_flag"),
        F.when(due_home, F.col("balance_home")).otherwise(none).alias("arrears_home"),
        F.when(due_foreign, F.col("balance_foreign")).otherwise(none).alias("arrears_foreign"),
        F.when(due_home & due_foreign, F.col("balance_home") + foreign_home).when(due_home, F.col("balance_home"))
         .when(due_foreign, foreign_home).otherwise(none).alias("arrears_converted"),
        F.when(F.col("states") > 1, 1).otherwise(0).alias("limit_change_flag"), *also))


# --- CL-56 / TR-35: investment accounts: standard state from its text (SC-07), bad-state flag (SC-09),
#     active with a positive balance (SC-10), early-cancel flag (a due date other than the day it was
#     cancelled), months in force, six amounts in three currency views at the month end's rate
INV_STATES = {"a": "active", "n": "new"}            # any other text: unknown
INV_BAD = ["unknown"]
INV_AMOUNTS = {"balance": ("price - price * discount", lambda price, discount, tax: price - price * discount),
               "earlier_balance": ("price", lambda price, discount, tax: price),
               "interest": ("price * discount", lambda price, discount, tax: price * discount),
               "agreed": ("price * tax", lambda price, discount, tax: price * tax),
               "pending": ("price * tax - price * discount", lambda price, discount, tax: price * tax - price * discount),
               "initial": ("retail", None)}
INV_PRODUCTS = {"STANDARD": "fixed", "SMALL": "savings", "PROMO": "fund"}   # the others have no term columns
BIG_BALANCE = 80_000

INVESTMENTS_SQL = f"""
  SELECT account_key, part_no, customer_key, _observ_end_dt, p_type, currency_id, rate, kind, state, opened, closed, due,
         {", ".join(f"{e} AS {n}" for n, (e, _) in INV_AMOUNTS.items())},
         CASE WHEN due IS NULL OR due = closed THEN 0 ELSE 1 END AS early_cancel_flag,
         CASE WHEN state = 'unknown' THEN 1 ELSE 0 END AS bad_state_flag,
         CASE WHEN state = 'active' AND price - price * discount > 0 THEN 1 ELSE 0 END AS active_positive_flag,
         CASE WHEN closed < opened THEN 0 ELSE {_months_sql("closed", "opened")} END AS term
  FROM (SELECT l_orderkey AS account_key, l_linenumber AS part_no, o_custkey AS customer_key, last_day(CAST(l_shipdate AS DATE)) AS _observ_end_dt,
               p_type, CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 2 END AS currency_id, r.rate, l_returnflag AS kind,
               CASE l_returnflag WHEN 'A' THEN 'active' WHEN 'N' THEN 'new' ELSE 'unknown' END AS state,
               CAST(o_orderdate AS DATE) AS opened, CAST(l_shipdate AS DATE) AS closed,
               CASE WHEN l_linestatus = 'F' THEN CAST(o_orderdate AS DATE) + 30 END AS due,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS discount,
               CAST(l_tax AS DECIMAL(4,2)) AS tax, CAST(p_retailprice AS DECIMAL(18,2)) AS retail
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        LEFT JOIN ({RATES_SQL}) r ON r.rate_date = last_day(CAST(l_shipdate AS DATE)))"""


def investments(spark: SparkSession, sf_dir: str, by: list[str] | None = None) -> DataFrame:
    """Investment accounts with their flags, months in force, amounts and the
    month end's rate: one fact join, one catalog join. ``by``: keys the caller
    groups by; the narrow stored columns are then dealt out by them before the
    amounts are made, and no partial sums (wider, hardly fewer) are exchanged."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                                             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = t(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_retailprice").cast("decimal(18,2)").alias("initial"))
    x = join_small(fact_join(li, o), p, F.col("l_partkey") == F.col("p_partkey"), "inner")
    x = x.withColumns({"customer_key": F.col("o_custkey"), "_observ_end_dt": F.last_day(F.to_date("l_shipdate"))})
    if by:
        x = x.repartition(fact_tasks(li), *by)
    price, share = F.col("l_extendedprice").cast("decimal(18,2)"), [F.col(c).cast("decimal(4,2)") for c in ("l_discount", "l_tax")]
    opened, closed = F.to_date("o_orderdate"), F.to_date("l_shipdate")
    x = x.select(
        F.col("l_orderkey").alias("account_key"), F.col("l_linenumber").alias("part_no"), "customer_key",
        "_observ_end_dt", "p_type", F.when(F.col("l_suppkey") % 2 == 0, HOME).otherwise(FOREIGN).alias("currency_id"),
        F.col("l_returnflag").alias("kind"), L.map_lookup("l_returnflag", INV_STATES, "unknown", normalize=True).alias("state"),
        opened.alias("opened"), closed.alias("closed"), F.when(F.col("l_linestatus") == "F", F.date_add(opened, 30)).alias("due"),
        D.whole_months_between(closed, opened).alias("term"),
        *[(make(price, *share) if make else F.col(n)).alias(n) for n, (_, make) in INV_AMOUNTS.items()])
    x = x.withColumns({
        "early_cancel_flag": F.when(F.col("due").isNull() | (F.col("due") == F.col("closed")), 0).otherwise(1),
        "bad_state_flag": L.in_list_flag("state", INV_BAD), "active_positive_flag": L.in_list_and_positive("state", ["active"], "balance")})
    return add_rate(x, rates(spark, sf_dir), "_observ_end_dt", snapshot=True)


INV_FLAGS = ["early_cancel_flag", "bad_state_flag", "active_positive_flag"]


@register("investment_accounts", f"""
SELECT account_key, part_no, customer_key, _observ_end_dt, state, opened, closed, due, CAST(term AS INTEGER) AS months_in_force_cnt,
       {", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in INV_FLAGS)}, {", ".join(_three_sql(n, n) for n in INV_AMOUNTS)}
FROM ({INVESTMENTS_SQL})
""")
def investment_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_val_columns(investments(spark, sf_dir).select(
        "account_key", "part_no", "customer_key", "_observ_end_dt", "state", "opened", "closed", "due",
        F.col("term").alias("months_in_force_cnt"), *INV_FLAGS, *[v for n in INV_AMOUNTS for v in three_views(n, n)]))


# --- TR-34 / TR-36 / IN-13: investments per customer and month: the six amounts summed in three views,
#     movements by kind, flags, a big-balance flag, and the months in force (max, min, sum, whole
#     average) pivoted by the three listed products
def _inv_views(name: str) -> str:
    return ", ".join([_val(_sum_sql("currency_id = 1", name), f"{name}_home_val"), _val(_sum_sql("currency_id = 2", name), f"{name}_foreign_val"),
                      _val(f"sum(CASE WHEN currency_id = 2 THEN {name} * rate ELSE {name} END)", f"{name}_converted_val")])


def _term_sql(ptype: str, name: str) -> str:
    term = f"CASE WHEN p_type = '{ptype}' THEN term END"
    return (f"CAST(coalesce(max({term}), 0) AS INTEGER) AS {name}_term_max, CAST(coalesce(min({term}), 0) AS INTEGER) AS {name}_term_min, "
            f"CAST(coalesce(sum({term}), 0) AS BIGINT) AS {name}_term_sum, CAST(coalesce(floor(avg({term})), 0) AS INTEGER) AS {name}_term_avg")


def _moves_sql(name: str, kind: str) -> str:
    hit = f"kind = '{kind}'"
    return f"{_cnt_sql(hit, f'{name}_cnt')}, {_val(_sum_sql(hit, 'earlier_balance'), f'{name}_val')}"


@register("investment_month", f"""
SELECT customer_key, _observ_end_dt, CAST(count(*) AS BIGINT) AS investments_cnt,
       {", ".join(_inv_views(n) for n in INV_AMOUNTS)}, {", ".join(_moves_sql(n, k) for n, k in KINDS)},
       {", ".join(f"CAST(max({c}) AS INTEGER) AS {c}" for c in INV_FLAGS)},
       max(CASE WHEN CASE WHEN currency_id = 2 THEN balance * rate ELSE balance END > {BIG_BALANCE} THEN 'S' ELSE 'N' END) AS big_balance_flag,
       {", ".join(_term_sql(p, n) for p, n in INV_PRODUCTS.items())}
FROM ({INVESTMENTS_SQL}) GROUP BY 1, 2
""")
def investment_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = investments(spark, sf_dir, MONTH)
    foreign = F.col("currency_id") == FOREIGN

    def home(name: str) -> Column:
        return to_home_currency("currency_id", name, "rate", HOME)

    aggs: list[Column] = [F.count(F.lit(1)).alias("investments_cnt")]
    for n in INV_AMOUNTS:
        aggs += [total(~foreign, n).alias(f"{n}_home"), total(foreign, n).alias(f"{n}_foreign"), F.sum(home(n)).alias(f"{n}_converted")]
    for n, k in KINDS:
        aggs += [A.count_if(F.col("kind") == k).alias(f"{n}_cnt"), total(F.col("kind") == k, "earlier_balance").alias(n)]
    aggs += [F.max(c).alias(c) for c in INV_FLAGS]
    aggs.append(F.max(F.when(home("balance") > BIG_BALANCE, "S").otherwise("N")).alias("big_balance_flag"))
    for ptype, n in INV_PRODUCTS.items():
        term = F.when(F.col("p_type") == ptype, F.col("term"))
        whole = {"max": F.max(term), "min": F.min(term), "sum": F.sum(term), "avg": F.floor(F.avg(term)).cast("int")}
        aggs += [F.coalesce(v, F.lit(0)).alias(f"{n}_term_{m}") for m, v in whole.items()]
    return to_val_columns(x.groupBy(*MONTH).agg(*aggs))


# --- TR-02 / TR-45: transfers of two channels, amounts converted at the day's rate, pivot by
#     channel_operation, row totals per channel
@register("channel_transfers", f"""
WITH r AS ({RATES_SQL}),
x AS (SELECT o_custkey AS customer_key, last_day(CAST(l_shipdate AS DATE)) AS _observ_end_dt,
             CASE l_linestatus WHEN 'F' THEN 'app' ELSE 'web' END AS channel, CASE l_returnflag WHEN 'A' THEN 'own' WHEN 'N' THEN 'third' ELSE 'ach' END AS operation,
             CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) * r.rate END AS amount
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN r ON r.rate_date = CAST(l_shipdate AS DATE)),
g AS (SELECT customer_key, _observ_end_dt,
        {", ".join(f"{_cnt_sql(f'''channel = '{c}' AND operation = '{op}' ''', f'{c}_{op}_cnt')}, {_sum_sql(f'''channel = '{c}' AND operation = '{op}' ''')} AS {c}_{op}_amount" for c in ("app", "web") for op in ("own", "third", "ach"))}
      FROM x GROUP BY 1, 2)
SELECT customer_key, _observ_end_dt, {", ".join(f"{c}_{op}_cnt" for c in ("app", "web") for op in ("own", "third", "ach"))},
       {", ".join(_val(f"{c}_{op}_amount", f"{c}_{op}_amount_val") for c in ("app", "web") for op in ("own", "third", "ach"))},
       {", ".join(f"CAST({c}_own_cnt + {c}_third_cnt + {c}_ach_cnt AS BIGINT) AS {c}_cnt, {_val(f'{c}_own_amount + {c}_third_amount + {c}_ach_amount', f'{c}_amount_val')}" for c in ("app", "web"))}
FROM g
""")
def channel_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = add_rate(transactions(spark, sf_dir), rates(spark, sf_dir), "trx_date")
    channel = F.when(F.col("direction") == "F", "app").otherwise("web")
    operation = F.coalesce(L.map_lookup("kind", {"A": "own", "N": "third"}), F.lit("ach"))
    x = x.withColumns({"channel_operation": F.concat_ws("_", channel, operation), "_observ_end_dt": F.last_day("trx_date"),
                       "converted": F.when(F.col("currency_id") == HOME, F.col("amount")).otherwise(F.col("amount") * F.col("rate"))})
    names = [f"{c}_{op}" for c in ("app", "web") for op in ("own", "third", "ach")]
    g = x.groupBy(*MONTH).agg(*A.pivot_aggs("channel_operation", names, {"cnt": ("count", None), "amount": ("sum", "converted")}))
    for c in ("app", "web"):
        for m in ("cnt", "amount"):
            g = A.horizontal_total(g, f"{c}_{m}", [f"{n}_{m}" for n in names if n.startswith(c)])
    return to_val_columns(g)
