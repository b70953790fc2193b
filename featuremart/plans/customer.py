"""Customer x month queries (integration layer, IN family; TR-26 shape).

Account-level features are rolled up to one row per customer and month;
ratios are null unless their divisor is valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions.arith import nullsafe_sum
from featuremart.operators import aggregates as A
from featuremart.plans.features import MONTH_FEATURES_SQL, month_features_df
from featuremart.plans.inputs import SNAPSHOTS_SQL, account_snapshots, t
from featuremart.plans.registry import register

KEYS = ["customer_key", "_observ_end_dt"]


def ratio4(num, den) -> Column:
    """Ratio rounded half-up to 4 digits. Operands are narrowed first so the
    decimal division keeps 18 digits and the final rounding is exact."""
    n = (F.col(num) if isinstance(num, str) else num).cast("decimal(20,2)")
    d = (F.col(den) if isinstance(den, str) else den).cast("decimal(20,2)")
    return F.round(n / d, 4).cast("decimal(19,4)")


def _ratio4_sql(a: str, b: str) -> str:
    """Half-up ratio to 4 digits in integer arithmetic (a >= 0, b > 0, 2 decimals)."""
    A = f"CAST(CAST({a} AS DECIMAL(20,2)) * 100 AS HUGEINT)"
    B = f"CAST(CAST({b} AS DECIMAL(20,2)) * 100 AS HUGEINT)"
    return f"CAST(CAST((2 * 10000 * {A} + {B}) // (2 * {B}) AS DECIMAL(38,0)) * 0.0001 AS DECIMAL(19,4))"


# --- IN-03 / IN-04: assets, liabilities, current ratio, income / balance ratio
CUSTOMER_RATIOS_SQL = f"""
WITH s AS ({SNAPSHOTS_SQL}),
f AS ({MONTH_FEATURES_SQL}),
cust AS (SELECT DISTINCT customer_key, info_date AS _observ_end_dt FROM s),
sav AS (SELECT customer_key, info_date AS _observ_end_dt, sum(balance) AS v FROM s WHERE status = 'F' GROUP BY 1, 2),
cur AS (SELECT customer_key, _observ_end_dt, sum(trx_a_amount_val) AS v FROM f GROUP BY 1, 2),
loan AS (SELECT customer_key, info_date AS _observ_end_dt, sum(balance) AS v FROM s WHERE status = 'O' GROUP BY 1, 2),
ret AS (SELECT customer_key, _observ_end_dt, sum(trx_r_amount_val) AS v FROM f GROUP BY 1, 2),
assets AS (SELECT customer_key, _observ_end_dt, CASE WHEN sum(v) < 0 THEN 0 ELSE sum(v) END AS current_assets
           FROM (SELECT * FROM sav UNION ALL SELECT * FROM cur) GROUP BY 1, 2),
liab AS (SELECT customer_key, _observ_end_dt, CASE WHEN sum(v) < 0 THEN 0 ELSE sum(v) END AS current_liabilities
         FROM (SELECT * FROM loan UNION ALL SELECT * FROM ret) GROUP BY 1, 2),
bal AS (SELECT customer_key, _observ_end_dt, sum(v) AS total_balance FROM (SELECT * FROM sav UNION ALL SELECT * FROM cur) GROUP BY 1, 2),
inc AS (SELECT c_custkey AS customer_key, CAST(c_acctbal AS DECIMAL(18,2)) AS income FROM customer)
SELECT cust.customer_key, cust._observ_end_dt,
       CAST(a.current_assets AS DECIMAL(19,2)) AS current_assets_val,
       CAST(l.current_liabilities AS DECIMAL(19,2)) AS current_liabilities_val,
       CAST(b.total_balance AS DECIMAL(19,2)) AS total_balance_val,
       CASE WHEN l.current_liabilities > 0 AND a.current_assets IS NOT NULL
            THEN {_ratio4_sql("a.current_assets", "l.current_liabilities")} END AS current_ratio,
       CASE WHEN b.total_balance <> 0 AND inc.income >= 0 AND b.total_balance > 0
            THEN {_ratio4_sql("inc.income", "b.total_balance")} END AS income_balance_ratio
FROM cust LEFT JOIN assets a USING (customer_key, _observ_end_dt)
          LEFT JOIN liab l USING (customer_key, _observ_end_dt)
          LEFT JOIN bal b USING (customer_key, _observ_end_dt)
          LEFT JOIN inc USING (customer_key)
"""


@register("customer_ratios", CUSTOMER_RATIOS_SQL, headline=True)
def customer_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = account_snapshots(spark, sf_dir).withColumnRenamed("info_date", "_observ_end_dt")
    f = month_features_df(spark, sf_dir)
    # one aggregate per source: the snapshot gives the customer universe and
    # two measures, the features give two; JN-04 sums them side by side
    snap = s.groupBy(*KEYS).agg(A.sum_if(F.col("status") == "F", "balance").alias("sav"),
                                A.sum_if(F.col("status") == "O", "balance").alias("loan"))
    feat = f.groupBy(*KEYS).agg(F.sum("trx_a_amount_val").alias("cur"),
                                F.sum("trx_r_amount_val").alias("ret"))
    j = snap.join(feat, KEYS, "left").select(
        *KEYS,
        nullsafe_sum(["sav", "cur"], clamp_negative=True).alias("current_assets"),
        nullsafe_sum(["loan", "ret"], clamp_negative=True).alias("current_liabilities"),
        nullsafe_sum(["sav", "cur"]).alias("total_balance"))
    inc = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"),
                                              F.col("c_acctbal").cast("decimal(18,2)").alias("income"))
    j = j.join(inc, "customer_key", "left")
    return j.select(
        *KEYS,
        F.col("current_assets").cast("decimal(19,2)").alias("current_assets_val"),
        F.col("current_liabilities").cast("decimal(19,2)").alias("current_liabilities_val"),
        F.col("total_balance").cast("decimal(19,2)").alias("total_balance_val"),
        F.when(F.col("current_liabilities") > 0, ratio4("current_assets", "current_liabilities"))
         .alias("current_ratio"),
        F.when((F.col("total_balance") != 0) & (F.col("income") / F.col("total_balance") >= 0),
               ratio4("income", "total_balance")).alias("income_balance_ratio"))


# --- IN-05 / IN-06: account features rolled up per customer and month
@register("customer_month_profile", f"""
WITH f AS ({MONTH_FEATURES_SQL}),
c AS (SELECT c_custkey AS customer_key, c_mktsegment AS segment FROM customer),
g AS (SELECT customer_key, _observ_end_dt,
             CAST(count(*) AS BIGINT) AS active_accounts,
             CAST(sum(trx_movements_cnt) AS BIGINT) AS movements_cnt,
             CAST(sum(trx_amount_total_val) AS DECIMAL(19,2)) AS amount_total_val,
             CAST(sum(trx_r_amount_val) AS DECIMAL(19,2)) AS returned_val,
             CAST(max(trx_missing_rate_cnt) AS BIGINT) AS max_missing_rate_cnt,
             CAST(count_if(trx_r_cnt > 0) AS BIGINT) AS accounts_with_returns,
             min(account_key) AS first_account
      FROM f GROUP BY 1, 2)
SELECT g.*, c.segment,
       CASE WHEN amount_total_val > 0 THEN {_ratio4_sql("returned_val", "amount_total_val")} END AS returned_share
FROM g LEFT JOIN c USING (customer_key)
""")
def customer_month_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_rollup(month_features_df(spark, sf_dir), t(spark, sf_dir, "customer"))


def customer_rollup(f: DataFrame, customers: DataFrame) -> DataFrame:
    """IN-05 / IN-06: account x month features rolled up per customer and month."""
    g = f.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("active_accounts"),
        F.sum("trx_movements_cnt").alias("movements_cnt"),
        F.sum("trx_amount_total_val").cast("decimal(19,2)").alias("amount_total_val"),
        F.sum("trx_r_amount_val").cast("decimal(19,2)").alias("returned_val"),
        F.max("trx_missing_rate_cnt").alias("max_missing_rate_cnt"),
        F.count_if(F.col("trx_r_cnt") > 0).alias("accounts_with_returns"),
        F.min("account_key").alias("first_account"))
    c = customers.select(F.col("c_custkey").alias("customer_key"), F.col("c_mktsegment").alias("segment"))
    out = g.join(c, "customer_key", "left")
    return out.withColumn("returned_share", F.when(F.col("amount_total_val") > 0,
                                                   ratio4("returned_val", "amount_total_val")))


# --- TR-26: start date and months in force derived from each other
@register("income_start_date", """
WITH a AS (SELECT o_custkey AS customer_key, min(CAST(o_orderdate AS DATE)) AS first_order,
                  max(CAST(o_orderdate AS DATE)) AS as_of FROM orders GROUP BY 1),
b AS (SELECT customer_key, as_of,
             CASE WHEN customer_key % 3 = 0 THEN NULL ELSE first_order END AS start_date,
             CASE WHEN customer_key % 5 = 0 THEN NULL ELSE
               CAST(CASE WHEN (as_of = last_day(as_of) AND first_order = last_day(first_order)) OR day(as_of) >= day(first_order)
                         THEN (year(as_of) - year(first_order)) * 12 + month(as_of) - month(first_order)
                         ELSE (year(as_of) - year(first_order)) * 12 + month(as_of) - month(first_order) - 1 END AS INTEGER) END AS months_open
      FROM a)
SELECT customer_key, as_of,
       coalesce(start_date, CAST(as_of - to_months(months_open) AS DATE)) AS start_date,
       coalesce(months_open, coalesce(CAST(greatest(
         CASE WHEN (as_of = last_day(as_of) AND start_date = last_day(start_date)) OR day(as_of) >= day(start_date)
              THEN (year(as_of) - year(start_date)) * 12 + month(as_of) - month(start_date)
              ELSE (year(as_of) - year(start_date)) * 12 + month(as_of) - month(start_date) - 1 END, 0) AS INTEGER), 0)) AS months_open
FROM b
""")
def income_start_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.functions.dates import whole_months_between
    o = t(spark, sf_dir, "orders")
    a = o.groupBy(F.col("o_custkey").alias("customer_key")).agg(
        F.min(F.to_date("o_orderdate")).alias("first_order"), F.max(F.to_date("o_orderdate")).alias("as_of"))
    # a reported start date or a reported number of months, each missing for some customers
    b = a.select("customer_key", "as_of",
                 F.when(F.col("customer_key") % 3 != 0, F.col("first_order")).alias("start_date"),
                 F.when(F.col("customer_key") % 5 != 0,
                        whole_months_between("as_of", "first_order")).alias("months_open"))
    return derive_start_and_months(b, "as_of", "start_date", "months_open")


def derive_start_and_months(df: DataFrame, as_of: str, start: str, months: str) -> DataFrame:
    """TR-26 operator: a missing start date is ``as_of`` minus the months; a
    missing month count is the whole months from the start to ``as_of``."""
    from featuremart.functions.dates import whole_months_between
    return df.select(
        *[c for c in df.columns if c not in (start, months)],
        F.coalesce(F.col(start), F.add_months(F.col(as_of), -F.col(months))).alias(start),
        F.coalesce(F.col(months), whole_months_between(as_of, start)).alias(months))
