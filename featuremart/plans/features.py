"""Account x month feature queries (step 1 of the build plan and the
transformation-layer nodes recast on the driver tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions.currency import to_home_currency
from featuremart.operators.aggregates import pivot_aggs
from featuremart.operators.columns import add_prefix, key_columns_first, to_val_columns, with_period
from featuremart.operators.joins import add_rate
from featuremart.plans.inputs import (HOME, KINDS, RATES_SQL, TRANSACTIONS_SQL, rates,
                                      transactions)
from featuremart.plans.registry import register

ACCOUNT_KEYS = ["customer_key", "account_key", "_observ_start_dt", "_observ_end_dt"]


def month_features_df(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """Monthly movement features of an account.

    scan (date range pushed down) -> join orders -> rate of the day
    (size-checked broadcast) -> home amount -> one grouped pass holding the
    currency split, the explicit pivot by movement kind and the totals ->
    domain prefix, ``_val`` decimals, period int.
    One shuffle for the fact join, one for the grouping (partial sums first).
    """
    trx = add_rate(transactions(spark, sf_dir, start, end), rates(spark, sf_dir), "trx_date")
    trx = trx.withColumns({
        "amount_home": to_home_currency("currency_id", "amount", "rate", HOME),
        "_observ_start_dt": F.trunc("trx_date", "month"),
        "_observ_end_dt": F.last_day("trx_date"),
    })
    agg = trx.groupBy(*ACCOUNT_KEYS).agg(
        F.count(F.lit(1)).alias("movements_cnt"),
        F.sum(F.when(F.col("currency_id") == HOME, F.col("amount")).otherwise(0)).alias("amount_home_ccy"),
        F.sum(F.when(F.col("currency_id") != HOME, F.col("amount")).otherwise(0)).alias("amount_foreign_ccy"),
        F.sum("amount_home").alias("amount_total"),
        F.count_if(F.col("rate").isNull() & (F.col("currency_id") != HOME)).alias("missing_rate_cnt"),
        *pivot_aggs("kind", KINDS, {"cnt": ("count", None), "amount": ("sum", "amount_home")}),
    )
    # horizontal total over the pivoted kinds, returned goods (R) excluded
    agg = agg.withColumn("kept_amount", F.col("a_amount") + F.col("n_amount"))
    out = with_period(to_val_columns(add_prefix(agg, "trx", ACCOUNT_KEYS)), "_observ_end_dt")
    return key_columns_first(out, ["customer_key", "account_key", "_observ_start_dt",
                                   "_observ_end_dt", "_particion"])


# --- month features (flagship): SRC-02, JN-03, SC-17..19, AG-01 / AG-03 / AG-10 (conditional
#     counts and sums, kind pivot, total of two pivoted kinds), PRJ-02..04 (prefix, _val, period)
MONTH_FEATURES_SQL = f"""
WITH r AS ({RATES_SQL}),
t AS ({TRANSACTIONS_SQL}),
x AS (
  SELECT t.*, r.rate,
         CASE WHEN currency_id = 1 THEN amount ELSE amount * r.rate END AS amount_home,
         date_trunc('month', trx_date)::DATE AS _observ_start_dt, last_day(trx_date) AS _observ_end_dt
  FROM t LEFT JOIN r ON t.trx_date = r.rate_date),
g AS (
  SELECT customer_key, account_key, _observ_start_dt, _observ_end_dt,
         count(*) AS movements_cnt,
         sum(CASE WHEN currency_id = 1 THEN amount ELSE 0 END) AS amount_home_ccy,
         sum(CASE WHEN currency_id <> 1 THEN amount ELSE 0 END) AS amount_foreign_ccy,
         sum(amount_home) AS amount_total,
         CAST(count_if(rate IS NULL AND currency_id <> 1) AS BIGINT) AS missing_rate_cnt,
         CAST(count_if(kind = 'A') AS BIGINT) AS a_cnt, coalesce(sum(CASE WHEN kind = 'A' THEN amount_home END), 0) AS a_amount,
         CAST(count_if(kind = 'N') AS BIGINT) AS n_cnt, coalesce(sum(CASE WHEN kind = 'N' THEN amount_home END), 0) AS n_amount,
         CAST(count_if(kind = 'R') AS BIGINT) AS r_cnt, coalesce(sum(CASE WHEN kind = 'R' THEN amount_home END), 0) AS r_amount
  FROM x GROUP BY ALL)
SELECT customer_key, account_key, _observ_start_dt, _observ_end_dt,
       CAST(strftime(_observ_end_dt, '%Y%m') AS INTEGER) AS _particion,
       movements_cnt AS trx_movements_cnt,
       CAST(round(amount_home_ccy, 2) AS DECIMAL(19,2)) AS trx_amount_home_ccy_val,
       CAST(round(amount_foreign_ccy, 2) AS DECIMAL(19,2)) AS trx_amount_foreign_ccy_val,
       CAST(round(amount_total, 2) AS DECIMAL(19,2)) AS trx_amount_total_val,
       missing_rate_cnt AS trx_missing_rate_cnt,
       a_cnt AS trx_a_cnt, CAST(round(a_amount, 2) AS DECIMAL(19,2)) AS trx_a_amount_val,
       n_cnt AS trx_n_cnt, CAST(round(n_amount, 2) AS DECIMAL(19,2)) AS trx_n_amount_val,
       r_cnt AS trx_r_cnt, CAST(round(r_amount, 2) AS DECIMAL(19,2)) AS trx_r_amount_val,
       CAST(round(a_amount + n_amount, 2) AS DECIMAL(19,2)) AS trx_kept_amount_val
FROM g
"""


@register("month_features", MONTH_FEATURES_SQL, headline=True)
def month_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_features_df(spark, sf_dir)
