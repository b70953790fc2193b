"""One monthly run across the layers, as the reference's main flow does it:
cleaning (customers as of the run's last month) -> quality gate -> save ->
transformation (account x month) -> quality gate -> partitioned save ->
integration (customer x month) read from the saved layers, gated -> volume
report over the saved layers.

Each layer is written with dynamic partition overwrite on ``_particion``, so
re-running a period replaces only that period. The quality history is
stored partitioned by (dataset_name, _observ_end_dt): writing the new
records with dynamic overwrite replaces exactly the (dataset, month) sets
that were validated again (DQ-13) in place.
"""

from __future__ import annotations

from datetime import date as _date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.operators.columns import with_observation_dates, with_period
from featuremart.operators.monthly_state import update_state, volumes
from featuremart.operators.profiling import volume_report
from featuremart.operators.quality import QualityRules, month_ranges, require_gate, write_checked
from featuremart.operators.setops import union_same_shape
from featuremart.plans.customer import customer_rollup
from featuremart.plans.features import month_features_df
from featuremart.plans.cleaning import customer_cleaned
from featuremart.plans.inputs import SEGMENTS, t
from featuremart.sources.writers import has_files, save_partitioned

ACCOUNT_RULES = QualityRules(
    unique_keys=["customer_key", "account_key", "_observ_end_dt"],
    null_limits={"trx_amount_total_val": 5},
    rules=[{"name": "counts_add_up", "condition": "trx_a_cnt + trx_n_cnt + trx_r_cnt = trx_movements_cnt",
            "severity": "CRITICAL"}])
CLEAN_CUSTOMER_RULES = QualityRules(unique_keys=["customer_key", "_observ_end_dt"],
                                    null_limits={"segment": 0},
                                    allowed_values={"segment": SEGMENTS + ["unknown"]})
CUSTOMER_RULES = QualityRules(unique_keys=["customer_key", "_observ_end_dt"],
                              rules=[{"name": "non_negative", "condition": "amount_total_val >= 0"}])


def month_end_of(day) -> _date:
    """The last day of a date's month."""
    d = _date.fromisoformat(str(day)[:10]).replace(day=28) + timedelta(days=4)
    return d.replace(day=1) - timedelta(days=1)


def run_layers(spark: SparkSession, sf_dir: str, out_root: str, start=None, end=None) -> dict[str, str]:
    out_root = out_root.rstrip("/")
    paths = {"clean_customers": f"{out_root}/clean_customers",
             "accounts": f"{out_root}/account_month_features",
             "customers": f"{out_root}/customer_month_features",
             "history": f"{out_root}/quality_history",
             "state": f"{out_root}/volume_state",
             "volumes": f"{out_root}/volume_report"}

    def publish(name: str, df: DataFrame, rules: QualityRules, path: str, months: list | None) -> None:
        """Evaluate the layer once into a staging folder, checked while it is
        written, and publish the written rows (DQ-12); a stopped layer is not
        published."""
        written = write_checked(df, name, rules, "_observ_end_dt", months, lambda records: save_partitioned(
            records, paths["history"], ["dataset_name", "_observ_end_dt"], "replace_range"))
        save_partitioned(written, path, "_particion", "replace_range")

    lo = start or "1900-01-01"
    hi = end or "2999-12-31"
    # the run's months, known before anything is read; without a range the staged rows are checked by month
    run_months = [r.month_end for r in month_ranges(spark, start, end).collect()] if start and end else None

    # cleaning layer: the customer snapshot as of the run's last month (CL-21), stamped
    # with its observation period, gated, saved; a re-run of the month replaces it
    as_of = end or t(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0]
    clean = with_observation_dates(customer_cleaned(spark, sf_dir).withColumn("__as_of", F.to_date(F.lit(as_of))),
                                   "__as_of").drop("__as_of")
    clean = with_period(clean, "_observ_end_dt")
    publish("clean_customers", clean, CLEAN_CUSTOMER_RULES, paths["clean_customers"], [month_end_of(as_of)])
    require_gate(spark, paths["history"], "clean_customers", lo, hi)
    period = int(str(as_of)[:7].replace("-", ""))  # the snapshot's yyyyMM

    accounts = month_features_df(spark, sf_dir, start, end)
    publish("account_month_features", accounts, ACCOUNT_RULES, paths["accounts"], run_months)

    require_gate(spark, paths["history"], "account_month_features", lo, hi)
    saved = spark.read.parquet(paths["accounts"])
    if start is not None or end is not None:
        saved = saved.where(F.col("_observ_end_dt").between(F.to_date(F.lit(lo)), F.last_day(F.to_date(F.lit(hi)))))
    cleaned = spark.read.parquet(paths["clean_customers"]).where(F.col("_particion") == period).select(
        F.col("customer_key").alias("c_custkey"), F.col("segment").alias("c_mktsegment"))
    customers = customer_rollup(saved, cleaned).withColumn(
        "_particion", F.date_format("_observ_end_dt", "yyyyMM").cast("int"))
    publish("customer_month_features", customers, CUSTOMER_RULES, paths["customers"], run_months)
    # volumes up to the run's last month, which is closed on the day after it
    run_date = _date.fromisoformat(str(as_of)[:10]).replace(day=28) + timedelta(days=4)

    # volumes from the state kept between runs: the run's months are read, the others come from stored
    # counts and customer bitmaps (the first run, or a run without a range, reads the whole layer)
    series = []
    for name in ("accounts", "customers"):
        df, state = spark.read.parquet(paths[name]).select("_observ_end_dt", "customer_key"), f"{paths['state']}/{name}"
        months = (start, end) if run_months and has_files(spark, state) else df.agg(
            F.min("_observ_end_dt").cast("string"), F.max("_observ_end_dt").cast("string")).first()
        if months[0] is not None:
            update_state(spark, state, df, "_observ_end_dt", "customer_key", *months)
            series.append(volumes(spark.read.parquet(state), name, run_date))
    volume_report(union_same_shape(series)).write.mode("overwrite").parquet(paths["volumes"])
    return paths
