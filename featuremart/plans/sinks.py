"""Sink queries (SNK family): write to a fresh folder under the shared
checkpoint folder, apply the replace / merge / upsert, read the result back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.operators.columns import with_period
from featuremart.operators.quality import quality_records
from featuremart.plans.inputs import t
from featuremart.plans.quality import (DQ_BY_MONTH_SQL, DQ_SOURCE_SQL, DUP_RULES, SOURCE_COLUMNS,
                                       dq_by_month, dq_source, records_sql)
from featuremart.plans.registry import register
from featuremart.sources.writers import (merge_in_partitions, new_location, rows_as_json,
                                         save_partitioned, upsert_in_partitions)


def _monthly_orders(o: DataFrame) -> DataFrame:
    return (o.groupBy(F.date_format(F.to_date("o_orderdate"), "yyyyMM").cast("int").alias("_particion"),
                      F.col("o_orderpriority").alias("account_key"))
            .agg(F.count(F.lit(1)).alias("orders_cnt"),
                 F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("decimal(19,2)")
                  .alias("orders_val")))


# --- SNK-01: replace a date range (dynamic partition overwrite), keep history
@register("replace_range", """
WITH o AS (SELECT CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m') AS INTEGER) AS _particion,
                  o_orderpriority AS account_key, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders)
SELECT _particion, account_key, CAST(count(*) AS BIGINT) AS orders_cnt, CAST(round(sum(v), 2) AS DECIMAL(19,2)) AS orders_val
FROM o WHERE _particion NOT BETWEEN 199801 AND 199812 GROUP BY 1, 2
UNION ALL
SELECT _particion, account_key, CAST(count(*) AS BIGINT), CAST(round(sum(v), 2) AS DECIMAL(19,2))
FROM o WHERE _particion BETWEEN 199801 AND 199812 AND o_orderstatus = 'F' GROUP BY 1, 2
""")
def replace_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    path = new_location(spark, "replace_range")
    save_partitioned(_monthly_orders(o), path, "_particion", "replace_schema")
    batch = o.where((F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                    & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
                    & (F.col("o_orderstatus") == "F"))
    save_partitioned(_monthly_orders(batch), path, "_particion", "replace_range")
    return spark.read.parquet(path)


# --- SNK-02 / DQ-13: replace the (dataset, month) sets present in the new batch
@register("replace_by_key", f"""
WITH old AS ({DQ_BY_MONTH_SQL}),
new AS (SELECT * FROM ({records_sql(DQ_SOURCE_SQL, "lineitem", DUP_RULES, "l_shipdate", SOURCE_COLUMNS)})
        WHERE _observ_end_dt BETWEEN '1999-01-01' AND '1999-12-31')
SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.dataset_name = old.dataset_name
                                    AND new._observ_end_dt = old._observ_end_dt)
UNION ALL SELECT * FROM new
""")
def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the stored history is partitioned by month; the run's twelve months are rewritten, the others stay
    path = new_location(spark, "replace_by_key")
    save_partitioned(with_period(dq_by_month(spark, sf_dir), "_observ_end_dt"), path, "_particion", "replace_schema")
    new = quality_records(dq_source(spark, sf_dir), "lineitem", DUP_RULES, "l_shipdate").where(
        F.col("_observ_end_dt").between("1999-01-01", "1999-12-31"))
    merge_in_partitions(spark, path, with_period(new, "_observ_end_dt"), ["dataset_name", "_observ_end_dt"], "_particion")
    return spark.read.parquet(path).drop("_particion")


# --- SNK-04: upsert with delete inside the source window
@register("upsert_delete", """
WITH tgt AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS info_date, o_custkey, o_orderstatus = 'F' AS reviewed
             FROM orders WHERE o_orderstatus <> 'O'),
src AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS info_date FROM orders
        WHERE o_orderstatus <> 'P')
SELECT coalesce(tgt.o_orderkey, src.o_orderkey) AS o_orderkey, coalesce(tgt.info_date, src.info_date) AS info_date,
       tgt.o_custkey, CASE WHEN tgt.o_orderkey IS NULL THEN false ELSE tgt.reviewed END AS reviewed
FROM tgt FULL JOIN src ON tgt.o_orderkey = src.o_orderkey
WHERE src.o_orderkey IS NOT NULL OR NOT coalesce(tgt.info_date BETWEEN DATE '1996-07-01' AND DATE '1996-12-31', false)
""")
def upsert_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("info_date"),
                                          "o_custkey", "o_orderstatus")
    # stored: everything but open orders; reported by the run: everything but pending ones
    target = o.where(F.col("o_orderstatus") != "O").select(
        "o_orderkey", "info_date", "o_custkey", (F.col("o_orderstatus") == "F").alias("reviewed"))
    path = new_location(spark, "upsert_delete")
    save_partitioned(with_period(target, "info_date"), path, "_particion", "replace_schema")
    source = o.where(F.col("o_orderstatus") != "P").select("o_orderkey", "info_date")
    upsert_in_partitions(spark, path, source, ["o_orderkey"], "info_date", "1996-07-01", "1996-12-31", "reviewed", False)
    return spark.read.parquet(path).drop("_particion")


# --- SNK-05 (re-aimed): one JSON document per row, written as JSON lines
@register("rows_to_json", """
SELECT CAST(to_json(struct_pack(c_custkey := c_custkey, c_name := c_name, c_nationkey := c_nationkey,
                                c_mktsegment := c_mktsegment)) AS VARCHAR) AS json
FROM customer
""")
def rows_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = new_location(spark, "rows_to_json")
    rows_as_json(c).write.mode("overwrite").text(path)
    return spark.read.text(path).select(F.col("value").alias("json"))
