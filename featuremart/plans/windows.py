"""Window, top-k and trailing-frame queries (WN family, QA-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featuremart.operators.columns import fill_numeric_zero
from featuremart.operators.profiling import volume_report, volume_series
from featuremart.operators.windows import (keep_ratio, last_n_records, rank_by_latest_date,
                                           top_n_per_group)
from featuremart.plans.inputs import t
from featuremart.plans.registry import register


# --- WN-01 / WN-09: top 1 per group under a mixed order with a unique tie-break
@register("top1_mixed_order", """
SELECT customer_key, o_orderkey, order_date, o_totalprice FROM (
  SELECT o_custkey AS customer_key, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_totalprice ASC, o_orderkey ASC) AS rn
  FROM orders) WHERE rn = 1
""")
def top1_mixed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_key"), "o_orderkey",
                                          F.to_date("o_orderdate").alias("order_date"), "o_totalprice")
    return top_n_per_group(o, ["customer_key"], [("order_date", "desc"), ("o_totalprice", "asc"),
                                                 ("o_orderkey", "asc")])


# --- WN-03: rank by the greatest of several dates, two tie-breaks, rank kept
@register("latest_of_dates", """
WITH s AS (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship
           FROM lineitem GROUP BY 1),
x AS (SELECT o.o_custkey AS customer_key, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_date, s.first_ship,
             s.last_ship, o.o_totalprice FROM orders o JOIN s ON s.l_orderkey = o.o_orderkey)
SELECT *, CAST(row_number() OVER (PARTITION BY customer_key
                             ORDER BY greatest(order_date, first_ship, last_ship) DESC, o_totalprice DESC, o_orderkey DESC) AS BIGINT) AS rank
FROM x
""")
def latest_of_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min(F.to_date("l_shipdate")).alias("first_ship"), F.max(F.to_date("l_shipdate")).alias("last_ship"))
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_key"), "o_orderkey",
                                          F.to_date("o_orderdate").alias("order_date"), "o_totalprice")
    x = o.join(s, o.o_orderkey == s.l_orderkey).drop("l_orderkey")
    return rank_by_latest_date(x, ["customer_key"], ["order_date", "first_ship", "last_ship"],
                               [("o_totalprice", "desc"), ("o_orderkey", "desc")])


# --- WN-08: last 18 records per key; the newest takes a value from another table
@register("last_18_records", """
WITH r AS (
  SELECT o_custkey AS customer_key, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS INTEGER) AS record_no
  FROM orders)
SELECT r.customer_key, r.o_orderkey, r.order_date, r.o_totalprice, r.record_no,
       coalesce(CASE WHEN r.record_no = 1 THEN c.c_mktsegment END, 'none') AS segment,
       coalesce(CASE WHEN r.record_no = 1 THEN c.c_acctbal END, 0) AS balance
FROM r LEFT JOIN customer c ON c.c_custkey = r.customer_key
WHERE r.record_no <= 18
""")
def last_18_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_key"), "o_orderkey",
                                          F.to_date("o_orderdate").alias("order_date"), "o_totalprice")
    last = last_n_records(o, ["customer_key"], [("order_date", "desc"), ("o_orderkey", "desc")], 18)
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"), "c_mktsegment", "c_acctbal")
    j = last.join(c, "customer_key", "left")
    newest = F.col("record_no") == 1
    out = j.select("customer_key", "o_orderkey", "order_date", "o_totalprice", "record_no",
                   F.when(newest, F.col("c_mktsegment")).alias("segment"),
                   F.when(newest, F.col("c_acctbal")).alias("balance"))
    return fill_numeric_zero(out.fillna({"segment": "none"}), ["balance"])


# --- WN-07: keep the first ceil(rows / reports) rows per group
@register("ratio_cut", """
WITH d AS (SELECT l_orderkey, count(DISTINCT l_linestatus) AS reports FROM lineitem GROUP BY 1),
x AS (SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, l.l_quantity, d.reports,
             count(*) OVER (PARTITION BY l.l_orderkey) AS n,
             row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_suppkey, l.l_partkey, l.l_quantity) AS rn
      FROM lineitem l JOIN d ON d.l_orderkey = l.l_orderkey)
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity FROM x WHERE rn <= ceil(n / reports)
""")
def ratio_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
                                             "l_quantity", "l_linestatus")
    kept = keep_ratio(li, ["l_orderkey"], ["l_linenumber", "l_suppkey", "l_partkey", "l_quantity"],
                      distinct_col="l_linestatus")
    return kept.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")


# --- WN-12: entity matching (rank candidates, unique persons, drop weak matches)
@register("entity_match", """
WITH c AS (
  SELECT l.l_suppkey AS person_key, o.o_custkey AS customer_key,
         CAST(strftime(CAST(o.o_orderdate AS DATE), '%Y%m') AS INTEGER) AS year_month,
         CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 3 WHEN 'R' THEN 4 END AS match,
         l.l_linestatus AS module
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
b AS (SELECT person_key, customer_key, year_month, match FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_key, year_month ORDER BY module DESC, match ASC, person_key ASC) AS rn
        FROM c) WHERE rn = 1),
u AS (SELECT person_key, year_month FROM b GROUP BY 1, 2 HAVING count(DISTINCT customer_key) = 1),
e AS (SELECT b.* FROM b JOIN u USING (person_key, year_month)),
m AS (SELECT customer_key FROM e GROUP BY 1 HAVING count(*) > 1 AND sum(CASE WHEN match = 4 THEN 1 END) >= 1)
SELECT e.customer_key, e.person_key, e.year_month, e.match FROM e LEFT JOIN m ON m.customer_key = e.customer_key
WHERE e.match <> 4 OR m.customer_key IS NULL
""")
def entity_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.functions.lookup import map_lookup
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus")
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_suppkey").alias("person_key"), F.col("o_custkey").alias("customer_key"),
        F.date_format(F.to_date("o_orderdate"), "yyyyMM").cast("int").alias("year_month"),
        map_lookup("l_returnflag", {"A": 1, "N": 3, "R": 4}).alias("match"),
        F.col("l_linestatus").alias("module"))
    return match_entities(c)


def match_entities(c: DataFrame) -> DataFrame:
    """WN-12 operator: the best candidate of each (customer, month), best
    module first, then strongest match; a person that is the best candidate of
    several customers in a month is no match for any of them; and of a
    customer's matches over the months, weak ones (4) count only alone.

    Each step is one shuffle. A person's rows in a month are aggregated, not
    joined back: where there is one customer, its minimum is that customer. A
    customer's rows left are at most one per month, so a window sees them all.
    """
    best = top_n_per_group(c, ["customer_key", "year_month"],
                           [("module", "desc"), ("match", "asc"), ("person_key", "asc")])
    alone = (best.groupBy("person_key", "year_month")
             .agg(F.count(F.lit(1)).alias("claims"), F.min("customer_key").alias("customer_key"),
                  F.min("match").alias("match"))
             .where(F.col("claims") == 1))
    months = F.count(F.lit(1)).over(Window.partitionBy("customer_key"))
    return (alone.withColumn("months", months)
            .where((F.col("match") != 4) | (F.col("months") == 1))
            .select("customer_key", "person_key", "year_month", "match"))


# --- WN-11 / QA-09: volume control over 18 preceding months, k = 2.2
def _r6(c: str) -> str:
    return f"round({c}, 6) AS {c}"


VOLUME_AS_OF = "2001-12-05"  # run date: the months after the last load show no rows


@register("volume_control", f"""
WITH o AS (SELECT o_custkey, last_day(CAST(o_orderdate AS DATE)) AS m FROM orders),
sp AS (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', min(m)), last_day(DATE '{VOLUME_AS_OF}' - INTERVAL 1 MONTH), INTERVAL 1 MONTH)) AS DATE)) AS info_date FROM o),
cnt AS (SELECT m AS info_date, count(*) AS records, count(DISTINCT o_custkey) AS customers FROM o GROUP BY 1),
s AS (SELECT 'orders' AS table_name, CAST(coalesce(records, 0) AS BIGINT) AS records,
             CAST(coalesce(customers, 0) AS BIGINT) AS customers, sp.info_date
      FROM sp LEFT JOIN cnt USING (info_date)),
w AS (SELECT *,
        avg(records) OVER h AS records_mean, stddev_samp(records) OVER h AS records_sd, count(records) OVER h AS records_n_hist,
        avg(customers) OVER h AS customers_mean, stddev_samp(customers) OVER h AS customers_sd, count(customers) OVER h AS customers_n_hist
      FROM s WINDOW h AS (PARTITION BY table_name ORDER BY info_date ROWS BETWEEN 18 PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, records_mean - 2.2 * records_sd AS records_lower, records_mean + 2.2 * records_sd AS records_upper,
             customers_mean - 2.2 * customers_sd AS customers_lower, customers_mean + 2.2 * customers_sd AS customers_upper FROM w)
SELECT table_name, records, customers, info_date, records_n_hist, customers_n_hist,
       {_r6("records_mean")}, {_r6("records_sd")}, {_r6("records_lower")}, {_r6("records_upper")},
       {_r6("customers_mean")}, {_r6("customers_sd")}, {_r6("customers_lower")}, {_r6("customers_upper")},
       CASE WHEN records_n_hist < 12 THEN 'NO_HISTORY' WHEN records_sd IS NULL OR records_sd = 0 THEN 'OK'
            WHEN records < records_lower THEN 'ALERT_LOW' WHEN records > records_upper THEN 'ALERT_HIGH' ELSE 'OK' END AS records_state,
       round(CASE WHEN records_sd IS NULL OR records_sd = 0 THEN NULL ELSE (records - records_mean) / records_sd END, 6) AS records_z,
       CASE WHEN customers_n_hist < 12 THEN 'NO_HISTORY' WHEN customers_sd IS NULL OR customers_sd = 0 THEN 'OK'
            WHEN customers < customers_lower THEN 'ALERT_LOW' WHEN customers > customers_upper THEN 'ALERT_HIGH' ELSE 'OK' END AS customers_state,
       round(CASE WHEN customers_sd IS NULL OR customers_sd = 0 THEN NULL ELSE (customers - customers_mean) / customers_sd END, 6) AS customers_z
FROM b
""", headline=True)
def volume_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    rep = volume_report(volume_series(o, "orders", "o_orderdate", VOLUME_AS_OF, "o_custkey"))
    doubles = [f.name for f in rep.schema.fields if f.dataType.simpleString() == "double"]
    return rep.select(*[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in rep.columns])
