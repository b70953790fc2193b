"""More layer nodes: bureau debt parsing, history, catalogs, instalments,
income and supplier flags, foreign-exchange channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featuremart.functions import lookup as L
from featuremart.functions import text as T
from featuremart.functions.dates import last_closed_month_end
from featuremart.operators import aggregates as A
from featuremart.operators.columns import fill_numeric_zero, to_val_columns
from featuremart.operators.joins import fact_join
from featuremart.operators.setops import union_missing_as_null
from featuremart.plans.customer import _ratio4_sql, ratio4
from featuremart.plans.inputs import t, transactions
from featuremart.plans.registry import register

# Node parameters, with codes of their own on the driver tables: grade code of a debt -> days
# past due, and -> status group. Codes outside the tables give null.
GRADE_DAYS = {"g0": 0, "g1": 30, "g2": 60, "g3": 90, "g4": 120, "g4x": 120, "g5": 121}
GRADE_STATUS = {c: "current" if c == "g0" else "late" for c in GRADE_DAYS}
GRADE_CODES = [*GRADE_DAYS, "none"]  # "none": a code outside both tables
FREQUENCIES = {1: "monthly", 2: "quarterly", 3: "yearly"}
ASSET_RULES = [([("like", "%ring%"), ("like", "%small%")], "small_ring"),
               ("like", "%widget%", "widget"),
               ("like", "%brand#1%", "brand_1x"),
               ("like", "%economy%", "economy")]


# --- CL-28 / SC-06 / SC-28..32: comma text -> parts, grade lookups, one-hot arrears
def _debt_text(li: DataFrame, p: DataFrame) -> DataFrame:
    """Raw bureau-style record: "entity,link,ref1,ref2,ref3" plus a grade code."""
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        "l_orderkey", "l_linenumber",
        F.concat_ws(",", F.concat(F.lit("E"), F.col("l_suppkey").cast("string")),
                    F.when(F.col("l_linestatus") == "F", F.lit("D")).otherwise(F.lit("I")),
                    F.lower("p_type"), F.lower("p_brand"),
                    F.when(F.col("l_linenumber") % 3 == 0, F.lit("")).otherwise(F.col("p_name")))
        .alias("raw"),
        F.element_at(F.array(*[F.lit(c) for c in GRADE_CODES]), (F.col("l_partkey") % 8 + 1).cast("int"))
        .alias("grade"),
        F.col("l_linenumber").alias("frequency_code"))


@register("debt_parsing", f"""
WITH r AS (
  SELECT l.l_orderkey, l.l_linenumber,
         concat_ws(',', 'E' || CAST(l.l_suppkey AS VARCHAR), CASE WHEN l.l_linestatus = 'F' THEN 'D' ELSE 'I' END,
                   lower(p.p_type), lower(p.p_brand), CASE WHEN l.l_linenumber % 3 = 0 THEN '' ELSE p.p_name END) AS raw,
         {GRADE_CODES}[CAST(l.l_partkey % 8 + 1 AS INTEGER)] AS grade,
         l.l_linenumber AS frequency_code
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
s AS (SELECT *, string_split(raw, ',') AS parts FROM r),
x AS (SELECT l_orderkey, l_linenumber, grade, parts[1] AS entity, parts[2] AS link,
             CASE WHEN length(parts[5]) >= 2 THEN parts[5] WHEN length(parts[4]) >= 2 THEN parts[4] ELSE parts[3] END AS asset_type,
             CASE grade {" ".join(f"WHEN '{c}' THEN {d}" for c, d in GRADE_DAYS.items())} END AS days_past_due,
             CASE grade {" ".join(f"WHEN '{c}' THEN '{x}'" for c, x in GRADE_STATUS.items())} END AS status,
             CASE frequency_code WHEN 1 THEN 'monthly' WHEN 2 THEN 'quarterly' WHEN 3 THEN 'yearly' END AS frequency
      FROM s)
SELECT *,
       CASE WHEN asset_type LIKE '%ring%' AND asset_type LIKE '%small%' THEN 'small_ring'
            WHEN asset_type LIKE '%widget%' THEN 'widget' WHEN asset_type LIKE '%brand#1%' THEN 'brand_1x'
            WHEN asset_type LIKE '%economy%' THEN 'economy' END AS asset_group,
       CAST(CASE WHEN days_past_due = 30 THEN 1 ELSE 0 END AS INTEGER) AS arrears_30,
       CAST(CASE WHEN days_past_due = 60 THEN 1 ELSE 0 END AS INTEGER) AS arrears_60,
       CAST(CASE WHEN days_past_due = 90 THEN 1 ELSE 0 END AS INTEGER) AS arrears_90,
       CAST(CASE WHEN days_past_due = 120 THEN 1 ELSE 0 END AS INTEGER) AS arrears_120
FROM x
""")
def debt_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _debt_text(t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "part"))
    parts = F.split("raw", ",")
    x = raw.select(
        "l_orderkey", "l_linenumber", "grade",
        F.get(parts, 0).alias("entity"), F.get(parts, 1).alias("link"),
        L.last_meaningful(F.get(parts, 2), F.get(parts, 3), F.get(parts, 4)).alias("asset_type"),
        L.map_lookup("grade", GRADE_DAYS).alias("days_past_due"),
        L.map_lookup("grade", GRADE_STATUS).alias("status"),
        L.map_lookup("frequency_code", FREQUENCIES).alias("frequency"))
    return x.select("*", L.rule_chain("asset_type", ASSET_RULES).alias("asset_group"),
                    *[T.one_hot("days_past_due", d).alias(f"arrears_{d}") for d in (30, 60, 90, 120)])


# --- TR-44 / CL-34 / CL-49: latest report only (max + join), summary per type
@register("history_latest_report", """
WITH h AS (SELECT o.o_custkey AS customer_key, CAST(o.o_orderdate AS DATE) AS report_date, l.l_linestatus AS debt_type,
                  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS grade
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
m AS (SELECT customer_key, max(report_date) AS report_date FROM h GROUP BY 1)
SELECT customer_key, debt_type, report_date, CAST(count(*) AS BIGINT) AS records,
       CAST(round(sum(amount), 2) AS DECIMAL(19,2)) AS amount_val, max(grade) AS worst_grade
FROM h JOIN m USING (customer_key, report_date) GROUP BY 1, 2, 3
""")
def history_latest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_key"), F.to_date("o_orderdate").alias("report_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("grade"))
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linestatus").alias("debt_type"),
                                             F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    h = fact_join(li, o)
    # rank 1 is cut in every task before the shuffle; the sums then shuffle partial rows only
    newest = F.rank().over(Window.partitionBy("customer_key").orderBy(F.desc("report_date")))
    latest = h.withColumn("newest", newest).where(F.col("newest") == 1)
    g = latest.groupBy("customer_key", "debt_type", "report_date").agg(
        F.count(F.lit(1)).alias("records"), F.sum("amount").alias("amount"), F.max("grade").alias("worst_grade"))
    return to_val_columns(g)


# --- CL-02 / CL-24 / CL-42 / CL-44 / CL-51: catalog cleaning
@register("catalog_cleaning", """
WITH b AS (SELECT p_brand, CAST(substr(p_brand, 7) AS INTEGER) AS grade, max(p_name) AS description,
                  max(p_type) AS brand_group, CAST(count(DISTINCT CAST(p_retailprice AS DECIMAL(10,2))) AS BIGINT) AS prices
           FROM part GROUP BY 1),
a AS (SELECT last_day(CAST(max(o_orderdate) AS DATE) - INTERVAL 1 MONTH) AS closed_month FROM orders)
SELECT b.p_brand AS brand, b.grade, right(repeat('0', 4) || CAST(b.grade AS VARCHAR), 4) AS brand_code,
       list_aggregate(list_transform(string_split(b.description, ' '),
                      lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), 'string_agg', ' ') AS description,
       b.brand_group, b.prices, n.p_brand AS next_brand, CAST(a.closed_month AS DATE) AS catalog_date
FROM b LEFT JOIN b n ON n.grade = b.grade + 1 CROSS JOIN a
""")
def catalog_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part")
    b = p.groupBy("p_brand").agg(
        F.max("p_name").alias("description"), F.max("p_type").alias("brand_group"),
        F.count_distinct(F.col("p_retailprice").cast("decimal(10,2)")).alias("prices")) \
        .withColumn("grade", F.substr("p_brand", F.lit(7)).cast("int"))
    nxt = b.select(F.col("grade").alias("__g"), F.col("p_brand").alias("next_brand"))
    out = b.join(nxt, F.col("__g") == F.col("grade") + 1, "left").drop("__g")
    # as-of stamp (CL-42): a one-row aggregate read as a scalar (no cross join)
    as_of = t(spark, sf_dir, "orders").agg(
        last_closed_month_end(F.max(F.to_date("o_orderdate"))).alias("d")).first()["d"]
    out = out.withColumn("catalog_date", F.lit(as_of).cast("date"))
    return out.select(F.col("p_brand").alias("brand"), "grade",
                      T.left_pad_keep_right("grade", 4).alias("brand_code"),
                      F.initcap("description").alias("description"),
                      "brand_group", "prices", "next_brand", "catalog_date")


# --- TR-10 / CL-15: instalments: totals, paid ratio, pivot by group, full join with limits
INSTALMENT_GROUPS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _instalments_sql() -> str:
    piv = ", ".join(
        f"coalesce(sum(CASE WHEN p_type = '{g}' THEN amount END), 0) AS {g.lower()}_amount" for g in INSTALMENT_GROUPS)
    vals = ", ".join(f"CAST(round({g.lower()}_amount, 2) AS DECIMAL(19,2)) AS {g.lower()}_amount_val"
                     for g in INSTALMENT_GROUPS)
    return f"""
WITH x AS (SELECT o.o_custkey AS customer_key, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, l.l_returnflag, p.p_type
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
g AS (SELECT customer_key, sum(amount) AS total, coalesce(sum(CASE WHEN l_returnflag <> 'R' THEN amount END), 0) AS paid, {piv}
      FROM x GROUP BY 1),
lim AS (SELECT c_custkey AS customer_key, CAST(c_acctbal AS DECIMAL(18,2)) AS credit_limit FROM customer)
SELECT coalesce(g.customer_key, lim.customer_key) AS customer_key,
       CAST(round(g.total, 2) AS DECIMAL(19,2)) AS total_val, CAST(round(g.paid, 2) AS DECIMAL(19,2)) AS paid_val,
       CASE WHEN g.total > 0 THEN {_ratio4_sql("g.paid", "g.total")} END AS paid_ratio,
       {vals}, CAST(round(lim.credit_limit, 2) AS DECIMAL(19,2)) AS credit_limit_val
FROM g FULL JOIN lim ON g.customer_key = lim.customer_key
"""


@register("instalments", _instalments_sql())
def instalments(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = transactions(spark, sf_dir)
    p = t(spark, sf_dir, "part").select("p_partkey", "p_type")
    x = x.join(p, x.l_partkey == p.p_partkey)
    g = x.groupBy("customer_key").agg(
        F.sum("amount").alias("total"),
        F.coalesce(A.sum_if(F.col("kind") != "R", "amount"), F.lit(0)).alias("paid"),
        *A.pivot_aggs("p_type", INSTALMENT_GROUPS, {"amount": ("sum", "amount")}))
    g = g.withColumn("paid_ratio", F.when(F.col("total") > 0, ratio4("paid", "total")))
    lim = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"),
                                              F.col("c_acctbal").cast("decimal(18,2)").alias("credit_limit"))
    j = g.join(lim, "customer_key", "full")
    vals = [c for c in j.columns if c not in ("customer_key", "paid_ratio")]
    return j.select("customer_key", "paid_ratio",
                    *[F.round(c, 2).cast("decimal(19,2)").alias(f"{c}_val") for c in vals])


# --- TR-16 / TR-21 / TR-25 / TR-48 / CL-08: income, supplier flag, income per request, payments
@register("income_and_supplier", """
WITH inc AS (SELECT o_custkey AS customer_key, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS income
             FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
req AS (SELECT o.o_custkey AS customer_key, o.o_orderkey,
               coalesce(sum(CASE WHEN l.l_returnflag = 'N' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END), 0) AS salary,
               sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS reported
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
r AS (SELECT customer_key, CAST(count(*) AS BIGINT) AS requests_cnt, sum(salary) AS salary, sum(reported) AS reported FROM req GROUP BY 1),
pay AS (SELECT customer_key, CAST(count(*) AS BIGINT) AS supplier_payments_cnt FROM (
          SELECT DISTINCT o.o_custkey AS customer_key, l.l_suppkey, l.l_orderkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
        GROUP BY 1),
sup AS (SELECT DISTINCT s_suppkey AS customer_key, 1 AS supplier_flag FROM supplier)
SELECT c.c_custkey AS customer_key,
       CAST(round(coalesce(inc.income, 0), 2) AS DECIMAL(19,2)) AS income_val,
       coalesce(sup.supplier_flag, 0) AS supplier_flag,
       coalesce(r.requests_cnt, 0) AS requests_cnt,
       CAST(round(coalesce(r.salary, 0), 2) AS DECIMAL(19,2)) AS salary_val,
       CAST(round(coalesce(r.reported, 0), 2) AS DECIMAL(19,2)) AS reported_val,
       coalesce(pay.supplier_payments_cnt, 0) AS supplier_payments_cnt
FROM customer c LEFT JOIN inc ON inc.customer_key = c.c_custkey LEFT JOIN sup ON sup.customer_key = c.c_custkey
     LEFT JOIN r ON r.customer_key = c.c_custkey LEFT JOIN pay ON pay.customer_key = c.c_custkey
""")
def income_and_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"))
    # one pass over the lines per request (TR-25 filter, TR-48 without, CL-08 distinct payments),
    # one over the requests per customer
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag",
                                             F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    per_request = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.coalesce(A.sum_if(F.col("l_returnflag") == "N", "amount"), F.lit(0)).alias("salary"),
        F.sum("amount").alias("reported"), F.count_distinct("l_suppkey").alias("payments"))
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_key"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)")).alias("income"))
    per_customer = o.join(per_request.hint("shuffle_merge"), "o_orderkey", "left").groupBy("customer_key").agg(
        F.sum("income").alias("income"), F.count("reported").alias("requests_cnt"), F.sum("salary").alias("salary"),
        F.sum("reported").alias("reported"), F.sum("payments").alias("supplier_payments_cnt"))
    sup = (t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("customer_key")).distinct()
           .withColumn("supplier_flag", F.lit(1)))
    j = c.join(sup, "customer_key", "left").join(per_customer, "customer_key", "left")
    j = fill_numeric_zero(j, ["income", "supplier_flag", "requests_cnt", "salary", "reported",
                              "supplier_payments_cnt"])
    return to_val_columns(j)


# --- CL-34 / CL-36 / CL-53 / CL-55: three channels, buy/sell codes, merged by name
@register("forex_channels", """
WITH e AS (SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events),
trading AS (SELECT event_id, user_id AS customer_key, 'trading' AS channel,
                   CASE WHEN v > 10 THEN 'C' ELSE 'V' END AS op_code, v AS buy_value, v * -1 AS sell_value
            FROM e WHERE event_type = 'purchase'),
digital AS (SELECT event_id, user_id AS customer_key, 'digital' AS channel,
                   CASE WHEN v > 10 THEN '1' ELSE '2' END AS op_code, v AS buy_value, v * -1 AS sell_value
            FROM e WHERE event_type = 'click'),
branch AS (SELECT event_id, user_id AS customer_key, 'branch' AS channel,
                  CASE WHEN v > 10 THEN 'C' ELSE 'V' END AS op_code, v AS buy_value, v * -1 AS sell_value, 'x' AS teller
           FROM e WHERE event_type NOT IN ('purchase', 'click')),
u AS (SELECT *, NULL AS teller FROM trading UNION ALL SELECT *, NULL FROM digital UNION ALL SELECT * FROM branch)
SELECT event_id, customer_key, channel, teller,
       CASE WHEN op_code IN ('C', '1') THEN 'buy' WHEN op_code IN ('V', '2') THEN 'sell' END AS operation,
       CAST(CASE WHEN channel = 'digital' THEN CASE op_code WHEN '1' THEN buy_value WHEN '2' THEN sell_value END
            ELSE CASE op_code WHEN 'C' THEN buy_value WHEN 'V' THEN sell_value END END AS DECIMAL(19,2)) AS amount
FROM u
""")
def forex_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("customer_key"), "event_type",
                                          F.col("value").cast("decimal(18,2)").alias("v"))
    # each channel uses its own code pair for buy / sell (fixed per channel)
    codes = {"trading": ("C", "V"), "digital": ("1", "2"), "branch": ("C", "V")}
    src = {"trading": "purchase", "digital": "click", "branch": None}  # branch: every other operation
    parts = []
    for ch, et in src.items():
        buy, sell = codes[ch]
        mine = F.col("event_type") == et if et else ~F.col("event_type").isin(*filter(None, src.values()))
        df = e.where(mine).select(
            "event_id", "customer_key", F.lit(ch).alias("channel"),
            F.when(F.col("v") > 10, F.lit(buy)).otherwise(F.lit(sell)).alias("op_code"),
            F.col("v").alias("buy_value"), (F.col("v") * -1).alias("sell_value"))
        if ch == "branch":
            df = df.withColumn("teller", F.lit("x"))
        df = df.select("*",
                       L.pick_by_code("op_code", buy, F.lit("buy"), sell, F.lit("sell")).alias("operation"),
                       L.pick_by_code("op_code", buy, F.col("buy_value"), sell, F.col("sell_value"),
                                      cast="decimal(19,2)").alias("amount"))
        parts.append(df.drop("op_code", "buy_value", "sell_value"))
    return union_missing_as_null(parts).select("event_id", "customer_key", "channel", "teller",
                                               "operation", "amount")


# --- AG-14: custom counts per status pivoted, every int column suffixed _cnt
@register("debt_status_counts", """
SELECT o_custkey AS customer_key,
       CAST(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN last_day(CAST(o_orderdate AS DATE)) END) AS BIGINT) AS f_months_cnt,
       CAST(count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN last_day(CAST(o_orderdate AS DATE)) END) AS BIGINT) AS o_months_cnt,
       CAST(count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN last_day(CAST(o_orderdate AS DATE)) END) AS BIGINT) AS p_months_cnt,
       CAST(max(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS INTEGER) AS worst_grade_cnt
FROM orders GROUP BY 1
""")
def debt_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.operators.columns import int_columns_with_cnt
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), "o_orderstatus",
        F.last_day(F.to_date("o_orderdate")).alias("m"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("grade"))
    # custom count: months with at least one order in the status (distinct month
    # per key first, then plain counts: no Expand)
    months = o.select("customer_key", "o_orderstatus", "m").distinct()
    piv = A.pivot_measures(months, ["customer_key"], "o_orderstatus", ["F", "O", "P"],
                           {"months": ("count", None)})
    worst = o.groupBy("customer_key").agg(F.max("grade").alias("worst_grade"))
    return int_columns_with_cnt(piv.join(worst, "customer_key"), exclude=["customer_key"])


# --- select-only nodes as one project(spec) each (TR-05 / TR-17 / TR-22 / TR-37 / TR-40)
def product_spec() -> dict:
    """Spec of a select-only node: output name -> column name or expression."""
    return {"customer_key": "o_custkey", "account_key": "o_orderpriority", "product_code": "o_orderstatus",
            "opened_on": F.to_date("o_orderdate"), "order_key": "o_orderkey"}


@register("project_nodes", """
SELECT o_custkey AS customer_key, o_orderpriority AS account_key, o_orderstatus AS product_code,
       CAST(o_orderdate AS DATE) AS opened_on, o_orderkey AS order_key FROM orders
""")
def project_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from featuremart.operators.columns import project
    return project(t(spark, sf_dir, "orders"), product_spec())


# --- WN-10 / TR-29: best category among accounts without add-ons, valid add-on count,
#     and the account -> case bridge (inner join, distinct)
@register("card_addons", """
WITH acc AS (SELECT DISTINCT o_custkey AS customer_key, o_orderpriority AS account_key,
                    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS category FROM orders),
addon AS (SELECT DISTINCT o.o_custkey AS customer_key, o.o_orderpriority AS account_key
          FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R'),
best AS (SELECT customer_key, account_key AS best_account, category AS best_category FROM (
           SELECT a.*, row_number() OVER (PARTITION BY a.customer_key ORDER BY a.category DESC, a.account_key ASC) AS rn
           FROM acc a WHERE NOT EXISTS (SELECT 1 FROM addon d WHERE d.customer_key = a.customer_key AND d.account_key = a.account_key))
         WHERE rn = 1),
cnt AS (SELECT customer_key, CAST(count(*) AS BIGINT) AS addons_cnt FROM addon GROUP BY 1),
cases AS (SELECT o_custkey AS customer_key, CAST(count(DISTINCT o_orderpriority || '/' || o_orderstatus) AS BIGINT) AS cases_cnt
          FROM orders GROUP BY 1)
SELECT c.customer_key, best.best_account, best.best_category, coalesce(cnt.addons_cnt, 0) AS addons_cnt, c.cases_cnt
FROM cases c LEFT JOIN best USING (customer_key) LEFT JOIN cnt USING (customer_key)
""")
def card_addons(spark: SparkSession, sf_dir: str) -> DataFrame:
    # accounts with their add-on flag and their cases in one pass over orders and lines
    addon = t(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R") \
        .select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("addon", F.lit(1))
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_key"),
                                          F.col("o_orderpriority").alias("account_key"), "o_orderstatus")
    acc = o.join(addon.hint("shuffle_merge"), "o_orderkey", "left").groupBy("customer_key", "account_key").agg(
        F.coalesce(F.max("addon"), F.lit(0)).alias("addon"), F.count_distinct("o_orderstatus").alias("cases"))
    category = F.substring("account_key", 1, 1).cast("int")
    plain = F.when(F.col("addon") == 0, F.struct((-category).alias("order"), F.col("account_key")))
    return acc.groupBy("customer_key").agg(
        F.min(plain).alias("best"), F.sum("addon").alias("addons_cnt"), F.sum("cases").alias("cases_cnt")) \
        .select("customer_key", F.col("best.account_key").alias("best_account"),
                (-F.col("best.order")).alias("best_category"), "addons_cnt", "cases_cnt")
