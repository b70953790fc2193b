"""Cleaning nodes (raw -> typed table) not covered by the other layer
modules, recast on the driver tables, plus the account-level transformation
steps that build directly on them (TR-12, TR-14, TR-27, TR-28).

Every node reads whole tables. Code lists and word lists here are the
node's parameters on the driver tables, not values of the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featuremart.functions import dates as D
from featuremart.functions import lookup as L
from featuremart.functions import text as T
from featuremart.functions.currency import currency_views
from featuremart.operators import windows as W
from featuremart.operators.broadcast import join_small
from featuremart.operators.columns import (fill_numeric_zero, label_missing_text,
                                           project, to_val_columns)
from featuremart.operators.joins import add_rate, first_per_group, join_all
from featuremart.plans.inputs import (CURRENCIES, FOREIGN, HOME, RATES_SQL, SNAPSHOTS_SQL,
                                      TRANSACTIONS_SQL, rates, t, transactions)
from featuremart.plans.registry import register


def _val(expr: str, alias: str) -> str:
    return f"CAST(round({expr}, 2) AS DECIMAL(19,2)) AS {alias}"


def _months_sql(a: str, b: str) -> str:
    """Spark's whole-month rule (``months_between`` truncated), for DuckDB."""
    m = f"((year({a}) - year({b})) * 12 + month({a}) - month({b}))"
    return (f"(CASE WHEN ({a} = last_day({a}) AND {b} = last_day({b})) OR day({a}) >= day({b}) "
            f"THEN {m} ELSE {m} - 1 END)")


def _slug_sql(c: str) -> str:
    return (f"replace(regexp_replace(trim(regexp_replace({c}, '[^\\p{{L}}\\p{{N}} ]+', ' ', 'g')), "
            f"' +', '_', 'g'), ' ', '_')")


def _case_sql(c: str, mapping: dict, default: str | None = None) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    expr = f"CASE {c} {whens} END"
    return f"coalesce({expr}, {lit(default)})" if default is not None else expr


# Node parameters on the driver tables.
CARD_STATUS = {"F": "settled", "O": "current", "P": "in_arrears"}
BAD_SITUATIONS = ["in_arrears"]
ACCOUNT_STATUS = {"F": "closed", "O": "active", "P": "blocked"}
REQUEST_STATES = {"F": "granted", "O": "in_review", "P": "rejected"}
AS_OF = "2002-01-01"


# --- CL-11: add-on cards: select, status lookup (SC-07), bad-situation flag (SC-09)
@register("addon_cards", f"""
SELECT o_custkey AS customer_key, o_orderpriority AS account_key, o_orderkey AS card_key,
       CAST(o_orderdate AS DATE) AS opened_on,
       {_case_sql('o_orderstatus', CARD_STATUS, 'unknown')} AS status,
       CAST(coalesce({_case_sql('o_orderstatus', CARD_STATUS, 'unknown')} IN ('in_arrears'), false) AS INTEGER)
         AS bad_situation_flag
FROM orders
""")
def addon_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    x = o.select(F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"),
                 F.col("o_orderkey").alias("card_key"), F.to_date("o_orderdate").alias("opened_on"),
                 L.map_lookup("o_orderstatus", CARD_STATUS, default="unknown").alias("status"))
    return x.withColumn("bad_situation_flag", L.in_list_flag("status", BAD_SITUATIONS))


# --- CL-17: card movements: select, codes cut out of text with substring
@register("card_movements", f"""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS trx_date,
       substr(l_returnflag || l_linestatus, 1, 1) AS movement_kind,
       substr(l_returnflag || l_linestatus, 2, 1) AS movement_state,
       substr(CAST(l_suppkey AS VARCHAR), 1, 2) AS branch_code,
       {_val("CAST(l_extendedprice AS DECIMAL(18,2))", "amount_val")}
FROM lineitem
""")
def card_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    code = F.concat("l_returnflag", "l_linestatus")
    x = li.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("trx_date"),
                  F.substring(code, 1, 1).alias("movement_kind"),
                  F.substring(code, 2, 1).alias("movement_state"),
                  F.substring(F.col("l_suppkey").cast("string"), 1, 2).alias("branch_code"),
                  F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    return to_val_columns(x)


# --- CL-18: account changes, value before and after, nulls -> 0
@register("account_changes", f"""
SELECT o_orderkey AS change_key, o_custkey AS customer_key, o_orderpriority AS account_key,
       CAST(o_orderdate AS DATE) AS change_date,
       {_val("coalesce(CASE WHEN o_orderstatus <> 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END, 0)", "limit_before_val")},
       {_val("coalesce(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END, 0)", "limit_after_val")}
FROM orders
""")
def account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    x = o.select(F.col("o_orderkey").alias("change_key"), F.col("o_custkey").alias("customer_key"),
                 F.col("o_orderpriority").alias("account_key"), F.to_date("o_orderdate").alias("change_date"),
                 F.when(F.col("o_orderstatus") != "O", price).alias("limit_before"),
                 F.when(F.col("o_orderstatus") != "F", price).alias("limit_after"))
    return to_val_columns(fill_numeric_zero(x, ["limit_before", "limit_after"]))


# --- CL-19 / TR-12 / TR-14: current accounts with age measures (SC-01..03) and a status
#     lookup; balance by currency at the month-end rate; left join of the month's movements
CURRENT_ACCOUNT_SQL = f"""
WITH r AS ({RATES_SQL}), s AS ({SNAPSHOTS_SQL}), x AS ({TRANSACTIONS_SQL}),
f AS (SELECT o_custkey AS customer_key, o_orderpriority AS account_key,
             min(CAST(o_orderdate AS DATE)) AS first_order FROM orders GROUP BY 1, 2),
m AS (SELECT customer_key, account_key, last_day(trx_date) AS info_date,
             CAST(count_if(direction = 'F') AS BIGINT) AS credit_cnt,
             sum(CASE WHEN direction = 'F' THEN amount END) AS credit_amount,
             CAST(count_if(direction = 'O') AS BIGINT) AS debit_cnt,
             sum(CASE WHEN direction = 'O' THEN amount END) AS debit_amount
      FROM x GROUP BY 1, 2, 3),
b AS (SELECT s.*, f.first_order, r.rate,
             CASE WHEN s.customer_key % 2 = 0 THEN {HOME} ELSE {FOREIGN} END AS currency_id
      FROM s JOIN f USING (customer_key, account_key) LEFT JOIN r ON r.rate_date = s.info_date)
SELECT b.customer_key, b.account_key, b.info_date,
       {_case_sql('b.status', ACCOUNT_STATUS, 'unknown')} AS status,
       CAST(floor(greatest({_months_sql('b.info_date', 'b.first_order')}, 0) / 12) AS INTEGER) AS years_open,
       CAST(greatest({_months_sql('b.info_date', 'b.first_order')}, 0) AS INTEGER) AS months_open,
       CAST(b.info_date - b.order_date AS INTEGER) AS days_since_move,
       {_val(f"CASE WHEN b.currency_id = {HOME} THEN b.balance ELSE 0 END", "balance_home_val")},
       {_val(f"CASE WHEN b.currency_id = {FOREIGN} THEN b.balance ELSE 0 END", "balance_foreign_val")},
       {_val(f"CASE WHEN b.currency_id = {HOME} THEN b.balance ELSE b.balance * b.rate END", "balance_unified_val")},
       coalesce(m.credit_cnt, 0) AS credit_cnt, {_val("coalesce(m.credit_amount, 0)", "credit_amount_val")},
       coalesce(m.debit_cnt, 0) AS debit_cnt, {_val("coalesce(m.debit_amount, 0)", "debit_amount_val")}
FROM b LEFT JOIN m USING (customer_key, account_key, info_date)
"""


@register("current_account_features", CURRENT_ACCOUNT_SQL)
def current_account_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["customer_key", "account_key"]
    # the month's last order (snapshot) and the account's first one from one grouped pass
    o = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"), F.to_date("o_orderdate").alias("order_date"),
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("balance"))
    s = o.groupBy(*keys, F.last_day("order_date").alias("info_date")).agg(
        F.min("order_date").alias("first_order"), W.latest_of("order_date", [F.col("o_orderkey")], ["order_date", "status", "balance"]).alias("last"))
    s = s.select(*keys, "info_date", F.min("first_order").over(Window.partitionBy(*keys)).alias("first_order"), "last.*")
    b = add_rate(s, rates(spark, sf_dir), "info_date", snapshot=True)
    b = b.withColumn("currency_id", F.when(F.col("customer_key") % 2 == 0, F.lit(HOME))
                     .otherwise(F.lit(FOREIGN)))
    # CL-19 ages and status; TR-12 balance by currency (SC-19)
    acct = b.select(*keys, "info_date",
                    L.map_lookup("status", ACCOUNT_STATUS, default="unknown").alias("status"),
                    D.whole_years_between("first_order", "info_date").alias("years_open"),
                    D.whole_months_between("info_date", "first_order").alias("months_open"),
                    D.days_between("order_date", "info_date").alias("days_since_move"),
                    *currency_views("currency_id", "balance", "rate", CURRENCIES, HOME,
                                    value_name="balance"))
    # TR-13 shape per account and month, then TR-14: account left join movements
    x = transactions(spark, sf_dir).withColumn("info_date", F.last_day("trx_date"))
    credit, debit = F.col("direction") == "F", F.col("direction") == "O"
    moves = x.groupBy(*keys, "info_date").agg(
        F.count_if(credit).alias("credit_cnt"), F.sum(F.when(credit, F.col("amount"))).alias("credit_amount"),
        F.count_if(debit).alias("debit_cnt"), F.sum(F.when(debit, F.col("amount"))).alias("debit_amount"))
    out = join_all([acct, moves], keys + ["info_date"], "left")
    out = fill_numeric_zero(out, ["credit_cnt", "credit_amount", "debit_cnt", "debit_amount"])
    return to_val_columns(out)


# --- CL-21: customers: whole years and days since joining (SC-01, SC-03), text flag
#     (SC-05), listed word in any of three texts (SC-26); unknown join date stays null
# Node parameter: words flagged in segment, nation name or customer name.
LISTED_WORDS = ["MACHINERY", "GERMANY", "Customer#000000011"]


def customer_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    n = t(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_name"))
    first = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(F.to_date("o_orderdate")).alias("joined_on"))
    x = join_small(c, n, c.c_nationkey == n.n_nationkey, "left")
    x = x.join(first, x.c_custkey == first.o_custkey, "left")
    return to_val_columns(label_missing_text(x.select(*cleaned_columns()), exclude=["customer_key", "customer_hex"]))


def cleaned_columns() -> list[Column]:
    """CL-21 columns over customer, its nation's name and the first order day."""
    raw_flag = F.when(F.col("c_acctbal") > 0, F.lit(" si ")).otherwise(F.lit("no"))
    return [F.col("c_custkey").alias("customer_key"), T.hex_key("c_custkey").alias("customer_hex"),
            F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), "joined_on",
            D.whole_years_between("joined_on", F.lit(AS_OF)).alias("years_as_customer"),
            D.days_between("joined_on", F.lit(AS_OF)).alias("days_as_customer"),
            T.truthy_flag(raw_flag).alias("positive_balance_flag"),
            T.any_has_word(["c_mktsegment", "n_name", "c_name"], LISTED_WORDS).alias("listed_flag"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("balance")]


def _listed_sql(cols: list[str]) -> str:
    pat = "|".join(f"\\b{w}\\b" for w in LISTED_WORDS)
    return " OR ".join(f"coalesce(regexp_matches(trim({c}), '{pat}'), false)" for c in cols)


CUSTOMER_CLEANED_SQL = f"""
SELECT c.c_custkey AS customer_key, '0x' || hex(c.c_custkey) AS customer_hex,
       CASE WHEN c.c_mktsegment IS NULL OR trim(c.c_mktsegment) = '' THEN 'unknown'
            ELSE regexp_replace(trim(c.c_mktsegment), '\\s+', ' ', 'g') END AS segment,
       CASE WHEN n.n_name IS NULL OR trim(n.n_name) = '' THEN 'unknown'
            ELSE regexp_replace(trim(n.n_name), '\\s+', ' ', 'g') END AS nation,
       f.joined_on,
       CASE WHEN f.joined_on IS NOT NULL
            THEN CAST(floor(greatest({_months_sql(f"DATE '{AS_OF}'", 'f.joined_on')}, 0) / 12) AS INTEGER)
       END AS years_as_customer,
       CAST(DATE '{AS_OF}' - f.joined_on AS INTEGER) AS days_as_customer,
       CASE WHEN upper(trim(CASE WHEN c.c_acctbal > 0 THEN ' si ' ELSE 'no' END)) IN ('S','SI','Y','YES','1','A')
            THEN 1 ELSE 0 END AS positive_balance_flag,
       CASE WHEN {_listed_sql(['c.c_mktsegment', 'n.n_name', 'c.c_name'])} THEN 1 ELSE 0 END AS listed_flag,
       {_val("CAST(c.c_acctbal AS DECIMAL(18,2))", "balance_val")}
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS joined_on FROM orders GROUP BY 1) f
  ON f.o_custkey = c.c_custkey
"""


@register("customer_cleaning", CUSTOMER_CLEANED_SQL)
def customer_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_cleaned(spark, sf_dir)


# --- CL-27: employees with an active flag from text (SC-05)
def employees_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "supplier")
    raw_active = F.when(F.col("s_acctbal") >= 0, F.lit("Y")).otherwise(F.lit(" n"))
    return s.select(F.col("s_suppkey").alias("employee_key"), F.col("s_name").alias("employee_name"),
                    F.col("s_nationkey").alias("nation_key"), T.truthy_flag(raw_active).alias("active_flag"))


EMPLOYEES_SQL = """
SELECT s_suppkey AS employee_key, s_name AS employee_name, s_nationkey AS nation_key,
       CASE WHEN upper(trim(CASE WHEN s_acctbal >= 0 THEN 'Y' ELSE ' n' END)) IN ('S','SI','Y','YES','1','A')
            THEN 1 ELSE 0 END AS active_flag
FROM supplier
"""


@register("employee_cleaning", EMPLOYEES_SQL)
def employee_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees_cleaned(spark, sf_dir)


# --- CL-25: customer - account - product bridge, distinct rows
def products_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("customer_key"), F.col("o_orderpriority").alias("account_key"),
                    F.col("o_orderstatus").alias("product_code")).distinct()


PRODUCTS_SQL = """
SELECT DISTINCT o_custkey AS customer_key, o_orderpriority AS account_key, o_orderstatus AS product_code
FROM orders
"""


@register("products_bridge", PRODUCTS_SQL)
def products_bridge_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products_bridge(spark, sf_dir)


# --- select-only cleaning nodes, one project(spec) each: CL-29 report index, CL-40 joint
#     accounts, CL-50 report header
def report_index_spec() -> dict:
    return {"report_key": "o_orderkey", "person_key": "o_custkey",
            "report_date": F.to_date("o_orderdate"), "source": "o_orderpriority"}


def joint_account_spec() -> dict:
    return {"account_key": "l_orderkey", "holder_key": "l_suppkey", "holder_no": "l_linenumber",
            "joint_since": F.to_date("l_shipdate")}


def report_header_spec() -> dict:
    return {"report_key": "o_orderkey", "person_key": "o_custkey", "report_status": "o_orderstatus",
            "report_date": F.to_date("o_orderdate"),
            "reported_total": F.col("o_totalprice").cast("decimal(18,2)")}


@register("report_index", """
SELECT o_orderkey AS report_key, o_custkey AS person_key, CAST(o_orderdate AS DATE) AS report_date,
       o_orderpriority AS source FROM orders
""")
def report_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(t(spark, sf_dir, "orders"), report_index_spec())


@register("joint_accounts", """
SELECT l_orderkey AS account_key, l_suppkey AS holder_key, l_linenumber AS holder_no,
       CAST(l_shipdate AS DATE) AS joint_since FROM lineitem
""")
def joint_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(t(spark, sf_dir, "lineitem"), joint_account_spec())


@register("report_header", f"""
SELECT o_orderkey AS report_key, o_custkey AS person_key, o_orderstatus AS report_status,
       CAST(o_orderdate AS DATE) AS report_date, {_val("CAST(o_totalprice AS DECIMAL(18,2))", "reported_total_val")}
FROM orders
""")
def report_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_val_columns(project(t(spark, sf_dir, "orders"), report_header_spec()))


# --- CL-35: daily rate table
@register("daily_rates", RATES_SQL)
def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(spark, sf_dir)


# --- CL-30 / TR-27: persons with a name slug (SC-13); customer key kept only when the
#     person is a known customer (left join)
# Node parameter: a bureau person's key is the customer's divided by this; persons whose
# customer does not exist are unknown.
PERSON_STEP = 20


@register("bureau_persons", f"""
WITH k AS (SELECT c_custkey FROM customer)
SELECT s.s_suppkey AS person_key, {_slug_sql('s.s_name')} AS name_slug, s.s_nationkey AS nation_key,
       k.c_custkey AS customer_key
FROM supplier s LEFT JOIN k ON k.c_custkey = s.s_suppkey * {PERSON_STEP}
""")
def bureau_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "supplier")
    known = t(spark, sf_dir, "customer").select("c_custkey")
    # both sides grow with the data: plain (shuffled) left join
    x = s.join(known, s.s_suppkey * PERSON_STEP == known.c_custkey, "left")
    return x.select(F.col("s_suppkey").alias("person_key"), T.slug("s_name").alias("name_slug"),
                    F.col("s_nationkey").alias("nation_key"), F.col("c_custkey").alias("customer_key"))


# --- CL-31 / CL-32 / TR-28: requests with state names and casts; persons per request
#     with job months (years x 12 + months); main applicant per request (JN-06)
@register("bureau_requests", f"""
WITH rq AS (SELECT o_orderkey AS request_key, CAST(o_orderdate AS DATE) AS request_date,
                   {_case_sql('o_orderstatus', REQUEST_STATES, 'unknown')} AS state,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS requested FROM orders),
pr AS (SELECT l_orderkey AS request_key, l_suppkey AS person_key, l_linenumber AS role_no,
              l_linenumber * 12 + CAST(floor(l_quantity) AS INTEGER) % 12 AS job_months FROM lineitem),
k AS (SELECT c_custkey FROM customer),
j AS (SELECT rq.*, pr.person_key, pr.role_no, pr.job_months, k.c_custkey AS customer_key,
             row_number() OVER (PARTITION BY rq.request_key
                                ORDER BY k.c_custkey IS NULL, pr.role_no NULLS FIRST, pr.person_key NULLS FIRST,
                                         pr.job_months DESC) AS rn
      FROM rq LEFT JOIN pr ON pr.request_key = rq.request_key LEFT JOIN k ON k.c_custkey = pr.person_key * {PERSON_STEP})
SELECT request_key, request_date, state, {_val("requested", "requested_val")},
       person_key AS main_person_key, customer_key AS main_customer_key, job_months
FROM j WHERE rn = 1
""")
def bureau_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    rq = o.select(F.col("o_orderkey").alias("request_key"), F.to_date("o_orderdate").alias("request_date"),
                  L.map_lookup("o_orderstatus", REQUEST_STATES, default="unknown").alias("state"),
                  F.col("o_totalprice").cast("decimal(18,2)").alias("requested"))
    li = t(spark, sf_dir, "lineitem")
    pr = li.select(F.col("l_orderkey").alias("request_key"), F.col("l_suppkey").alias("person_key"),
                   F.col("l_linenumber").alias("role_no"),
                   (F.col("l_linenumber") * 12 + F.floor("l_quantity").cast("int") % 12).alias("job_months"))
    known = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"))
    # request -> its persons -> known customers; first entity per request (JN-06). All three
    # sides grow with the data, so both joins shuffle; the top-1 is a WindowGroupLimit.
    j = rq.join(pr, "request_key", "left").join(known, F.col("person_key") * PERSON_STEP == F.col("customer_key"), "left")
    order = [F.col("customer_key").isNull().asc(), F.col("role_no").asc(), F.col("person_key").asc(),
             F.col("job_months").desc()]
    main = first_per_group(j, ["request_key"], order)
    out = main.select("request_key", "request_date", "state", "requested",
                      F.col("person_key").alias("main_person_key"),
                      F.col("customer_key").alias("main_customer_key"), "job_months")
    return to_val_columns(out)


# --- CL-47: external products: name slug (SC-13), ordered categorisations (SC-14, SC-15),
#     missing grade markers (SC-16)
PRODUCT_KIND_RULES = [("eq", "PROMO", "promotional"), ("contains", "LARGE", "large"),
                      ("contains", "SMALL", "small")]
GUARANTEE_RULES = [("like", "%#1%", "first_line"), ("like", "%#2%", "second_line"),
                   ("like", "%#3%", "third_line")]
MISSING_GRADE = ["", "-", "N/A"]


@register("external_products", f"""
WITH p AS (SELECT p_partkey, p_name, p_type, p_brand,
                  CASE WHEN p_size <= 5 THEN ' ' WHEN p_size <= 10 THEN 'N/A' WHEN p_size <= 12 THEN NULL
                       ELSE substr(p_type, 1, 1) END AS raw_grade FROM part)
SELECT p_partkey AS product_key, {_slug_sql('p_name')} AS name_slug,
       CASE WHEN p_type = 'PROMO' THEN 'promotional' WHEN contains(p_type, 'LARGE') THEN 'large'
            WHEN contains(p_type, 'SMALL') THEN 'small' ELSE 'other' END AS product_kind,
       CASE WHEN p_brand LIKE '%#1%' THEN 'first_line' WHEN p_brand LIKE '%#2%' THEN 'second_line'
            WHEN p_brand LIKE '%#3%' THEN 'third_line' END AS guarantee_group,
       CASE WHEN trim(raw_grade) IS NULL OR trim(raw_grade) IN ('', '-', 'N/A') THEN 'S' ELSE trim(raw_grade) END AS grade
FROM p
""")
def external_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part")
    raw_grade = (F.when(F.col("p_size") <= 5, F.lit(" ")).when(F.col("p_size") <= 10, F.lit("N/A"))
                 .when(F.col("p_size") <= 12, F.lit(None).cast("string"))
                 .otherwise(F.substring("p_type", 1, 1)))
    return p.select(F.col("p_partkey").alias("product_key"), T.slug("p_name").alias("name_slug"),
                    L.rule_chain("p_type", PRODUCT_KIND_RULES, default="other").alias("product_kind"),
                    L.rule_chain("p_brand", GUARANTEE_RULES).alias("guarantee_group"),
                    L.missing_marker_to(raw_grade, MISSING_GRADE, "S").alias("grade"))


# --- CL-48: regulator debts: thirteen state codes, payment frequency (SC-32), entity slug
#     (SC-13), missing grade -> "S" (SC-16)
# Node parameter: the thirteen debt states of the stand-in data, by code.
DEBT_STATES = {1: "current", 2: "overdue", 3: "restructured", 4: "refinanced", 5: "in_collection",
               6: "judicial", 7: "written_off", 8: "settled", 9: "cancelled", 10: "frozen",
               11: "extended", 12: "disputed", 13: "transferred"}
FREQUENCIES = {1: "monthly", 2: "quarterly", 3: "yearly"}


@register("regulator_debts", f"""
SELECT l_orderkey AS report_key, l_linenumber AS debt_no, l_suppkey AS entity_key,
       {_slug_sql("'Entity ' || CAST(l_suppkey AS VARCHAR) || ' / ' || l_returnflag")} AS entity_slug,
       {_case_sql('CAST(l_partkey % 13 + 1 AS INTEGER)', DEBT_STATES)} AS debt_state,
       {_case_sql('l_linenumber', FREQUENCIES)} AS payment_frequency,
       CASE WHEN l_discount = 0 THEN 'S' ELSE l_returnflag END AS risk_grade,
       {_val("CAST(l_extendedprice AS DECIMAL(18,2))", "balance_val")}
FROM lineitem
""")
def regulator_debts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    raw_grade = F.when(F.col("l_discount") != 0, F.col("l_returnflag")).otherwise(F.lit(""))
    x = li.select(F.col("l_orderkey").alias("report_key"), F.col("l_linenumber").alias("debt_no"),
                  F.col("l_suppkey").alias("entity_key"),
                  T.slug(F.concat(F.lit("Entity "), F.col("l_suppkey").cast("string"), F.lit(" / "),
                                  F.col("l_returnflag"))).alias("entity_slug"),
                  L.map_lookup((F.col("l_partkey") % 13 + 1).cast("int"), DEBT_STATES).alias("debt_state"),
                  L.map_lookup("l_linenumber", FREQUENCIES).alias("payment_frequency"),
                  L.missing_marker_to(raw_grade, [""], "S").alias("risk_grade"),
                  F.col("l_extendedprice").cast("decimal(18,2)").alias("balance"))
    return to_val_columns(x)


# --- CL-58 (and CL-38): movement kind from a code list per product, in one pass over the
#     movements (the product picks the list)
# Node parameter: per product, movement code -> kind.
PRODUCT_MOVE_KINDS = {"A": {"F": "deposit", "O": "withdrawal"},
                      "N": {"F": "interest", "O": "withdrawal"},
                      "R": {"F": "deposit", "O": "penalty"}}
PRODUCT_NAMES = {"A": "fixed_term", "N": "scheduled_plan", "R": "fund"}


def movement_kind(product, code, kinds_by_product: dict) -> "F.Column":
    """Kind of a movement from the code list of its product; unknown -> null."""
    flat = {f"{p}/{c}": k for p, m in kinds_by_product.items() for c, k in m.items()}
    return L.map_lookup(F.concat_ws("/", product, code), flat)


@register("investment_movements", f"""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS trx_date,
       {_case_sql('l_returnflag', PRODUCT_NAMES)} AS product,
       {_case_sql("l_returnflag || '/' || l_linestatus", {f'{p}/{c}': k for p, m in PRODUCT_MOVE_KINDS.items() for c, k in m.items()})} AS kind,
       {_val("CAST(l_extendedprice AS DECIMAL(18,2))", "amount_val")}
FROM lineitem
""")
def investment_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    x = li.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("trx_date"),
                  L.map_lookup("l_returnflag", PRODUCT_NAMES).alias("product"),
                  movement_kind(F.col("l_returnflag"), F.col("l_linestatus"), PRODUCT_MOVE_KINDS).alias("kind"),
                  F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    return to_val_columns(x)
