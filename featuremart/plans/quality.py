"""Data-quality queries (DQ family): rule records by month, decision, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.operators.quality import (CRITICAL, QualityRules, QualityStop, blocked_periods,
                                           checked_records, month_ranges, quality_decision,
                                           quality_records, require_gate, with_run_time)
from featuremart.plans.inputs import t
from featuremart.plans.registry import register
from featuremart.session import staged
from featuremart.sources.readers import date_range_filter

# Source used by the checks: line items with a few values turned into nulls
# and one out-of-list marker, so every check has both outcomes.
DQ_SOURCE_SQL = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_shipdate,
       nullif(l_returnflag, 'R') AS l_returnflag,
       CASE WHEN l_quantity > 45 THEN 'X' ELSE l_linestatus END AS l_linestatus,
       nullif(l_discount, 0.0) AS l_discount, l_tax
FROM lineitem
"""


def dq_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate",
                     F.nullif(F.col("l_returnflag"), F.lit("R")).alias("l_returnflag"),
                     F.when(F.col("l_quantity") > 45, F.lit("X")).otherwise(F.col("l_linestatus"))
                      .alias("l_linestatus"),
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"), "l_tax")


DUP_RULES = QualityRules(unique_keys=["l_orderkey", "l_linenumber"])
NULL_RULES = QualityRules(null_limits={"l_returnflag": 30, "l_discount": 0, "l_tax": 0,
                                       "no_such_column": 5})
DIM_RULES = QualityRules(allowed_values={"l_linestatus": ["F", "O"], "l_returnflag": ["A", "N"]},
                         allow_null=True)
SQL_RULES = QualityRules(rules=[
    {"name": "positive_quantity", "condition": "l_quantity > 0", "severity": "HIGH"},
    {"name": "small_discount", "condition": "l_discount < 0.09"},
    {"name": "small_discount_strict", "condition": "l_discount < 0.09", "treat_null_as_fail": True,
     "severity": CRITICAL},
    {"name": "broken_rule", "condition": "no_such_column >"},
])
ALL_RULES = QualityRules(unique_keys=DUP_RULES.unique_keys, null_limits=NULL_RULES.null_limits,
                         allowed_values=DIM_RULES.allowed_values, allow_null=True,
                         rules=SQL_RULES.rules)

SOURCE_COLUMNS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate",
                  "l_returnflag", "l_linestatus", "l_discount", "l_tax"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def records_sql(source_sql: str, dataset: str, rules: QualityRules, month_col: str | None,
                columns: list[str] | None = None) -> str:
    """DuckDB SQL producing the same records as ``quality_records`` (oracle)."""
    m = f"last_day(CAST({month_col} AS DATE))" if month_col else "CAST(NULL AS DATE)"
    aggs = ["count(*) AS __total"]
    selects = []

    def rec(column, check, severity, failed, fail_desc, pass_desc):
        return (f"SELECT {_q(dataset)} AS dataset_name, {_q(column)} AS column_name, {_q(check)} AS \"check\", "
                f"CASE WHEN {failed} THEN {fail_desc} ELSE {pass_desc} END AS description, "
                f"CASE WHEN {failed} THEN {_q(severity)} ELSE 'LOW' END AS severity, "
                f"CASE WHEN {failed} THEN 'FAIL' ELSE 'PASS' END AS status, "
                f"CAST(CAST(date_trunc('month', __m) AS DATE) AS VARCHAR) AS _observ_start_dt, "
                f"CAST(__m AS VARCHAR) AS _observ_end_dt FROM s")

    for i, (c, limit) in enumerate(rules.null_limits.items()):
        if columns is not None and c not in columns:
            continue  # missing column: skipped, as in the operator
        aggs.append(f"count_if({c} IS NULL) AS __null_{i}")
        n = f"__null_{i}"
        failed = f"{n} > 0" if limit == 0 else f"{n} * 100 > {limit} * greatest(__total, 1)"
        selects.append(rec(c, "NULL_VALUES", rules.severity["NULL_VALUES"], failed,
                           f"printf({_q(f'column {chr(39)}{c}{chr(39)} has %d null values of %d rows, above the limit of {limit}%%')}, {n}, __total)",
                           f"printf({_q(f'column {chr(39)}{c}{chr(39)} has %d null values of %d rows, within the limit of {limit}%%')}, {n}, __total)"))
    for i, (c, allowed) in enumerate(rules.allowed_values.items()):
        lst = ", ".join(_q(v) for v in allowed)
        bad = (f"({c} IS NOT NULL AND {c} NOT IN ({lst}))" if rules.allow_null
               else f"({c} IS NULL OR {c} NOT IN ({lst}))")
        aggs.append(f"count_if({bad}) AS __dim_{i}")
        n = f"__dim_{i}"
        selects.append(rec(c, "DIMENSIONAL", rules.severity["DIMENSIONAL"], f"{n} > 0",
                           f"printf({_q(f'column {chr(39)}{c}{chr(39)} has %d values outside the allowed list')}, {n})",
                           _q(f"column '{c}' holds only allowed values")))
    for i, r in enumerate(rules.rules):
        cond, name = r["condition"], r["name"]
        if "no_such_column" in cond:
            continue  # does not analyse: skipped, as in the operator
        nullv = "true" if r.get("treat_null_as_fail") else "false"
        aggs.append(f"count_if(coalesce(NOT ({cond}), {nullv})) AS __rule_{i}")
        n = f"__rule_{i}"
        selects.append(rec(name, "CONSISTENCY", r.get("severity", "MEDIUM"), f"{n} > 0",
                           f"printf({_q(f'rule {chr(39)}{name}{chr(39)} failed for %d of %d rows ({cond})')}, {n}, __total)",
                           _q(f"rule '{name}' passed for all rows ({cond})")))
    dup_cte = ""
    if rules.unique_keys:
        keys = ", ".join(rules.unique_keys)
        nn = " AND ".join(f"{k} IS NOT NULL" for k in rules.unique_keys)
        label = ", ".join(rules.unique_keys)
        dup_cte = (f", d AS (SELECT __m, count(*) AS __dups FROM (SELECT __m, {keys} FROM base WHERE {nn} "
                   f"GROUP BY __m, {keys} HAVING count(*) > 1) GROUP BY __m)")
        selects.insert(0, rec(label, "DUPLICATES", rules.severity["DUPLICATES"], "__dups > 0",
                              f"printf({_q(f'%d key values occur more than once for key: {label}')}, __dups)",
                              _q(f"no duplicate key values for key: {label}")))
        s_cte = ", s AS (SELECT g.*, coalesce(d.__dups, 0) AS __dups FROM g LEFT JOIN d ON g.__m IS NOT DISTINCT FROM d.__m)"
    else:
        s_cte = ", s AS (SELECT * FROM g)"
    return (f"WITH base AS (SELECT *, {m} AS __m FROM ({source_sql})), "
            f"g AS (SELECT __m, {', '.join(aggs)} FROM base GROUP BY __m){dup_cte}{s_cte}\n"
            + "\nUNION ALL\n".join(selects))


# --- DQ-01 / DQ-07: key values occurring more than once (null key parts ignored) -> record
@register("dq_duplicates", records_sql(DQ_SOURCE_SQL, "lineitem", DUP_RULES, None, SOURCE_COLUMNS))
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_records(dq_source(spark, sf_dir), "lineitem", DUP_RULES)


# --- DQ-02 / DQ-07: null share per column against its limit, all columns in one pass
@register("dq_nulls", records_sql(DQ_SOURCE_SQL, "lineitem", NULL_RULES, None, SOURCE_COLUMNS))
def dq_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_records(dq_source(spark, sf_dir), "lineitem", NULL_RULES)


# --- DQ-03 / DQ-07: values outside the allowed list, nulls fail unless allowed
@register("dq_allowed_values", records_sql(DQ_SOURCE_SQL, "lineitem", DIM_RULES, None, SOURCE_COLUMNS))
def dq_allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_records(dq_source(spark, sf_dir), "lineitem", DIM_RULES)


# --- DQ-04 / DQ-07: SQL rules per row; unknown passes unless told otherwise; a rule that does not parse is skipped
@register("dq_rules", records_sql(DQ_SOURCE_SQL, "lineitem", SQL_RULES, None, SOURCE_COLUMNS))
def dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_records(dq_source(spark, sf_dir), "lineitem", SQL_RULES)


# --- DQ-05 / DQ-10: every check of a dataset as records, one grouped pass per month
DQ_BY_MONTH_SQL = records_sql(DQ_SOURCE_SQL, "lineitem", ALL_RULES, "l_shipdate", SOURCE_COLUMNS)


@register("dq_by_month", DQ_BY_MONTH_SQL, headline=True)
def dq_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_records(dq_source(spark, sf_dir), "lineitem", ALL_RULES, "l_shipdate")


# --- DQ-05: STOP on any critical failure, per month
@register("quality_decision", f"""
WITH r AS ({DQ_BY_MONTH_SQL})
SELECT dataset_name, _observ_start_dt, _observ_end_dt, CAST(count(*) AS BIGINT) AS checks,
       CAST(count_if(status = 'FAIL') AS BIGINT) AS failures,
       CAST(count_if(status = 'FAIL' AND severity = 'CRITICAL') AS BIGINT) AS critical_failures,
       CAST(count_if("check" = 'ERROR') AS BIGINT) AS validator_errors,
       CASE WHEN count_if(status = 'FAIL' AND severity = 'CRITICAL') > 0 THEN 'STOP' ELSE 'PASS' END AS decision
FROM r GROUP BY 1, 2, 3
""")
def quality_decision_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_decision(dq_by_month(spark, sf_dir))


# --- DQ-11 / DQ-15: months of a range blocked by a stored critical failure
GATE_RANGE = ("1996-01-01", "2000-12-31")
QUALITY_GATE_SQL = f"""
WITH r AS ({DQ_BY_MONTH_SQL})
SELECT dataset_name, _observ_end_dt,
       CAST(max(CASE WHEN status = 'FAIL' AND severity = 'CRITICAL' THEN 1 ELSE 0 END) AS INTEGER) AS blocked
FROM r WHERE CAST(_observ_end_dt AS DATE) BETWEEN DATE '{GATE_RANGE[0]}' AND DATE '{GATE_RANGE[1]}'
GROUP BY 1, 2
"""


@register("quality_gate", QUALITY_GATE_SQL)

def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocked_periods(dq_by_month(spark, sf_dir), *GATE_RANGE)


# --- DQ-09 / DQ-11: the gate's run range split into calendar months; a month without stored
#     records is not blocked
@register("gate_by_month", f"""
WITH g AS ({QUALITY_GATE_SQL}),
m AS (SELECT CAST(unnest(generate_series(DATE '{GATE_RANGE[0]}', DATE '{GATE_RANGE[1]}', INTERVAL 1 MONTH)) AS DATE) AS month_start)
SELECT m.month_start, last_day(m.month_start) AS month_end, CAST(coalesce(max(g.blocked), 0) AS INTEGER) AS blocked
FROM m LEFT JOIN g ON CAST(g._observ_end_dt AS DATE) = last_day(m.month_start)
GROUP BY 1, 2
""")
def gate_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = month_ranges(spark, *GATE_RANGE)
    g = quality_gate(spark, sf_dir)
    j = months.join(g, F.to_date(g["_observ_end_dt"]) == months["month_end"], "left")
    return j.groupBy("month_start", "month_end").agg(
        F.coalesce(F.max("blocked"), F.lit(0)).cast("int").alias("blocked"))


# --- DQ-05 / DQ-06 / DQ-08: a run over three expected months of which two have no rows, with a
#     rule that fails only when it runs: empty months are critical, the broken rule is an ERROR
#     record that stops the save, the other check keeps its records, all stamped with the run time
RUN_TIME = "2024-03-10 06:00:00"
RUN_MONTHS = ("2023-12-01", "2024-02-29")
EVENT_RULES = QualityRules(null_limits={"user_id": 0}, fail_on_empty=True, rules=[
    {"name": "numeric_type", "condition": "cast(event_type as int) > 0"},
    {"name": "known_user", "condition": "user_id >= 0", "severity": "HIGH"}])


@register("dq_run_policy", f"""
WITH m AS (SELECT last_day(CAST(unnest(generate_series(DATE '{RUN_MONTHS[0]}', DATE '{RUN_MONTHS[1]}', INTERVAL 1 MONTH)) AS DATE)) AS m),
e AS (SELECT last_day(CAST(ts AS DATE)) AS m, count(*) AS n, count_if(user_id IS NULL) AS nulls,
             count_if(NOT user_id >= 0) AS bad FROM events GROUP BY 1),
j AS (SELECT coalesce(m.m, e.m) AS m, e.n, e.nulls, e.bad FROM m FULL JOIN e ON e.m = m.m),
d AS (SELECT m, CASE WHEN n IS NULL THEN 1 ELSE 2 END AS checks,
             CASE WHEN n IS NULL THEN 1 ELSE CAST(nulls > 0 AS INTEGER) + CAST(bad > 0 AS INTEGER) END AS failures,
             CASE WHEN n IS NULL THEN 1 ELSE 0 END AS critical, 0 AS errors FROM j
      UNION ALL SELECT NULL, 1, 1, 0, 1)
SELECT 'events' AS dataset_name, CAST(CAST(date_trunc('month', m) AS DATE) AS VARCHAR) AS _observ_start_dt,
       CAST(m AS VARCHAR) AS _observ_end_dt, CAST(checks AS BIGINT) AS checks, CAST(failures AS BIGINT) AS failures,
       CAST(critical AS BIGINT) AS critical_failures, CAST(errors AS BIGINT) AS validator_errors,
       CASE WHEN critical + errors > 0 THEN 'STOP' ELSE 'PASS' END AS decision, '{RUN_TIME}' AS run_time
FROM d
""")
def dq_run_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    records = checked_records(e, "events", EVENT_RULES, "ts", month_ranges(spark, *RUN_MONTHS))
    return with_run_time(quality_decision(records, EVENT_RULES.block_on_error), RUN_TIME)


# --- DQ-15: nodes behind the gate: a node whose input has a critical failure in its months is
#     stopped before it reads anything, the others run
GATED_RANGES = [("1994-01-01", "1994-12-15"), ("1996-03-10", "1996-05-02"), ("2003-01-01", "2003-06-30")]


@register("gated_nodes", f"""
WITH g AS ({DQ_BY_MONTH_SQL}),
r AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in GATED_RANGES)}) AS v(run_start, run_end)),
b AS (SELECT run_start, run_end, coalesce(bool_or(g.status = 'FAIL' AND g.severity = 'CRITICAL'), false) AS blocked
      FROM r LEFT JOIN g ON CAST(g._observ_end_dt AS DATE) BETWEEN CAST(run_start AS DATE) AND last_day(CAST(run_end AS DATE))
      GROUP BY 1, 2)
SELECT run_start, run_end, CASE WHEN blocked THEN 'STOPPED' ELSE 'RAN' END AS outcome,
       CASE WHEN NOT blocked THEN (SELECT CAST(count(*) AS BIGINT) FROM lineitem
            WHERE CAST(l_shipdate AS DATE) BETWEEN CAST(run_start AS DATE) AND CAST(run_end AS DATE)) END AS node_rows
FROM b
""")
def gated_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = staged(spark, dq_by_month(spark, sf_dir), "gate_history")
    out = []
    for start, end in GATED_RANGES:
        try:
            require_gate(spark, None, "lineitem", start, end, history)
            rows = date_range_filter(t(spark, sf_dir, "lineitem"), "l_shipdate", start, end).count()
            out.append((start, end, "RAN", rows))
        except QualityStop:
            out.append((start, end, "STOPPED", None))
    return spark.createDataFrame(out, "run_start string, run_end string, outcome string, node_rows long")
