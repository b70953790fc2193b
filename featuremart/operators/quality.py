"""Data-quality operators (DQ-01..DQ-15).

All checks of a dataset are folded into **one** pass, by month when a date
column is given (DQ-10), so a whole date range is validated by one scan. Null,
allowed-value and SQL-rule checks are counts of failing rows (``check_counts``).
With a unique key these counts are taken per month and key first (partial counts
before the shuffle), then summed per month, where key values with more than one
row are counted too: the duplicate check needs no scan of its own. The counts can
also be observed while the rows are written (``observed_records``). Records are
built with Column expressions (array of structs + explode): nothing is collected to
build them. Only the final STOP/PASS decision is read on the driver. A check that
cannot run, when planned or when executed, becomes an ERROR record and by
default stops the save.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Severities, statuses and categories of validation records.
LOW, MEDIUM, HIGH, CRITICAL = "LOW", "MEDIUM", "HIGH", "CRITICAL"
PASS, FAIL = "PASS", "FAIL"
STOP = "STOP"
WARN = "WARN"
DUPLICATES, NULL_VALUES, DIMENSIONAL, CONSISTENCY = (
    "DUPLICATES", "NULL_VALUES", "DIMENSIONAL", "CONSISTENCY")
EMPTY_DATASET, ERROR, WHOLE_DATASET = "EMPTY_DATASET", "ERROR", "__dataset__"
DEFAULT_SEVERITY = {DUPLICATES: HIGH, NULL_VALUES: MEDIUM, DIMENSIONAL: MEDIUM,
                    CONSISTENCY: MEDIUM}

RECORD_COLUMNS = ["dataset_name", "column_name", "check", "description", "severity", "status",
                  "_observ_start_dt", "_observ_end_dt"]


class QualityStop(RuntimeError):
    """Raised when a dataset must not be written (critical failure)."""


@dataclass
class QualityRules:
    """Rule set of one dataset (the content of a rule file)."""
    unique_keys: list[str] = field(default_factory=list)
    null_limits: dict[str, float] = field(default_factory=dict)  # column -> max % (0 = none)
    allowed_values: dict[str, list] = field(default_factory=dict)
    allow_null: bool = False
    rules: list[dict] = field(default_factory=list)  # name, condition, severity, treat_null_as_fail
    severity: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_SEVERITY))
    fail_on_empty: bool = False       # an empty month (or dataset) is critical, else a warning
    block_on_error: bool = True       # a check that cannot run stops the save

    def one_by_one(self) -> list[tuple[str, "QualityRules"]]:
        """(name, rule set) of every check alone, to find one that cannot run."""
        def only(**kept) -> QualityRules:
            empty = {"unique_keys": [], "null_limits": {}, "allowed_values": {}, "rules": []}
            return replace(self, **(empty | kept))

        parts = [(", ".join(self.unique_keys), only(unique_keys=self.unique_keys))] if self.unique_keys else []
        parts += [(c, only(null_limits={c: v})) for c, v in self.null_limits.items()]
        parts += [(c, only(allowed_values={c: v})) for c, v in self.allowed_values.items()]
        return parts + [(r.get("name", "rule"), only(rules=[r])) for r in self.rules]


def _find(df: DataFrame, name: str) -> str | None:
    low = name.lower()
    return next((c for c in df.columns if c.lower() == low), None)


def _valid_rule(df: DataFrame, condition: str) -> bool:
    try:
        df.select(F.expr(condition)).schema  # analysis only, no job
        return True
    except (AnalysisException, Exception):  # parse errors are not AnalysisException
        return False


def _check(column: str, check: str, severity: str, failed: Column, fail_desc: Column,
           pass_desc: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column_name"), F.lit(check).alias("check"),
        F.when(failed, fail_desc).otherwise(pass_desc).alias("description"),
        F.when(failed, F.lit(severity)).otherwise(F.lit(LOW)).alias("severity"),
        F.when(failed, F.lit(FAIL)).otherwise(F.lit(PASS)).alias("status"))


def unique_key(df: DataFrame, rules: QualityRules) -> list[str]:
    """The key columns of DQ-01; empty when one is missing (the check is skipped)."""
    keys = [_find(df, k) for k in rules.unique_keys]
    return [] if None in keys else keys


def check_counts(df: DataFrame, rules: QualityRules) -> tuple[dict[str, Column], list[Column]]:
    """Conditions of failing rows by the name of their count, and the checks
    as structs over these counts, ``__total`` and ``__dups`` (DQ-01..DQ-04)."""
    counts: dict[str, Column] = {}
    checks: list[Column] = []
    total = F.col("__total")
    keys = unique_key(df, rules)
    if keys:
        label, n = ", ".join(keys), F.col("__dups")
        checks.append(_check(
            label, DUPLICATES, rules.severity.get(DUPLICATES, HIGH), n > 0,
            F.format_string(f"%d key values occur more than once for key: {label}", n),
            F.lit(f"no duplicate key values for key: {label}")))

    # DQ-02 nulls
    for i, (name, limit) in enumerate(rules.null_limits.items()):
        c = _find(df, name)
        if c is None:
            continue
        counts[f"__null_{i}"], n = F.col(c).isNull(), F.col(f"__null_{i}")
        failed = (n > 0) if limit == 0 else (n * 100 > F.lit(limit) * F.greatest(total, F.lit(1)))
        checks.append(_check(
            c, NULL_VALUES, rules.severity.get(NULL_VALUES, MEDIUM), failed,
            F.format_string(f"column '{c}' has %d null values of %d rows, above the limit of {limit}%%",
                            n, total),
            F.format_string(f"column '{c}' has %d null values of %d rows, within the limit of {limit}%%",
                            n, total)))

    # DQ-03 allowed values
    for i, (name, allowed) in enumerate(rules.allowed_values.items()):
        c = _find(df, name)
        if c is None or not allowed:
            continue
        out = ~F.col(c).isin(*list(allowed))
        counts[f"__dim_{i}"] = (F.col(c).isNotNull() & out) if rules.allow_null else (F.col(c).isNull() | out)
        n = F.col(f"__dim_{i}")
        checks.append(_check(
            c, DIMENSIONAL, rules.severity.get(DIMENSIONAL, MEDIUM), n > 0,
            F.format_string(f"column '{c}' has %d values outside the allowed list", n),
            F.lit(f"column '{c}' holds only allowed values")))

    # DQ-04 SQL rules; null (unknown) passes unless treat_null_as_fail (S-18)
    for i, rule in enumerate(rules.rules):
        cond = rule.get("condition")
        name = rule.get("name", f"rule_{i}")
        if not cond or not _valid_rule(df, cond):
            continue
        counts[f"__rule_{i}"] = F.coalesce(~F.expr(cond), F.lit(bool(rule.get("treat_null_as_fail", False))))
        n = F.col(f"__rule_{i}")
        checks.append(_check(
            name, CONSISTENCY, rule.get("severity", MEDIUM), n > 0,
            F.format_string(f"rule '{name}' failed for %d of %d rows ({cond})", n, total),
            F.lit(f"rule '{name}' passed for all rows ({cond})")))
    return counts, checks


# Months up to which the checks of a layer are observed while it is written.
OBSERVED_MONTHS = 24


def observed_records(df: DataFrame, dataset: str, rules: QualityRules, month_col: str,
                     months: Sequence, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """DQ-12 with DQ-02..DQ-04: (written frame, records), the counts taken by
    ``DataFrame.observe`` while ``write`` writes the rows.

    ``months`` are the month ends that the frame may hold; each count is kept
    per month, so their number is bounded by the caller (OBSERVED_MONTHS). Only
    the duplicate check, which needs the rows of a key together, reads the written
    frame: its key columns. Rows outside the months would go unchecked, so they
    are counted too and raise an error."""
    counts, checks = check_counts(df, rules)
    month = F.last_day(F.to_date(F.col(month_col)))
    seen = Observation()
    metrics = [F.count_if(~F.coalesce(month.isin(list(months)), F.lit(False))).alias("__other")]
    for i, m in enumerate(months):
        here = month == F.lit(m)
        metrics.append(F.count_if(here).alias(f"__total_{i}"))
        metrics += [F.count_if(here & bad).alias(f"{n}_{i}") for n, bad in counts.items()]
    written = write(df.observe(seen, *metrics))
    got = seen.get
    if got["__other"]:
        raise ValueError(f"dataset {dataset} holds {got['__other']} rows outside the months checked")
    names = ["__total", *counts]
    rows = [(m, *[int(got[f"{n}_{i}"]) for n in names]) for i, m in enumerate(months) if got[f"__total_{i}"]]
    summary = df.sparkSession.createDataFrame(rows, ", ".join(["__m date", *[f"{n} long" for n in names]]))
    keys = unique_key(df, rules)
    if keys:
        not_null = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.lit(True))
        dups = written.where(not_null).groupBy(month.alias("__m"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]) \
            .count().groupBy("__m").agg(F.count_if(F.col("count") > 1).alias("__dups"))
        summary = summary.join(dups, "__m", "left").withColumn("__dups", F.coalesce("__dups", F.lit(0)))
    return written, _records(summary, dataset, rules, checks, False, None)


def quality_records(df: DataFrame, dataset: str, rules: QualityRules,
                    month_col: str | None = None, months: DataFrame | None = None) -> DataFrame:
    """DQ-01..DQ-04 + DQ-07 + DQ-10: validation records of a dataset, one set
    per calendar month of ``month_col`` (or one set for the whole frame).

    ``months`` (column month_end, as ``month_ranges`` gives) are the months the
    run expects. An expected month without rows, or a whole frame without
    rows, gives one EMPTY_DATASET record: critical with ``fail_on_empty``, a
    warning otherwise.

    A rule whose SQL does not analyse is skipped (DQ-04); a missing key
    column skips the duplicate check (DQ-01); missing columns are skipped.
    """
    month = F.last_day(F.to_date(F.col(month_col))) if month_col else F.lit(None).cast("date")
    base = df.withColumn("__m", month)
    counts, checks = check_counts(df, rules)
    keys = unique_key(df, rules)
    if keys:
        # DQ-01 in the same pass: counts per month and key, then per month
        named = {f"__k{i}": F.col(k) for i, k in enumerate(keys)}
        per_key = base.groupBy("__m", *[c.alias(n) for n, c in named.items()]).agg(
            *[F.count_if(bad).alias(n) for n, bad in counts.items()], F.count(F.lit(1)).alias("__total"))
        repeated = F.col("__total") > 1
        for n in named:
            repeated = repeated & F.col(n).isNotNull()
        summary = per_key.groupBy("__m").agg(F.sum("__total").alias("__total"), F.count_if(repeated).alias("__dups"),
                                             *[F.sum(n).alias(n) for n in counts])
    else:
        summary = base.groupBy("__m").agg(F.count(F.lit(1)).alias("__total"),
                                          *[F.count_if(bad).alias(n) for n, bad in counts.items()])
    return _records(summary, dataset, rules, checks, month_col is None, months)


def _records(summary: DataFrame, dataset: str, rules: QualityRules, checks: list[Column], whole: bool,
             months: DataFrame | None) -> DataFrame:
    """Records of the counts per month (``__m``, null for a whole frame)."""
    total = F.col("__total")
    if not checks:
        return summary.sparkSession.createDataFrame([], record_schema())
    found = F.array(*checks)
    if whole or months is not None:
        expected = (months.select(F.col("month_end").alias("__e")) if months is not None and not whole else
                    summary.sparkSession.range(1).select(F.lit(None).cast("date").alias("__e")))
        summary = expected.join(summary, expected["__e"].eqNullSafe(summary["__m"]), "full") \
            .withColumn("__m", F.coalesce("__m", "__e"))
        empty = F.struct(
            F.lit(WHOLE_DATASET).alias("column_name"), F.lit(EMPTY_DATASET).alias("check"),
            F.lit(f"dataset {dataset} has no rows in the period").alias("description"),
            F.lit(CRITICAL if rules.fail_on_empty else LOW).alias("severity"),
            F.lit(FAIL if rules.fail_on_empty else WARN).alias("status"))
        found = F.when(F.coalesce(total, F.lit(0)) == 0, F.array(empty)).otherwise(found)
    return (summary.select("__m", F.explode(found).alias("r"))
            .select(F.lit(dataset).alias("dataset_name"), "r.column_name", "r.check",
                    "r.description", "r.severity", "r.status",
                    F.trunc("__m", "month").cast("string").alias("_observ_start_dt"),
                    F.col("__m").cast("string").alias("_observ_end_dt")))


def record_schema() -> str:
    return ("dataset_name string, column_name string, check string, description string, "
            "severity string, status string, _observ_start_dt string, _observ_end_dt string")


def with_run_time(records: DataFrame, run_time: str | None = None) -> DataFrame:
    """DQ-08: stamp records with the run time."""
    ts = run_time or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return records.withColumn("run_time", F.lit(ts))


def quality_decision(records: DataFrame, block_on_error: bool = True) -> DataFrame:
    """DQ-05: per dataset and month: failures, critical failures, checks that
    could not run, and the decision (STOP on any critical failure, or on a
    check that could not run when ``block_on_error``)."""
    critical = (F.col("status") == FAIL) & (F.col("severity") == CRITICAL)
    stop = F.col("critical_failures") > 0
    if block_on_error:
        stop = stop | (F.col("validator_errors") > 0)
    return (records.groupBy("dataset_name", "_observ_start_dt", "_observ_end_dt")
            .agg(F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") == FAIL).alias("failures"),
                 F.count_if(critical).alias("critical_failures"),
                 F.count_if(F.col("check") == ERROR).alias("validator_errors"))
            .withColumn("decision", F.when(stop, F.lit(STOP)).otherwise(F.lit(PASS))))


def safe_records(spark: SparkSession, fn, dataset: str, *args, name: str = "validator", **kwargs) -> DataFrame:
    """DQ-06: records of a check, written once inside the guard, so that a
    failure while the plan is built and one while it runs both become a HIGH
    ``ERROR`` record with the whole error text."""
    from featuremart.session import staged

    try:
        return staged(spark, fn(*args, **kwargs), "quality_records")
    except Exception as e:  # noqa: BLE001 - any validator failure is a record
        return spark.createDataFrame(
            [(dataset, name, ERROR, f"{type(e).__name__}: {e}", HIGH, FAIL, None, None)], record_schema())


def checked_records(df: DataFrame, dataset: str, rules: QualityRules, month_col: str | None = None,
                    months: DataFrame | None = None) -> DataFrame:
    """DQ-05 / DQ-06: all records of a dataset. Every check runs in one pass;
    only if that pass fails do the checks run one by one, so that the one that
    cannot run becomes an ERROR record and the others keep theirs."""
    spark = df.sparkSession
    every = safe_records(spark, quality_records, dataset, df, dataset, rules, month_col, months)
    if every.where(F.col("check") == ERROR).isEmpty():
        return every
    parts = [safe_records(spark, quality_records, dataset, df, dataset, part, month_col, months, name=name)
             for name, part in rules.one_by_one()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    empty = F.col("check") == EMPTY_DATASET  # every part reports an empty month; one record is enough
    return out.where(~empty).unionByName(out.where(empty).distinct())


def blocked_periods(history: DataFrame, start=None, end=None) -> DataFrame:
    """DQ-11 as data: per dataset and month, whether the history holds a
    critical failure."""
    h = history
    end_dt = F.to_date("_observ_end_dt")
    if start is not None:
        h = h.where(end_dt >= F.to_date(F.lit(start)))
    if end is not None:
        h = h.where(end_dt <= F.to_date(F.lit(end)))
    return (h.groupBy("dataset_name", "_observ_end_dt")
            .agg(F.max(((F.col("status") == FAIL) & (F.col("severity") == CRITICAL)).cast("int"))
                 .alias("blocked")))


def check_quality_gate(spark: SparkSession, history_path: str | None, dataset: str,
                       start, end, history: DataFrame | None = None) -> bool:
    """DQ-11: True (pass) unless the history holds a critical failure for the
    dataset in the months of the range (records carry month ends, so the range
    runs to the end of its last month). A missing history passes; other errors
    block (S-20)."""
    try:
        h = history if history is not None else spark.read.parquet(history_path)
        bad = (h.where((F.col("dataset_name") == dataset)
                       & F.to_date("_observ_end_dt").between(F.to_date(F.lit(start)),
                                                             F.last_day(F.to_date(F.lit(end))))
                       & (F.col("status") == FAIL) & (F.col("severity") == CRITICAL)))
        return bad.isEmpty()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "TABLE_OR_VIEW_NOT_FOUND" in str(e):
            return True
        return False
    except Exception:  # noqa: BLE001
        return False


def require_gate(spark: SparkSession, history_path: str | None, dataset: str, start, end,
                 history: DataFrame | None = None) -> None:
    """DQ-15: stop a node whose input is blocked."""
    if not check_quality_gate(spark, history_path, dataset, start, end, history):
        raise QualityStop(f"input {dataset} is blocked by the quality gate for {start}..{end}")


def write_checked(df: DataFrame, dataset: str, rules: QualityRules, month_col: str, months: Sequence | None,
                  store: Callable | None = None, run_time: str | None = None) -> DataFrame:
    """DQ-12 / DQ-13 for a layer that is written anyway: the rows are staged
    once, checked while they are written, the records stored, and the staged
    frame returned unless the decision is STOP.

    ``months``: the month ends of the run. Without them, or with more than
    OBSERVED_MONTHS, or when a check fails to run inside the write, the staged
    rows are checked by ``validate_before_save`` instead."""
    from featuremart.session import staged

    spark = df.sparkSession
    if months is not None and len(months) <= OBSERVED_MONTHS:
        try:
            written, records = observed_records(df, dataset, rules, month_col, months,
                                                lambda x: staged(spark, x, dataset))
            records = staged(spark, records, "quality_records")
        except Exception:  # noqa: BLE001 - a check that cannot run gets its ERROR record below
            pass
        else:
            _store_and_decide(with_run_time(records, run_time), dataset, rules, store)
            return written
    written = staged(spark, df, dataset)
    validate_before_save(written, dataset, rules, month_col, store, run_time=run_time)
    return written


def _store_and_decide(records: DataFrame, dataset: str, rules: QualityRules, store: Callable | None) -> DataFrame:
    if store is not None:
        store(records)
    stopped = quality_decision(records, rules.block_on_error).where(F.col("decision") == STOP)
    if not stopped.isEmpty():
        raise QualityStop(f"dataset {dataset} failed a critical quality check")
    return records


def validate_before_save(df: DataFrame, dataset: str, rules: QualityRules, month_col: str,
                         store: callable | None = None, months: DataFrame | None = None,
                         run_time: str | None = None) -> DataFrame:
    """DQ-12 / DQ-13: validate by month, stamp the run time (DQ-08), hand the
    records to ``store`` (e.g. a replace-by-(dataset, month) write), abort on
    STOP. ``df`` is read once per pass, so a caller that also saves it passes a
    written frame. The decision table (one row per month) is all that is read
    back."""
    return _store_and_decide(with_run_time(checked_records(df, dataset, rules, month_col, months), run_time),
                             dataset, rules, store)


def validate_layer(spark: SparkSession, frames: dict[str, DataFrame],
                   rules: dict[str, QualityRules], month_cols: dict[str, str | None]
                   ) -> DataFrame:
    """DQ-14: records of every dataset of a layer, unioned."""
    parts = [checked_records(df, name, rules[name], month_cols.get(name))
             for name, df in frames.items() if name in rules]
    if not parts:
        return spark.createDataFrame([], record_schema())
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def month_ranges(spark: SparkSession, start, end) -> DataFrame:
    """DQ-09: calendar months of a range as (month_start, month_end)."""
    return spark.range(1).select(F.explode(F.sequence(
        F.trunc(F.to_date(F.lit(start)), "month"), F.to_date(F.lit(end)),
        F.expr("INTERVAL 1 MONTH"))).alias("month_start")).select(
        "month_start", F.last_day("month_start").alias("month_end"))
