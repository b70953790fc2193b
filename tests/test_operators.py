"""Unit tests per operator on tiny literal frames: nulls, ties, empty input,
missing categories, zero divisors, idempotence."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from featuremart.functions import dates as D
from featuremart.functions import lookup as L
from featuremart.functions import text as T
from featuremart.functions.currency import split_home_amount, to_home_currency
from featuremart.operators import aggregates as A
from featuremart.operators import columns as C
from featuremart.operators import joins as J
from featuremart.operators import profiling as P
from featuremart.operators import quality as Q
from featuremart.operators import setops as S
from featuremart.operators import windows as W
from featuremart.operators.columns import with_period
from featuremart.operators.broadcast import is_small, join_small
from featuremart.sources import writers as WR
from featuremart.sources.readers import date_range_filter
from tests.conftest import SF_SMALL


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_map_lookup_default_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    out = df.select(L.map_lookup("k", {"a": "x"}, default="unknown").alias("v"))
    assert sorted(r.v for r in out.collect()) == ["unknown", "unknown", "x"]


def test_map_lookup_normalized(spark):
    df = spark.createDataFrame([(" a ",)], "k string")
    assert df.select(L.map_lookup("k", {"A": 1}, normalize=True).alias("v")).first().v == 1


def test_rule_chain_first_match_wins_and_default_null(spark):
    df = spark.createDataFrame([("big red",), ("red",), ("blue",)], "s string")
    rules = [("contains", "big", "big"), ([("like", "%red%"), ("startswith", "r")], "red")]
    out = dict(rows(df.select("s", L.rule_chain("s", rules).alias("g")), "s", "g"))
    assert out == {"big red": "big", "red": "red", "blue": None}


def test_slug_and_pad(spark):
    df = spark.createDataFrame([("  Héllo,  wörld!! 42 ", 7)], "t string, n int")
    r = df.select(T.slug("t").alias("s"), T.left_pad_keep_right("n", 4).alias("p"),
                  T.left_pad_keep_right(F.lit("123456"), 4).alias("q")).first()
    assert r.s == "Héllo_wörld_42" and r.p == "0007" and r.q == "3456"


def test_label_missing_keeps_keys(spark):
    df = spark.createDataFrame([(None, None, 1), ("  a   b ", "", 2)], "k string, s string, n int")
    out = C.label_missing_text(df, exclude=["k"]).orderBy("n").collect()
    assert out[0].k is None and out[0].s == "unknown"
    assert out[1].k == "  a   b " and out[1].s == "unknown"


def test_truthy_flag(spark):
    df = spark.createDataFrame([(" si ",), ("no",), (None,)], "f string")
    assert [r.v for r in df.select(T.truthy_flag("f").alias("v")).collect()] == [1, 0, 0]


def test_whole_months_month_end_rule(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 29), dt.date(2020, 1, 31)),
                                (dt.date(2020, 3, 30), dt.date(2020, 1, 31)),
                                (dt.date(2019, 1, 1), dt.date(2020, 1, 1)),
                                (None, dt.date(2020, 1, 1))], "a date, b date")
    out = [r.m for r in df.select(D.whole_months_between("a", "b").alias("m")).collect()]
    assert out == [1, 1, 0, 0]


def test_whole_years_null_option(spark):
    df = spark.createDataFrame([(None, dt.date(2020, 1, 1))], "s date, e date")
    r = df.select(D.whole_years_between("s", "e").alias("a"),
                  D.whole_years_between("s", "e", null_as_zero=True).alias("b")).first()
    assert r.a is None and r.b == 0


def test_parse_day_first_then_month_first(spark):
    df = spark.createDataFrame([("31012000",), ("01312000",), ("31312000",), ("0101",)], "t string")
    out = [r.d for r in df.select(D.parse_day_first_date("t", max_year=2030).alias("d")).collect()]
    assert out == [dt.date(2000, 1, 31), dt.date(2000, 1, 31), None, None]


def test_payment_date_clamps_to_month_end(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 31), "X"), (dt.date(2021, 1, 15), "E")],
                               "d date, c string")
    out = [r.p for r in df.select(D.next_payment_date("d", "c", early_types=["E"]).alias("p")).collect()]
    assert out == [dt.date(2021, 2, 28), dt.date(2021, 2, 10)]


def test_currency_missing_rate_is_null(spark):
    df = spark.createDataFrame([(1, Decimal("10.00"), None), (2, Decimal("10.00"), None),
                                (2, Decimal("10.00"), Decimal("7.5"))],
                               "c int, a decimal(18,2), r decimal(10,4)")
    out = [r.h for r in df.select(to_home_currency("c", "a", "r").alias("h")).collect()]
    assert out[0] == Decimal("10.00") and out[1] is None and out[2] == Decimal("75.000000")
    split = df.select(*split_home_amount("c", "a", F.lit(Decimal("0"))
                                         .cast("decimal(10,4)"), {"home": 1, "foreign": 2}))
    assert split.collect()[1].amount_foreign is None  # divide by zero -> null


def test_pivot_missing_value_gives_zero(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 7), (2, "b", 1)], "k int, c string, v int")
    out = A.pivot_measures(df, ["k"], "c", ["a", "b", "zz"],
                           {"cnt": ("count", None), "sum": ("sum", "v")}).orderBy("k").collect()
    assert out[0].a_cnt == 2 and out[0].a_sum == 12 and out[0].zz_cnt == 0 and out[0].zz_sum == 0
    # invariant: pivot totals equal the ungrouped totals
    tot = A.pivot_measures(df, [], "c", ["a", "b"], {"sum": ("sum", "v")}).first()
    assert tot.a_sum + tot.b_sum == df.agg(F.sum("v")).first()[0]


def test_count_if_counts_only_matches(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert df.agg(A.count_if(F.col("v") > 1).alias("n")).first().n == 1


def test_sum_across_equals_full_join_form(spark):
    a = spark.createDataFrame([(1, 10), (2, None)], "k int, v int")
    b = spark.createDataFrame([(2, 5), (3, -7)], "k int, w int")
    out = dict(rows(J.sum_across([a, b], ["k"], "s"), "k", "s"))
    full = a.join(b, "k", "full").select(
        "k", F.when(F.col("v").isNull() & F.col("w").isNull(), None)
        .otherwise(F.coalesce("v", F.lit(0)) + F.coalesce("w", F.lit(0))).alias("s"))
    assert out == dict(rows(full, "k", "s"))
    clamped = dict(rows(J.sum_across([a, b], ["k"], "s", replace_negative=True), "k", "s"))
    assert clamped[3] == 0


def test_join_all_rules(spark):
    a = spark.createDataFrame([(1,)], "k int")
    assert J.join_all([a], ["k"]).count() == 1
    with pytest.raises(ValueError):
        J.join_all([], ["k"])


def test_join_small_checks_size(spark):
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    assert is_small(small, 5) and not is_small(spark.range(10), 5)
    big = spark.range(100).withColumnRenamed("id", "k")
    plan = join_small(big, small, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_top_n_tiebreak_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 3, "c")], "g int, v int, id string")
    out = W.top_n_per_group(df, ["g"], [("v", "desc"), ("id", "asc")]).first()
    assert out.id == "a"


def test_keep_ratio(spark):
    df = spark.createDataFrame([(1, i, 2) for i in range(5)], "g int, o int, d int")
    assert sorted(r.o for r in W.keep_ratio(df, ["g"], ["o"], "d").collect()) == [0, 1, 2]


def test_volume_states(spark):
    data = [("t", dt.date(2020, 1, 1) + dt.timedelta(days=31 * i), 100 + (i % 2)) for i in range(14)]
    data.append(("t", dt.date(2021, 4, 1), 500))
    df = spark.createDataFrame(data, "t string, d date, records long")
    out = W.volume_controls(df, "t", "d", ["records"]).orderBy("d").collect()
    assert out[0].records_state == "NO_HISTORY" and out[0].records_z is None
    assert out[-1].records_state == "ALERT_HIGH"
    flat = spark.createDataFrame([("t", dt.date(2020, 1, 1) + dt.timedelta(days=31 * i), 7)
                                  for i in range(14)], "t string, d date, records long")
    last = W.volume_controls(flat, "t", "d", ["records"]).orderBy(F.desc("d")).first()
    assert last.records_state == "OK" and last.records_z is None


def test_quality_records_and_decision(spark):
    df = spark.createDataFrame(
        [(1, "A", 5.0, dt.date(2020, 1, 3)), (1, "A", None, dt.date(2020, 1, 4)),
         (2, "Z", 1.0, dt.date(2020, 2, 1)), (None, None, 1.0, dt.date(2020, 2, 2))],
        "k int, c string, v double, d date")
    rules = Q.QualityRules(unique_keys=["k"], null_limits={"v": 0, "c": 50},
                           allowed_values={"c": ["A"]},
                           rules=[{"name": "pos", "condition": "v > 0", "severity": "CRITICAL"},
                                  {"name": "nul", "condition": "v > 0", "treat_null_as_fail": True},
                                  {"name": "bad", "condition": "nope >"}])
    rec = Q.quality_records(df, "ds", rules, "d")
    got = {(r._observ_end_dt, r.check, r.column_name): r.status for r in rec.collect()}
    assert got[("2020-01-31", "DUPLICATES", "k")] == "FAIL"
    assert got[("2020-02-29", "DUPLICATES", "k")] == "PASS"  # null key ignored
    assert got[("2020-01-31", "NULL_VALUES", "v")] == "FAIL"
    assert got[("2020-02-29", "DIMENSIONAL", "c")] == "FAIL"  # null and 'Z' not allowed
    assert got[("2020-01-31", "CONSISTENCY", "pos")] == "PASS"  # null passes
    assert got[("2020-01-31", "CONSISTENCY", "nul")] == "FAIL"  # unless told otherwise
    assert not any(k[2] == "bad" for k in got)  # rule that does not analyse is skipped
    dec = {r._observ_end_dt: r.decision for r in Q.quality_decision(rec).collect()}
    assert dec == {"2020-01-31": "PASS", "2020-02-29": "PASS"}
    whole = Q.quality_records(df, "ds", Q.QualityRules(unique_keys=["k"]))
    assert whole.first().status == "FAIL"  # duplicates counted without a month column


def test_quality_gate(spark):
    hist = spark.createDataFrame([("ds", "c", "x", "d", "CRITICAL", "FAIL", "2020-01-01", "2020-01-31")],
                                 Q.record_schema())
    assert not Q.check_quality_gate(spark, None, "ds", "2020-01-01", "2020-03-31", hist)
    assert Q.check_quality_gate(spark, None, "ds", "2020-02-01", "2020-03-31", hist)
    assert Q.check_quality_gate(spark, "/nonexistent/featuremart/history", "ds", "2020-01-01", "2020-12-31")
    with pytest.raises(Q.QualityStop):
        Q.require_gate(spark, None, "ds", "2020-01-01", "2020-03-31", hist)


def test_safe_records(spark):
    def boom():
        raise RuntimeError("x")
    r = Q.safe_records(spark, boom, "ds").first()
    assert r.severity == "HIGH" and r.status == "FAIL"


def test_missing_months_tolerance(spark):
    comp = spark.createDataFrame(
        [("tx_a", "transactional", "d", dt.date(2020, 1, 2), 0), ("tx_a", "transactional", "d", dt.date(2020, 1, 3), 0),
         ("tx_b", "transactional", "d", dt.date(2020, 1, 2), 0), ("snap", "snapshot", "d", dt.date(2020, 1, 31), 0)],
        "table_name string, table_kind string, date_column string, info_date date, cnt long")
    out = {r.table_name for r in P.missing_months(comp, {"tx_a": 2, "tx_b": 0}).collect()}
    assert out == {"tx_b", "snap"}


def test_expected_dates_grid(spark):
    t = spark.createDataFrame([("a", "transactional", dt.date(2020, 1, 30), dt.date(2020, 2, 2)),
                               ("b", "snapshot", dt.date(2020, 1, 1), dt.date(2020, 3, 31))],
                              "table_name string, table_kind string, start_date date, end_date date")
    g = P.expected_dates(t)
    assert g.where("table_name = 'a'").count() == 4 and g.where("table_name = 'b'").count() == 3


def test_union_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("s",)], "y string")
    out = S.union_missing_as_null([a, b])
    assert out.count() == 2 and set(out.columns) == {"x", "y"}
    assert S.consolidate(spark, [None], "x int").count() == 0


def test_to_val_and_prefix(spark):
    df = spark.createDataFrame([(1, 1.005, 2)], "customer_key int, amt double, n int")
    out = C.to_val_columns(C.add_prefix(df, "p", ["customer_key"]))
    assert out.columns == ["customer_key", "p_amt_val", "p_n"]
    assert str(out.schema["p_amt_val"].dataType) == "DecimalType(19,2)"


def test_drop_zero_measures(spark):
    df = spark.createDataFrame([(1, 0, 3, None)], "k int, a int, b int, c int")
    assert C.drop_zero_measures(df, ["a", "b", "c"]).columns == ["k", "b"]


def test_fill_numeric_zero_includes_decimals(spark):
    df = spark.createDataFrame([(None, None, None)], "a decimal(19,2), b int, s string")
    r = C.fill_numeric_zero(df).first()
    assert r.a == Decimal("0.00") and r.b == 0 and r.s is None


def test_date_range_filter_is_pushed_down(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(dt.date(2020, 1, d), d) for d in range(1, 28)], "d date, v int") \
        .write.parquet(p)
    out = date_range_filter(spark.read.parquet(p), "d", "2020-01-05", "2020-01-09", out_col="day")
    assert out.count() == 5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(d" in plan


def test_merge_by_keys_is_idempotent(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "ds string, m int, v string")
    new = spark.createDataFrame([("a", 2, "Y")], "ds string, m int, v string")
    once = WR.merge_by_keys(spark, old, new, ["ds", "m"], str(tmp_path / "v1"))
    twice = WR.merge_by_keys(spark, once, new, ["ds", "m"], str(tmp_path / "v2"))
    key = lambda df: sorted(rows(df, "ds", "m", "v"))
    assert key(once) == key(twice) == [("a", 1, "x"), ("a", 2, "Y"), ("b", 1, "z")]


def test_save_partitioned_replace_range(spark, tmp_path):
    p = str(tmp_path / "t")
    WR.save_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "m int, v string"), p, "m",
                        "replace_schema")
    WR.save_partitioned(spark.createDataFrame([(2, "B")], "m int, v string"), p, "m", "replace_range")
    assert sorted(rows(spark.read.parquet(p), "m", "v")) == [(1, "a"), (2, "B")]


def test_upsert_with_window_delete(spark):
    tgt = spark.createDataFrame([(1, dt.date(2020, 1, 5), True), (2, dt.date(2020, 2, 5), True),
                                 (3, dt.date(2019, 12, 5), True)], "k int, d date, f boolean")
    src = spark.createDataFrame([(1, dt.date(2020, 1, 5)), (4, dt.date(2020, 2, 1))], "k int, d date")
    out = sorted(rows(WR.upsert_with_window_delete(tgt, src, ["k"], "d", "2020-01-01", "2020-02-28", "f"),
                      "k", "f"))
    assert out == [(1, True), (3, True), (4, False)]


def test_upsert_inserts_source_values_and_keeps_matched(spark):
    tgt = spark.createDataFrame([(1, dt.date(2020, 1, 5), "old", True)], "k int, d date, v string, f boolean")
    src = spark.createDataFrame([(1, dt.date(2020, 1, 5), "new"), (2, dt.date(2020, 1, 6), "ins")],
                                "k int, d date, v string")
    out = sorted(rows(WR.upsert_with_window_delete(tgt, src, ["k"], "d", "2020-01-01", "2020-01-31", "f"),
                      "k", "d", "v", "f"))
    assert out == [(1, dt.date(2020, 1, 5), "old", True), (2, dt.date(2020, 1, 6), "ins", False)]


def test_rows_as_json(spark):
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    assert WR.rows_as_json(df).first().json == '{"k":1,"s":"a"}'


def test_document_columns(spark):
    df = WR.document_columns(spark.createDataFrame([(1,)], "k int"), {"k": "the key"})
    assert df.schema["k"].metadata["comment"] == "the key"


def test_no_python_udf_in_any_query(spark):
    from featuremart.plans import QUERIES
    from tests.conftest import SF_SMALL
    for name, fn in QUERIES.items():
        if name in ("replace_range", "replace_by_key", "upsert_delete", "rows_to_json", "missing_data_run"):
            continue  # these write files while being built; their plans are read-backs
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_distributed_row_number_matches_window_on_hot_key(spark):
    from pyspark.sql import Window
    rows_ = [("hot", i % 97, i) for i in range(3000)] + [("cold", i, i) for i in range(40)] + \
            [(None, 1, 99999)]
    df = spark.createDataFrame(rows_, "g string, v int, id int")
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id").asc())
    want = sorted(rows(df.withColumn("rk", F.row_number().over(w)), "g", "id", "rk"), key=str)
    for threshold in (100, 10**9):  # hot path for "hot" (and the plain path for the rest), plain only
        got = W.distributed_row_number(df, ["g"], [("v", "desc"), ("id", "asc")], "rk",
                                       num_partitions=7, hot_threshold=threshold)
        assert sorted(rows(got, "g", "id", "rk"), key=str) == want
    # the hot group really is spread over several tasks
    parts = df.repartitionByRange(7, "g", F.col("v").desc(), "id").where("g = 'hot'") \
        .select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_load_dataset_empty_is_error_and_fallback(spark, tmp_path):
    from featuremart.sources import readers as R
    empty, full = str(tmp_path / "empty"), str(tmp_path / "shared" / "t")
    spark.createDataFrame([], "a int").write.parquet(empty)
    spark.createDataFrame([(1, dt.date(2020, 1, 5))], "a int, d date").write.parquet(full)
    with pytest.raises(R.EmptyDatasetError):
        R.load_dataset(spark, empty)
    assert R.load_optional(spark, str(tmp_path / "missing")) is None
    assert R.load_optional(spark, full, date_col="D", start="2020-02-01") is None  # filtered empty
    got = R.load_many(spark, {"t": {"path": str(tmp_path / "user" / "t"), "date_col": "d",
                                     "start": "2020-01-01", "end": "2020-01-31", "out_col": "info_date"}},
                      fallback_root=str(tmp_path / "shared"))
    assert got["t"].columns == ["a", "info_date"] and got["t"].count() == 1


def test_document_table_comments(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "k int, v string").write.option(
        "path", str(tmp_path / "tbl")).saveAsTable("fm_doc_test")
    try:
        WR.document_table(spark, "fm_doc_test", "a table", {"k": "the key", "missing": "ignored"})
        assert spark.table("fm_doc_test").schema["k"].metadata.get("comment") == "the key"
    finally:
        spark.sql("DROP TABLE IF EXISTS fm_doc_test")


def test_validate_before_save_stores_and_stops(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 3)), (1, dt.date(2020, 1, 4))], "k int, d date")
    stored = []

    def store(records):
        out = WR.merge_by_keys(spark, None, records, ["dataset_name", "_observ_end_dt"],
                               str(tmp_path / f"v{len(stored)}"))
        stored.append(out)
        return out
    rec = Q.validate_before_save(df, "ds", Q.QualityRules(unique_keys=["k"]), "d", store)
    assert rec.count() == 1 and stored
    crit = Q.QualityRules(unique_keys=["k"], severity={**Q.DEFAULT_SEVERITY, "DUPLICATES": "CRITICAL"})
    with pytest.raises(Q.QualityStop):
        Q.validate_before_save(df, "ds", crit, "d", store)


def test_window_helpers_and_listing(spark):
    from featuremart.sources.readers import list_tables
    assert D.previous_month_range(dt.date(2024, 3, 15)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert D.held_back_range(dt.date(2024, 1, 1), dt.date(2024, 1, 10)) == (dt.date(2024, 1, 1), dt.date(2024, 1, 8))
    m = Q.month_ranges(spark, "2024-01-15", "2024-03-02").collect()
    assert [(r.month_start, r.month_end) for r in m] == [
        (dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
        (dt.date(2024, 3, 1), dt.date(2024, 3, 31))]
    rec = spark.createDataFrame([], Q.record_schema())
    assert "run_time" in Q.with_run_time(rec, "2024-01-01 00:00:00").columns
    meta = spark.createDataFrame([("a", "ts"), ("b", "ts"), ("b", "x"), ("c", "y")], "table_name string, column_name string")
    assert P.tables_with_column(meta, "ts") == ["a", "b"]
    spark.range(3).createOrReplaceTempView("fm_tmp_view")
    assert "fm_tmp_view" in list_tables(spark) and "fm_tmp_view" not in list_tables(spark, exclude_prefixes=["fm_"])


def test_int_columns_with_cnt(spark):
    df = spark.createDataFrame([(1, 2, "x", 1.5)], "k long, n int, s string, d double")
    assert C.int_columns_with_cnt(df, exclude=["k"]).columns == ["k", "n_cnt", "s", "d"]


def test_row_sums_null_rules(spark):
    from featuremart.functions.arith import nullsafe_sum, safe_ratio, sum_fields, sum_fields_nullsafe
    df = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a int, b int")
    out = df.select(sum_fields(["a", "b"]).alias("p"), sum_fields_nullsafe(["a", "b"]).alias("z"),
                    nullsafe_sum(["a", "b"]).alias("n"), safe_ratio("a", "b").alias("r")).collect()
    assert [(r.p, r.z, r.n) for r in out] == [(None, 1, 1), (None, 0, None), (5, 5, 5)]
    assert out[0].r is None and abs(out[2].r - 2 / 3) < 1e-12


def test_session_defaults_keep_launch_settings(spark):
    from featuremart.session import get_session
    before = spark.conf.get("spark.sql.shuffle.partitions")
    again = get_session()  # defaults only where the launch configuration set nothing
    assert again is spark
    assert again.conf.get("spark.sql.shuffle.partitions") == before
    assert again.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"


def test_movement_kind_uses_the_products_code_list(spark):
    from featuremart.plans.cleaning import movement_kind
    kinds = {"fund": {"1": "deposit", "2": "fee"}, "term": {"1": "interest"}}
    df = spark.createDataFrame([("fund", "2"), ("term", "1"), ("term", "2"), (None, "1")], "p string, c string")
    got = [r.k for r in df.select(movement_kind(F.col("p"), F.col("c"), kinds).alias("k")).collect()]
    assert got == ["fee", "interest", None, None]


def test_card_measures_in_one_pass_match_separate_passes(spark):
    from tests.conftest import SF_SMALL
    from featuremart.plans.layers import card_account_features
    from featuremart.plans.transform import credit_card_node
    node = credit_card_node(spark, SF_SMALL)
    keys = ["customer_key", "account_key", "_observ_end_dt"]
    alone = card_account_features(spark, SF_SMALL).withColumnRenamed("balance_val", "statement_balance_val")
    cols = [c for c in alone.columns if c not in keys]
    joined = node.select(*keys, *cols).join(alone, keys, "inner")
    assert joined.count() > 0
    for c in cols:
        assert joined.where(~node[c].eqNullSafe(alone[c])).count() == 0, c


def test_pivot_totals_equal_ungrouped_totals(spark):
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", "c", None]),
                              st.one_of(st.none(), st.integers(-50, 50))), max_size=30))
    def check(data):
        df = spark.createDataFrame(data, "k int, cat string, v int")
        p = A.pivot_measures(df, ["k"], "cat", ["a", "b", "c"],
                             {"cnt": ("count", None), "amount": ("sum", "v")})
        got = p.agg(*[F.sum(f"{c}_{m}").alias(f"{c}_{m}") for c in "abc" for m in ("cnt", "amount")]).first()
        for c in "abc":
            rows_c = [r for r in data if r[1] == c]
            assert (got[f"{c}_cnt"] or 0) == len(rows_c)
            assert (got[f"{c}_amount"] or 0) == sum(r[2] for r in rows_c if r[2] is not None)

    check()


def test_flagship_counts_every_movement(spark):
    from tests.conftest import SF_SMALL
    from featuremart.plans.features import month_features_df
    from featuremart.plans.inputs import transactions
    f = month_features_df(spark, SF_SMALL)
    total = f.agg(F.sum("trx_movements_cnt").alias("n"),
                  F.sum(F.col("trx_a_cnt") + F.col("trx_n_cnt") + F.col("trx_r_cnt")).alias("k")).first()
    assert total.n == transactions(spark, SF_SMALL).count() == total.k


def test_credit_card_node_scans_the_fact_table_once(spark):
    from tests.conftest import SF_SMALL
    from featuremart.plans.transform import credit_card_node
    plan = credit_card_node(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1, plan


@pytest.mark.parametrize("name", ["debt_features", "ratio_cut", "entity_match", "investment_features",
                                  "history_latest_report", "income_and_supplier", "card_addons", "loan_ageing"])
def test_facts_are_scanned_once(spark, name):
    from featuremart.plans import QUERIES
    from tests.conftest import SF_SMALL
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/lineitem.parquet]") <= 1, plan


def test_unlisted_values_keep_their_rows(spark, tmp_path):
    """A product type or an event type outside the pivot's list still counts in the totals."""
    from featuremart.plans import QUERIES
    from tests.conftest import SF_SMALL
    for t in ("orders", "lineitem", "customer"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF_SMALL}/{t}.parquet")
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    part.withColumn("p_type", F.regexp_replace("p_type", "^PROMO$", "UNHEARD")).write.parquet(f"{tmp_path}/part.parquet")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.withColumn("event_type", F.regexp_replace("event_type", "^view$", "unheard")) \
        .write.parquet(f"{tmp_path}/events.parquet")
    for name, total in (("investment_features", "invested_val"), ("sources_pivot_key", "amount_val"),
                        ("channel_sums", "operations_cnt"), ("forex_channels", "event_id")):
        sums = [QUERIES[name](spark, d).agg(F.sum(total)).first()[0] for d in (SF_SMALL, str(tmp_path))]
        if name == "channel_sums":  # sign-ups and purchases are the app, everything else the web
            assert sums[0] == sums[1]
        assert sums[0] == sums[1], name


def test_no_local_checkpoint_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from featuremart.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_empty_month_and_failing_rule(spark):
    df = spark.createDataFrame([("1", dt.date(2020, 1, 5)), ("x", dt.date(2020, 1, 6))], "s string, d date")
    months = Q.month_ranges(spark, "2020-01-01", "2020-02-29")
    rules = Q.QualityRules(null_limits={"s": 0}, rules=[{"name": "num", "condition": "cast(s as int) > 0"}])
    rec = Q.checked_records(df, "ds", rules, "d", months).collect()
    assert sorted((r.check, r.status) for r in rec) == [
        ("EMPTY_DATASET", "WARN"), ("ERROR", "FAIL"), ("NULL_VALUES", "PASS")]
    with pytest.raises(Q.QualityStop):
        Q.validate_before_save(df, "ds", rules, "d")
    rules.block_on_error = False
    Q.validate_before_save(df, "ds", rules, "d")
    empty = Q.checked_records(df.limit(0), "ds", Q.QualityRules(null_limits={"s": 0}, fail_on_empty=True)).collect()
    assert [(r.check, r.severity, r.status) for r in empty] == [("EMPTY_DATASET", "CRITICAL", "FAIL")]


def test_stopped_table_shows_zero_months_and_gaps_stop_the_run(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5), 1), (dt.date(2020, 4, 2), 2)], "d date, c int")
    got = {str(r.info_date): r.records for r in P.volume_series(df, "t", "d", "2020-07-10", "c").collect()}
    assert got == {"2020-01-31": 1, "2020-02-29": 0, "2020-03-31": 0, "2020-04-30": 1, "2020-05-31": 0, "2020-06-30": 0}
    spine = [str(r.info_date) for r in P.monthly_spine(df, "d", "2020-07-10").collect()]
    assert spine == sorted(got)
    comp = spark.createDataFrame([("t", "snapshot", "d", dt.date(2020, 1, 31), 0)],
                                 "table_name string, table_kind string, date_column string, info_date date, cnt long")
    with pytest.raises(P.MissingDates, match="t 2020-01"):
        P.require_complete(P.missing_months(comp))
    P.require_complete(P.missing_months(comp.where("cnt > 0")))


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in sorted(path.rglob("*.parquet"))}


def _stored_months(spark, path):
    rows_ = [(1, dt.date(2020, 1, 5), "a", True), (2, dt.date(2020, 2, 5), "b", True), (3, dt.date(2020, 2, 6), "c", False),
             (4, dt.date(2020, 3, 5), "d", True), (5, dt.date(2020, 4, 5), "e", True), (6, dt.date(2020, 5, 5), "f", True),
             (None, dt.date(2020, 2, 7), "n", True), (8, None, "no date", True)]
    df = spark.createDataFrame(rows_, "k int, d date, v string, f boolean")
    WR.save_partitioned(with_period(df, "d"), str(path), "_particion", "replace_schema")
    return df


def test_upsert_rewrites_only_the_months_it_touches(spark, tmp_path):
    """Window Feb-Apr: 2 and the null key go, 3 and 4 are matched, all of April goes, 7 comes in
    June; January, March and May keep their files."""
    path = tmp_path / "t"
    target = _stored_months(spark, path)
    before = _files(path)
    src = spark.createDataFrame([(1, dt.date(2020, 1, 5), "A"), (3, dt.date(2020, 2, 6), "C"), (4, dt.date(2020, 9, 9), "D"),
                                 (7, dt.date(2020, 6, 1), "G")], "k int, d date, v string")
    want = sorted(rows(WR.upsert_with_window_delete(target, src, ["k"], "d", "2020-02-01", "2020-04-30", "f"), "k", "d", "v", "f"), key=str)
    manifest = WR.upsert_in_partitions(spark, str(path), src, ["k"], "d", "2020-02-01", "2020-04-30", "f")
    assert sorted(rows(spark.read.parquet(str(path)), "k", "d", "v", "f"), key=str) == want
    assert sorted((m["partition"], m["action"], m["rows"]) for m in manifest) == [
        (202002, "rewritten", 1), (202004, "dropped", 0), (202006, "rewritten", 1)]
    after = _files(path)
    kept = [f for f in before if f.split("/")[0] in ("_particion=202001", "_particion=202003", "_particion=202005",
                                                     "_particion=__HIVE_DEFAULT_PARTITION__")]
    assert len(kept) == 4 and all(after.get(f) == before[f] for f in kept)
    assert not any("202004" in f for f in after)
    # the same run again changes nothing, so it rewrites nothing
    assert WR.upsert_in_partitions(spark, str(path), src, ["k"], "d", "2020-02-01", "2020-04-30", "f") == []
    assert _files(path) == after


def test_merge_rewrites_only_the_partitions_of_its_keys(spark, tmp_path):
    """Key 2 moves from February to May, key 5's month is left empty, key 9 is new."""
    path = tmp_path / "t"
    stored = _stored_months(spark, path)
    before = _files(path)
    new = spark.createDataFrame([(2, dt.date(2020, 5, 9), "B", False), (5, dt.date(2020, 5, 8), "E", False),
                                 (9, dt.date(2020, 5, 1), "I", False)], "k int, d date, v string, f boolean")
    manifest = WR.merge_in_partitions(spark, str(path), with_period(new, "d"), ["k"], "_particion")
    want = WR.merge_by_keys(spark, stored, new, ["k"], str(tmp_path / "whole"))
    key = lambda df: sorted(rows(df, "k", "d", "v", "f"), key=str)
    assert key(spark.read.parquet(str(path))) == key(want)
    assert sorted((m["partition"], m["action"]) for m in manifest) == [(202002, "rewritten"), (202004, "dropped"), (202005, "rewritten")]
    after = _files(path)
    assert all(after[f] == before[f] for f in before if "202001" in f or "202003" in f)


def test_checks_with_a_key_read_the_table_once(spark):
    import __spark_entry__ as E

    for name in ("dq_duplicates", "dq_by_month", "quality_decision", "quality_gate", "gate_by_month"):
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1, (name, plan)


def test_observed_checks_equal_the_separate_pass(spark, tmp_path):
    from featuremart.plans.quality import ALL_RULES, dq_source

    df = dq_source(spark, SF_SMALL).where("l_shipdate >= timestamp_ntz'1996-01-01' and l_shipdate < timestamp_ntz'1996-07-01'")
    df = df.unionByName(df.limit(3))       # some repeated keys
    months = [r.month_end for r in Q.month_ranges(spark, "1996-01-01", "1996-06-30").collect()]
    df = Q_staged(spark, df)
    written, records = Q.observed_records(df, "lineitem", ALL_RULES, "l_shipdate", months, lambda x: Q_staged(spark, x))
    key = lambda r: sorted(map(tuple, r.select(Q.RECORD_COLUMNS).collect()))
    assert key(records) == key(Q.quality_records(df, "lineitem", ALL_RULES, "l_shipdate"))
    assert written.count() == df.count()
    with pytest.raises(ValueError, match="outside the months"):
        Q.observed_records(df, "lineitem", ALL_RULES, "l_shipdate", months[:3], lambda x: Q_staged(spark, x))


def Q_staged(spark, df):
    from featuremart.session import staged
    return staged(spark, df, "test")


def test_write_checked_stops_and_reports_a_rule_that_cannot_run(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 5), "x"), (2, dt.date(2020, 1, 6), "y")], "k int, d date, v string")
    months, kept = [dt.date(2020, 1, 31)], []
    good = Q.QualityRules(unique_keys=["k"], null_limits={"v": 0})
    assert Q.write_checked(df, "t", good, "d", months, kept.append).count() == 2
    assert {r.status for r in kept[0].collect()} == {Q.PASS}
    bad = Q.QualityRules(rules=[{"name": "few", "condition": "k < 2", "severity": Q.CRITICAL}])
    with pytest.raises(Q.QualityStop):
        Q.write_checked(df, "t", bad, "d", months)
    broken = Q.QualityRules(rules=[{"name": "cast", "condition": "cast(v as int) > 0"}])
    with pytest.raises(Q.QualityStop):
        Q.write_checked(df, "t", broken, "d", months, kept.append)
    assert [r.check for r in kept[-1].collect()] == [Q.ERROR]


def test_greatest_on_or_after_matches_brute_force(spark):
    import random

    rng = random.Random(1)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(rng.randint(0, 20))
    facts = [(rng.choice([1, 1, 1, 2, 3, None]), day() if rng.random() < 0.95 else None, rng.randint(1, 99)) for _ in range(300)]
    asked = [(i, rng.choice([1, 1, 2, 4, None]), day() if rng.random() < 0.9 else None) for i in range(200)]
    f = spark.createDataFrame(facts, "k int, granted date, loan int")
    r = spark.createDataFrame(asked, "id int, k int, asked date")
    got = J.greatest_on_or_after(r, f, ["k"], "asked", "granted", "loan", "best")
    want = sorted((i, max((v for k2, g, v in facts if k2 == k and k is not None and g and d and g >= d), default=None))
                  for i, k, d in asked)
    assert sorted(rows(got, "id", "best"), key=lambda x: x[0]) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "SortMergeJoin" not in plan.split("Window")[0]


def test_keep_ratio_counts_values_without_a_set(spark):
    """Nulls are no value; a group without any value is kept whole; hot and cold groups agree."""
    data = [(1, i, v) for i, v in enumerate(["a", "b", None, "a", "b", "a"])] + [(2, i, None) for i in range(3)] + \
        [(3, i, "x") for i in range(4)] + [(None, i, v) for i, v in enumerate("pqpq")]
    df = spark.createDataFrame(data, "g int, i int, v string")
    want = sorted([(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2), (3, 0), (3, 1), (3, 2), (3, 3), (None, 0), (None, 1)], key=str)
    for hot in (100, 2):
        out = W.keep_ratio(df, ["g"], ["i"], distinct_col="v", hot_threshold=hot)
        assert sorted(rows(out, "g", "i"), key=str) == want, hot
    import __spark_entry__ as E
    for name in ("ratio_cut", "debt_features"):
        assert "collect_set" not in E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_state_of_a_second_run_reads_its_months_only(spark, tmp_path):
    from featuremart.operators import monthly_state as M

    path, src = str(tmp_path / "state"), str(tmp_path / "t")
    data = [(dt.datetime(2020, m, d), c) for m in (1, 2, 3) for d, c in ((3, 7), (9, 7), (9, 40_000), (20, -5), (21, 0), (22, None))]
    df = spark.createDataFrame(data, "ts timestamp_ntz, c bigint")
    df.write.parquet(src)
    df = spark.read.parquet(src)
    M.update_state(spark, path, df, "ts", "c", "2020-01-01", "2020-02-29")
    before = _files(tmp_path / "state")
    scanned = M.month_state(date_range_filter(df, "ts", "2020-03-01", "2020-03-31"), "ts", "c")
    assert "GreaterThanOrEqual(ts" in scanned._jdf.queryExecution().executedPlan().toString()
    assert [m["partition"] for m in M.update_state(spark, path, df, "ts", "c", "2020-03-05", "2020-03-10")] == [202003]
    after = _files(tmp_path / "state")
    assert all(after[f] == before[f] for f in before)
    got = M.monthly_counts(spark.read.parquet(path))
    assert sorted(rows(got, "total_rows", "unique_customers", "empty_c", "zero_c", "empty_ts")) == [(6, 4, 1, 1, 0)] * 3
    # a month that lost its rows is dropped from the state
    M.update_state(spark, path, df.where("month(ts) <> 2"), "ts", "c", "2020-02-01", "2020-02-29")
    assert spark.read.parquet(path).select("info_date").distinct().count() == 2
    with pytest.raises(TypeError):
        M.month_state(df.withColumn("c", F.col("c").cast("string")), "ts", "c")


def test_controls_of_the_newest_month_need_two_stored_rows(spark):
    from featuremart.operators import monthly_state as M

    ends = [dt.date(2018 + i // 12, i % 12 + 1, 1) for i in range(30)]
    series = spark.createDataFrame([("t", 1000 + (i * 37) % 101, i % 3, d) for i, d in enumerate(ends)],
                                   "table_name string, records long, customers long, info_date date").withColumn(
        "info_date", F.last_day("info_date"))
    want = {r.info_date: r for r in P.volume_report(series).collect()}
    stored = M.moments(series.where("info_date < date'2020-06-01'"), ["records", "customers"])
    newest = series.where("info_date > date'2020-06-01'")
    needed = stored.where("info_date in (date'2020-05-31', date'2018-11-30')")   # the month before, and 18 further back
    assert needed.count() == 2
    r, = M.controls(newest, needed, ["records", "customers"]).collect()
    w = want[r.info_date]
    for c in ("records_mean", "records_sd", "records_z", "records_lower", "customers_mean", "customers_sd", "customers_z"):
        assert r[c] == pytest.approx(w[c], rel=1e-9), c
    assert (r.records_state, r.customers_state, r.records_n_hist) == (w.records_state, w.customers_state, w.records_n_hist)
    # moments go on from the newest stored row
    on = M.moments(newest, ["records", "customers"], stored).collect()[0]
    whole = M.moments(series, ["records", "customers"]).where("info_date > date'2020-06-01'").collect()[0]
    assert on == whole


def test_partition_counts_read_no_column(spark, tmp_path):
    from featuremart.sources.readers import partition_counts

    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "cast(id % 3 as int) as day").write.partitionBy("day").parquet(path)
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = partition_counts(spark, path, "day")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [day]" in plan and "ReadSchema: struct<day:int,count(*)" in plan
    assert sorted(rows(got, "day", "records")) == [(0, 34), (1, 33), (2, 33)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == v1 and "parquet" in v1


@pytest.mark.parametrize("name, table, most", [
    ("customer_node_whole", "orders", 1), ("customer_node_whole", "customer", 1), ("customer_node_whole", "events", 1),
    ("credit_card_node_whole", "lineitem", 1), ("card_profile_month", "lineitem", 1), ("debt_detail_whole", "lineitem", 1),
    ("worst_and_latest", "orders", 1), ("current_account_features", "lineitem", 1), ("investment_month", "lineitem", 1)])
def test_tables_are_scanned_once(spark, name, table, most):
    from featuremart.plans import QUERIES
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"/{table}.parquet]") == most, plan


def test_whole_customer_node_exchanges_each_table_once(spark):
    from featuremart.plans import QUERIES
    plan = QUERIES["customer_node_whole"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # orders twice (per product, then per customer), customer, events, supplier
    assert plan.count("Exchange hashpartitioning") == 5 and plan.count("SortMergeJoin") == 3, plan


def test_worst_and_latest_aggregates_match_the_windows(spark):
    data = [(1, 3, dt.date(2020, 1, 1), 10), (1, 9, dt.date(2020, 1, 2), 11), (1, 5, None, 12), (1, 3, dt.date(2020, 1, 2), 13),
            (2, 9, dt.date(2020, 1, 2), 14), (3, None, None, 15)]
    df = spark.createDataFrame(data, "k int, grade int, d date, id int")
    got = df.groupBy("k").agg(W.worst_of("grade", [-F.col("id")], ["id"], [9]).alias("w"), W.latest_of("d", [F.col("id")], ["id"]).alias("l"))
    got = {r.k: (r.w and r.w.id, r.l.id) for r in got.collect()}
    worst = {r.k: r.id for r in W.worst_row(df, ["k"], "grade", [("id", "asc")], [9]).collect()}
    latest = {r.k: r.id for r in W.top_n_per_group(df, ["k"], [("d", "desc"), ("id", "desc")]).collect()}
    assert got == {k: (worst.get(k), latest[k]) for k in (1, 2, 3)}


def test_scratch_tables_go_with_their_root(spark):
    import os

    from featuremart import session as SE

    before = SE.scratch_dir(spark, "x")
    with SE.scratch_root(spark, "run"):
        df = SE.staged(spark, spark.range(5), "part")
        folder = os.path.dirname(df.inputFiles()[0]).removeprefix("file://")
        assert df.count() == 5 and "/run-" in folder and os.path.isdir(folder)
    assert not os.path.exists(os.path.dirname(folder)) and SE.scratch_dir(spark, "x") == before


def test_fact_join_bounds_the_rows_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(J, "FACT_ROWS", 100)
    orders = spark.createDataFrame([(k, k % 7) for k in range(300)] + [(5, 9), (None, 1)], "o_orderkey long, c int")
    facts = spark.createDataFrame([(i % 320, i) for i in range(2000)] + [(None, -1)], "l_orderkey long, v int")
    got = J.fact_join(facts, orders)
    sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1887 and len(sizes) > 15 and max(sizes) <= 250
    plain = facts.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    assert sorted(got.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("name", [
    "pivot_six_measures", "bibanking_with_products", "current_account_month", "month_features", "saving_account_month",
    "debt_conditions", "movement_pivots", "channel_transfers", "saving_month"])
def test_month_queries_deal_the_fact_join_by_rows(spark, name):
    from featuremart.plans import QUERIES
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2, plan


def test_card_node_exchanges_no_wide_rows(spark):
    from featuremart.plans import QUERIES
    plan = QUERIES["credit_card_node_whole"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # joined by sorting: line items with orders, the catalog's grades; by customer go the snapshots' orders, and movements with balances
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning(customer_key") == 2, plan


def test_card_node_keeps_balances_of_its_own_months(spark, tmp_path):
    from featuremart.plans import QUERIES
    day = dt.datetime
    spark.createDataFrame([(1, "Brand#1", "PROMO", "n", 9.0)], "p_partkey long, p_brand string, p_type string, p_name string, p_retailprice double") \
        .write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, 4, "1-URGENT", "F", day(2020, 1, 5), 10.0), (2, 4, "1-URGENT", "O", day(2020, 2, 3), 20.0),
                           (3, None, "1-URGENT", "F", day(2020, 1, 5), 30.0)],
                          "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string, o_orderdate timestamp, o_totalprice double") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(k, n, 1, 2, 100.0, 0.05, "R", "F", d) for k, n, d in [
        (1, 1, day(2020, 1, 9)), (1, 2, day(2020, 3, 9)), (3, 1, day(2020, 1, 9))]],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_discount double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {(r.customer_key, r._observ_end_dt): r.snapshot_balance_val
           for r in QUERIES["credit_card_node_whole"](spark, str(tmp_path)).collect()}
    # a month with a balance and no movement has no row, a null customer meets no balance
    assert got == {(4, dt.date(2020, 1, 31)): Decimal("10.00"), (4, dt.date(2020, 3, 31)): None, (None, dt.date(2020, 1, 31)): None}


def test_investment_month_exchanges_no_partial_sums(spark):
    from featuremart.plans import QUERIES
    plan = QUERIES["investment_month"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    grouped = plan.index("Aggregate(key=[customer_key")
    partial = plan.index("Aggregate(key=[customer_key", grouped + 1)
    assert "Exchange" not in plan[grouped:partial], plan[grouped:partial]
