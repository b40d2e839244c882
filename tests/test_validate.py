from datetime import datetime, timedelta

import pytest

from tidelane import operators as op

BASE = datetime(2025, 8, 13)
TS = "datetime_utc"


def rules(report):
    return {(r.rule, r.column): (r.severity, r.violations, r.passed) for r in report.collect()}


def test_range_is_a_warning_and_nulls_pass(spark):
    df = spark.createDataFrame([(BASE, 91.0, 0.0), (BASE, None, -181.0), (BASE, 90.0, 180.0)], f"{TS} timestamp_ntz, latitude double, longitude double")
    got = rules(op.validate_gps(df))
    assert got["range", "latitude"] == ("warning", 1, True) and got["range", "longitude"] == ("warning", 1, True)
    assert op.check_feed(df, "gps") is df


def test_missing_column_and_text_are_errors(spark):
    df = spark.createDataFrame([(BASE, "1.5"), (BASE, "x")], f"{TS} timestamp_ntz, rho_ppb string")
    assert rules(op.validate_rho(df))["type", "rho_ppb"] == ("error", 1, False)
    assert rules(op.validate_oxygen(df))["required", "oxygen_umol_kg"] == ("error", 1, False)
    for feed in ("rho", "oxygen"):
        with pytest.raises(ValueError):
            op.check_feed(df, feed)


def test_flag_range_is_strict_and_empty_feed_raises(spark):
    df = spark.createDataFrame([(BASE, 0.5, 9)], f"{TS} timestamp_ntz, vrse double, ph_flag int")
    assert rules(op.validate_ph(df))["range", "ph_flag"] == ("error", 1, False)
    empty = spark.createDataFrame([], f"{TS} timestamp_ntz, temperature double, salinity double")
    assert all(p for _, _, p in rules(op.validate_tsg(empty)).values())
    with pytest.raises(ValueError):
        op.check_feed(empty, "tsg", not_empty=True)


def test_range_report_ignores_case_and_nan(spark):
    df = spark.createDataFrame([(9.0, float("nan")), (20.0, 30.0)], "Temperature double, salinity double")
    got = {r.column: (r.out_of_range, r.min_value, r.max_value) for r in op.range_report(df).collect()}
    assert got == {"Temperature": (1, 9.0, 20.0), "salinity": (0, 30.0, 30.0)}
    assert op.range_report(df.select("Temperature").withColumnRenamed("Temperature", "x")).count() == 0


def test_table_overlap(spark):
    span = lambda a, b: spark.createDataFrame([(BASE + timedelta(hours=h),) for h in (a, b)], f"{TS} timestamp_ntz")
    out = op.table_overlap({"a": span(0, 4), "b": span(3, 9), "c": span(20, 30), "d": span(0, 1).drop(TS)})
    got = {(r.table1, r.table2): r.overlap_s for r in out.collect()}
    assert got == {("a", "b"): 3600.0, ("a", "c"): 0.0, ("b", "c"): 0.0}


def test_audit(spark):
    rows = [(BASE + timedelta(seconds=2 * i), i, 41.5, -70.0, 20.0 + i % 2, 30.0 + i / 10, 40.0 + i / 10) for i in range(20)]
    df = spark.createDataFrame(
        rows, f"{TS} timestamp_ntz, seq int, latitude double, longitude double, temperature double, salinity double, conductivity double"
    )
    reports = op.audit_series(df, arrival="seq")
    assert set(reports) == {
        "missing", "non_monotonic", "regularity", "ranges", "correlation", "jumps", "outliers", "completeness", "quality"
    }
    long = {(r.check, r.item, r.metric): r.value for r in op.collect_audit(reports).collect()}
    assert long["regularity", None, "median_s"] == 2.0 and long["jumps", None, "jumps"] == 0
    assert long["correlation", None, "correlation"] == pytest.approx(1.0)
    assert long["completeness", None, "actual_points"] == 20
