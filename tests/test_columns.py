import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelane import operators as op
from tidelane.functions import add_corrected_ph, chemistry, duration_us, normalize_time, time_shift

BASE = datetime(2025, 8, 13)
TS = "datetime_utc"
NAN = float("nan")


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def test_durations():
    assert duration_us("2s") == duration_us("2 seconds") == duration_us(2) == duration_us(timedelta(seconds=2)) == 2_000_000
    assert duration_us("1m") == duration_us("INTERVAL '1' minute") == 60_000_000
    assert duration_us("1.5s") == 1_500_000
    for bad in ("2", "2 fortnights", "s"):
        with pytest.raises(ValueError):
            duration_us(bad)


def test_normalize_time(spark):
    df = spark.createDataFrame([(1, "2025-08-13 00:00:01"), (2, "soon")], "n int, t string")
    out = normalize_time(normalize_time(df, "t", "coerce"), "n").orderBy("n").collect()
    assert out[0].t == at(1) and out[1].t is None and out[0].n == datetime(1970, 1, 1, 0, 0, 1)
    with pytest.raises(Exception):
        normalize_time(df, "t").collect()


def test_shift_and_slice(spark):
    df = spark.createDataFrame([(at(i),) for i in range(5)], f"{TS} timestamp_ntz")
    assert op.slice_time(df, at(1), at(3)).count() == 1
    assert op.slice_time(df, at(1), at(3), "both").count() == 3
    assert time_shift(df, TS, "46s").agg(F.min(TS)).first()[0] == at(46)


def test_flags_on_null_and_nan(spark):
    df = spark.createDataFrame([(0, 9.5), (1, 9.0), (2, None), (3, NAN)], "i int, v double")
    out = op.threshold_flag(df, "v", ">", 9.0, "f")
    assert [r.f for r in out.orderBy("i").collect()] == [4, 2, 2, 4]
    assert [r.f for r in op.null_flag_where_nan(out, "v", "f").orderBy("i").collect()] == [4, 2, 2, None]
    assert [r.f for r in op.null_flag_where_missing(out, {"v": "f"}).orderBy("i").collect()] == [4, 2, None, 4]


def test_drop_flagged_drops_null_flags(spark):
    df = spark.createDataFrame([(2, 2), (3, 2), (2, 4), (None, 2)], "a int, b int")
    assert [tuple(r) for r in op.drop_flagged(df, ["a", "b"]).collect()] == [(2, 2)]
    text = spark.createDataFrame([("2",), ("4",)], "f string")
    assert op.drop_flagged(text, ["f"], ["4"]).count() == 1


def test_default_flag_only_if_absent(spark):
    df = spark.createDataFrame([(3,)], "oxygen_flag int")
    assert op.default_flag(df, "oxygen_flag", only_if_absent=True).first().oxygen_flag == 3
    assert dict(op.default_flag(df, "f").dtypes)["f"] == "tinyint"


def test_ensure_columns_and_null_rows(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    assert op.drop_all_null_rows(df, ["a", "b"]).count() == 1
    assert op.drop_any_null_rows(df).count() == 0
    assert op.ensure_columns(df, {"c": "string", "a": "double"}).columns == ["c", "a"]


def test_buckets(spark):
    df = spark.createDataFrame(
        [(at(0), None, "u"), (at(9.9), 4.0, "s"), (at(10), 6.0, "u"), (at(25), NAN, "u")], f"{TS} timestamp_ntz, v double, source string"
    )
    first = op.bucket_first(df, "10s", ["v", "source"]).orderBy(TS).collect()
    assert [tuple(r)[:2] for r in first[:2]] == [(at(0), None), (at(10), 6.0)] and len(first) == 3
    mean = op.bucket_mean_first(df, "10s").orderBy(TS).collect()
    assert (mean[0].v, mean[0].source) == (4.0, "u") and mean[2].v != mean[2].v
    assert op.bucket_mean(df, "10s", exclude=["source"]).columns == [TS, "v"]


def test_bucket_by_type(spark):
    df = spark.createDataFrame(
        [(at(0), 1, 2.0, "2", "a", 5), (at(1), 2, 4.0, "4", "b", 6)],
        f"{TS} timestamp_ntz, n int, v double, ph_flag string, note string, timestamp int",
    )
    out = op.bucket_by_type(df, "1m").first().asDict()
    assert out == {TS: at(0), f"{TS}_first": at(0), "n": 1.5, "v": 3.0, "ph_flag": "4", "note_first": "a"}
    assert op.bucket_by_type(df.withColumn("ph_flag", F.col("ph_flag").cast("tinyint"))).first().ph_flag == 4
    assert op.bucket_by_type(df.withColumn("ph_flag", F.col("ph_flag").cast("int"))).first().ph_flag == 3.0


def test_mean_join_drops_repeated_times_and_empty_buckets(spark):
    a = spark.createDataFrame([(at(1), 1.0, 1), (at(1), 9.0, 2), (at(2), NAN, 3), (at(60), 5.0, 4)], f"{TS} timestamp_ntz, latitude double, seq int")
    b = spark.createDataFrame([(at(3), 2.0), (at(100), None)], f"{TS} timestamp_ntz, temp double")
    out = op.resample_mean_join([("a", a), ("b", b)], "10s", ties={"a": ["seq"]}).orderBy(TS).collect()
    assert [(r[TS], r.latitude, r.temp, r.vrse) for r in out] == [(at(0), 1.0, 2.0, None), (at(60), 5.0, None, None)]
    empty = op.resample_mean_join([("a", a.drop(TS))], "10s")
    assert empty.count() == 0 and len(empty.columns) == 8


def test_reports(spark):
    df = spark.createDataFrame([(at(0), 1.0), (at(0), 1.0), (None, NAN), (None, None)], f"{TS} timestamp_ntz, v double")
    assert op.duplicate_times(df).first()[0] == 2
    assert {r.column: (r.missing, r.percent) for r in op.missing_report(df).collect()} == {TS: (2, 50.0), "v": (2, 50.0)}
    q = op.quality_scores(df).first()
    assert (q.total_cells, q.missing_cells, q.duplicate_rows, q.completeness, q.uniqueness) == (8, 4, 2, 50.0, 50.0)
    assert op.row_range(df).first().row_count == 4
    assert op.null_count(df, "v").first()[0] == 1


def test_correlation_needs_more_than_ten_complete_rows(spark):
    df = spark.range(11).selectExpr("cast(id as double) x", "cast(2 * id as double) y", "if(id = 3, null, 1.0) z")
    assert op.correlation(df, "x", "y").first().correlation == pytest.approx(1.0)
    assert op.correlation(df, "x", "y", ["z"]).count() == 0


def test_describe(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (4.0, "b"), (None, "c")], "v double, t string")
    rows = {r.column: r for r in op.describe_series(df).collect()}
    v = rows["v"]
    assert (v["count"], v.null_count, v.min, v.q25, v.q50, v.q75, v.max) == (3, 1, 1.0, 2.0, 2.0, 4.0, 4.0)
    assert (rows["t"]["count"], rows["t"].null_count, rows["t"].mean) == (3, 1, None)


@pytest.mark.parametrize("volts, ph", [(-0.95, 7.374800), (-0.93, 7.718636), (-0.90, 8.234390)])
def test_ph(spark, volts, ph):
    df = spark.createDataFrame([(volts, 20.0, 32.0)], "vrse double, temperature double, salinity double")
    assert add_corrected_ph(df, -1.3944286, -0.00107).first().ph_corrected == pytest.approx(ph, abs=1e-6)


def test_seawater_constants_against_published_values(spark):
    """Dickson, Sabine and Christian (2007), Guide to best practices for ocean CO2 measurements, chapter 5, at salinity
    35 and 25 C: chloride and sulfate of standard seawater, ionic strength, ln of the bisulfate constant."""
    salt, temp = F.lit(35.0), F.lit(25.0)
    row = spark.range(1).select(
        chemistry.total_chloride(salt), chemistry.total_sulfate(salt), chemistry.ionic_strength(salt),
        chemistry.ln_bisulfate_constant(temp, salt),
    ).first()
    assert [round(v, n) for v, n in zip(row, (5, 5, 3, 2), strict=True)] == [0.54586, 0.02824, 0.723, -2.30]


def test_ph_without_inputs(spark):
    df = spark.createDataFrame([(-0.9, None, 32.0), (-0.9, 20.0, 0.0)], "vrse double, temperature double, salinity double")
    assert [r.ph_corrected for r in add_corrected_ph(df, -1.39, -0.001).collect()] == [None, None]
    out = add_corrected_ph(df.drop("salinity"), -1.39, -0.001)
    assert dict(out.dtypes)["ph_corrected"] == "double" and out.where("ph_corrected is not null").count() == 0


def test_grid_blocks(spark, monkeypatch):
    from tidelane.operators import grid

    monkeypatch.setattr(grid, "POINTS_PER_BLOCK", 7)
    bounds = spark.createDataFrame([(at(0), at(100.5))], "lo timestamp_ntz, hi timestamp_ntz")
    got = [r[0] for r in op.time_grid(bounds, 3).orderBy(TS).collect()]
    assert got == [at(3 * i) for i in range(34)]
    floored = [r[0] for r in op.time_grid(bounds, 30, floored=True).orderBy(TS).collect()]
    assert floored == [at(30 * i) for i in range(5)]
    assert op.time_grid(bounds.where("false"), 3).count() == 0


def test_shared_tables_are_cleared(spark):
    from tidelane.session import clear_shared, new_shared_path, shared_mark

    mark = shared_mark()
    path = new_shared_path(spark, "probe")
    spark.range(3).write.parquet(path)
    new_shared_path(spark, "never-written")
    assert spark.read.parquet(path).count() == 3
    assert clear_shared(spark, mark) == 1 and shared_mark() == mark
    assert not os.path.exists(path.removeprefix("file://"))
