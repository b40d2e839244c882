"""One result whatever the chunks, ties in their own order, and small points of the sources and jobs."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelane import operators as op, plans, sources as src
from tidelane.functions import add_corrected_ph
from tidelane.operators.rolling import with_row_number
from tidelane.session import new_shared_path, shared_folder

BASE = datetime(2025, 3, 1)
TS = "datetime_utc"


def at(seconds):
    return None if seconds is None else BASE + timedelta(seconds=seconds)


@pytest.mark.parametrize("rows_per_chunk", [7, 19, 10**6])
def test_fill_time_with_null_keys(spark, chunked, rows_per_chunk):
    chunked(rows_per_chunk)
    rows = [(i, (None, "a", "b")[i % 3], at(i * 10) if i % 12 < 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "i long, k string, t timestamp_ntz")
    got = {r.i: r.ts for r in src.fill_time_by_increment(df, "t", "i", "2s", ["k"]).collect()}
    for key in (None, "a", "b"):
        last = None
        for i, k, t in rows:
            if k == key:
                last = t if t is not None else last + timedelta(seconds=2)
                assert got[i] == last


TIES = {
    "string": lambda r: "same start " + "".join(r.choice("abé") for _ in range(3)),
    "double": lambda r: r.choice([0.25, 0.5, -3.75, 7.125, float("nan"), None, 1e300]),
    "decimal(9,3)": lambda r: r.choice([None, 1, 2]),
    "boolean": lambda r: r.choice([True, False]),
    "date": lambda r: BASE.date() + timedelta(days=r.randrange(4)),
}


@pytest.mark.parametrize("kind", list(TIES))
@pytest.mark.parametrize("rows_per_chunk", [6, 23, 10**6])
def test_previous_row_follows_any_tie(spark, chunked, kind, rows_per_chunk):
    chunked(rows_per_chunk)
    r = random.Random(kind)
    make = TIES[kind]
    rows = [(r.choice([0, 0, 1, 5]), make(r), i, r.choice(["x", None])) for i in range(80)]
    from decimal import Decimal

    if kind.startswith("decimal"):
        rows = [(a, None if b is None else Decimal(b) / 8, c, d) for a, b, c, d in rows]
    df = spark.createDataFrame([(at(s), t, i, k) for s, t, i, k in rows], f"{TS} timestamp_ntz, tie {kind}, i int, k string")
    nan = lambda v: isinstance(v, float) and math.isnan(v)
    byte = lambda v: v.encode() if isinstance(v, str) else v
    rank = lambda x: (x[0], x[1] is not None, nan(x[1]), 0 if x[1] is None or nan(x[1]) else byte(x[1]), x[2])
    for keys in ([], ["k"]):
        got = {x.i: x.p for x in op.with_previous(df, TS, {"p": "i"}, keys, tie=["tie", "i"]).collect()}
        for key in {x[3] for x in rows} if keys else {0}:
            own = sorted((x for x in rows if not keys or x[3] == key), key=rank)
            assert [got[x[2]] for x in own] == [None, *[x[2] for x in own[:-1]]]
    if rows_per_chunk > 6:
        numbered = {x.i: x["__rn"] for x in with_row_number(df, TS, ["tie", "i"]).collect()}
        assert [numbered[x[2]] for x in sorted(rows, key=rank)] == list(range(80))


def test_tie_of_another_type_is_refused(spark):
    df = spark.createDataFrame([(at(0), [1])], f"{TS} timestamp_ntz, tie array<int>")
    with pytest.raises(TypeError):
        op.with_previous(df, TS, {"p": TS}, tie=["tie"])


def test_sampling_interval_by_key(spark):
    rows = [(at(i * s), k) for k, s in (("a", 2), ("b", 10)) for i in range(9)]
    df = spark.createDataFrame(rows, f"{TS} timestamp_ntz, k string")
    got = {r.k: r.median_s for r in op.sampling_interval(df, TS, ["k"]).collect()}
    assert got == {"a": 2.0, "b": 10.0}


def test_day_column_of_the_user_survives(spark):
    df = spark.createDataFrame([(at(0), "monday"), (None, "x")], f"{TS} timestamp_ntz, day string")
    path = new_shared_path(spark, "series")
    src.write_parquet_series(df, path)
    assert sorted(r.day for r in src.read_parquet_series(spark, path).collect()) == ["monday", "x"]
    with pytest.raises(ValueError):
        src.write_parquet_series(df.withColumn("utc_day_partition", F.lit(1)), path + "b")


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_epoch_window_reaches_the_scan(spark, kind):
    path = new_shared_path(spark, "epoch")
    spark.range(1_740_787_200, 1_740_787_260).select(F.col("id").cast(kind).alias(TS)).write.parquet(path)
    df = src.read_epoch_table(spark, path, lo="2025-03-01 00:00:10", hi="2025-03-01 00:00:20", truncate=True)
    assert df.count() == 11
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(datetime_utc" in plan and "LessThan(datetime_utc" in plan


def test_feed_without_times_keeps_its_columns(spark):
    a = spark.createDataFrame([(at(0), 1.0), (at(4), 2.0)], f"{TS} timestamp_ntz, a double")
    b = spark.createDataFrame([(None, 5.0)], f"{TS} timestamp_ntz, b double")
    out = op.align_series({"a": a, "b": b, "c": b.limit(0).withColumnRenamed("b", "c")}, "2s", TS)
    assert out.columns == [TS, "a", "b"] and [r.b for r in out.collect()] == [None] * 3


def test_ph_of_odd_salinities(spark):
    df = spark.createDataFrame([(-1.0, 20.0, -0.1), (-1.0, 20.0, 0.0), (-1.0, None, 35.0)], "vrse double, temperature double, salinity double")
    a, b, c = [r.ph_corrected for r in add_corrected_ph(df, -1.39, -0.001).collect()]
    assert math.isnan(a) and b is None and c is None


def test_read_ph_and_rho(spark):
    folder = new_shared_path(spark, "feeds")
    rows = [(1_740_787_200.75 + i, 8.0 if i != 2 else 9.5, 0.1) for i in range(5)]
    spark.createDataFrame(rows, f"{TS} double, ph_total double, rho_ppb double").write.parquet(folder + "/t")
    spark.createDataFrame([("2025-03-01 00:00:03", "2025-03-01 00:00:03", "4", "x")], "start_time string, end_time string, qc_flag string, comment string"
                          ).write.option("header", True).csv(folder + "/iv")
    ph = plans.read_ph_and_flag(spark, folder + "/t", folder + "/iv").orderBy(TS).collect()
    assert [(r[TS], r.ph_flag) for r in ph] == [(at(i), 4 if i in (2, 3) else 2) for i in range(5)]
    rho = plans.read_rho(spark, folder + "/t").orderBy(TS).collect()
    assert [r.rho_flag for r in rho] == [2] * 5 and rho[0][TS] == at(0)


def test_shared_folder_is_named_or_local(spark):
    assert shared_folder(spark)
