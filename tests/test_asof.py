import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelane import operators as op

BASE = datetime(2024, 2, 3, 7, 30, 0)
TS = "datetime_utc"


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def series(spark, rows, columns):
    return spark.createDataFrame(rows, f"{TS} timestamp_ntz, {columns}")


def test_two_offset_feeds_on_a_two_second_grid(spark):
    temp = series(spark, [(at(2 * i), 4.0 + i / 4) for i in range(5)], "temperature double")
    salt = series(spark, [(at(2 * i + 1), 11.0 + i) for i in range(5)], "salinity double")
    out = op.align_series({"temperature": temp, "salinity": salt}, "2s").orderBy(TS).collect()
    assert [tuple(r) for r in out] == [
        (at(0), 4.0, None), (at(2), 4.25, 11.0), (at(4), 4.5, 12.0), (at(6), 4.75, 13.0), (at(8), 5.0, 14.0),
    ]


def test_tolerance_is_inclusive_to_the_microsecond(spark):
    left = series(spark, [(at(10), 1), (at(20), 2)], "i int")
    right = series(spark, [(at(8), 1.0), (at(18) - timedelta(microseconds=1), 2.0)], "v double")
    got = {r.i: r.v for r in op.asof_join(left, right, TS, "2s").collect()}
    assert got == {1: 1.0, 2: None}


def test_newest_row_wins_even_if_its_value_is_null(spark):
    left = series(spark, [(at(10), 1)], "i int")
    right = series(spark, [(at(8), 1.0, 5), (at(9), None, 6)], "v double, w int")
    assert tuple(op.asof_join(left, right, TS, "5s").first())[2:] == (None, 6)


def test_last_of_equal_times_by_tie(spark):
    left = series(spark, [(at(10), 1)], "i int")
    right = series(spark, [(at(9), 3.0, 1), (at(9), 1.0, 2)], "v double, seq int")
    assert op.asof_join(left, right, TS, "5s", tie=["seq"]).first().v == 1.0
    assert op.asof_join(left, right, TS, "5s").first().v == 3.0


def test_null_times_never_match_and_left_rows_stay(spark):
    left = series(spark, [(None, 1), (at(1), 2), (at(1), 2)], "i int")
    right = series(spark, [(None, 9.0), (at(1), 1.0)], "v double")
    got = sorted(((r.i, r.v) for r in op.asof_join(left, right, TS, "5s").collect()), key=str)
    assert got == [(1, None), (2, 1.0), (2, 1.0)]


def test_name_taken_gets_a_suffix(spark):
    left = series(spark, [(at(1), 1.0)], "v double")
    right = series(spark, [(at(1), 2.0)], "v double")
    assert op.asof_join(left, right, TS).first().asDict() == {TS: at(1), "v": 1.0, "v_right": 2.0}


def brute(left, right, tolerance):
    out = {}
    for i, (t, _) in enumerate(left):
        near = [(rt, v) for rt, v in right if t and rt and timedelta(0) <= t - rt <= tolerance]
        out[i] = max(near)[1] if near else None
    return out


@pytest.mark.parametrize("rows_per_chunk", [10**6, 60, 9])
@pytest.mark.parametrize("crowd", [0.0, 0.4])
def test_against_brute_force_whatever_the_chunks(spark, chunked, rows_per_chunk, crowd):
    chunked(rows_per_chunk)
    rnd = random.Random(rows_per_chunk * 7 + int(crowd * 10))

    def some(n):
        rows = []
        for i in range(n):
            t = BASE + timedelta(microseconds=rnd.randrange(600_000_000))
            if rnd.random() < crowd:
                t = at(300)  # one instant holds a good part of all rows
            rows.append((None if rnd.random() < 0.03 else t, i))
        return rows

    left, right = some(250), some(250)
    for tolerance in (0, 3, 90):
        got = op.asof_join(series(spark, left, "i int"), series(spark, right, "v int"), TS, tolerance, tie=["v"])
        assert {r.i: r.v for r in got.collect()} == brute(left, right, timedelta(seconds=tolerance))


@pytest.mark.parametrize("rows_per_chunk", [10**6, 40])
def test_by_key(spark, chunked, rows_per_chunk):
    chunked(rows_per_chunk)
    rnd = random.Random(5)
    when = lambda: 150_000_000 if rnd.random() < 0.4 else rnd.randrange(300_000_000)
    make = lambda: [(rnd.choice(["a", "b", None]), BASE + timedelta(microseconds=when()), i) for i in range(200)]
    left, right = make(), make()
    got = op.asof_join(
        spark.createDataFrame(left, f"k string, {TS} timestamp_ntz, i int"),
        spark.createDataFrame(right, f"k string, {TS} timestamp_ntz, v int"),
        TS, "9s", keys=["k"], tie=["v"],
    )
    got = {r.i: r.v for r in got.collect()}
    for key in ("a", "b", None):
        mine = [(t, i) for k, t, i in left if k == key]
        want = brute(mine, [(t, v) for k, t, v in right if k == key], timedelta(seconds=9))
        assert {i: got[i] for _, i in mine} == {mine[j][1]: v for j, v in want.items()}


def test_regular_grid_starts_at_the_first_time_and_may_miss_the_last(spark):
    df = series(spark, [(at(0.5), 1.0), (at(5), 2.0)], "v double")
    out = op.regularize(df, TS, "2s").orderBy(TS).collect()
    assert [tuple(r) for r in out] == [(at(0.5), 1.0), (at(2.5), None), (at(4.5), None)]


def test_regularize_by_key_gives_each_key_its_own_grid(spark):
    df = spark.createDataFrame(
        [("a", at(0), 1.0), ("a", at(4), 2.0), ("b", at(1), 3.0)], f"k string, {TS} timestamp_ntz, v double"
    )
    out = op.regularize(df, TS, "2s", keys=["k"]).orderBy("k", TS).collect()
    assert [tuple(r) for r in out] == [("a", at(0), 1.0), ("a", at(2), None), ("a", at(4), 2.0), ("b", at(1), 3.0)]


def test_fill_labels_by_the_first_column_and_fills_each_column(spark):
    primary = series(spark, [(at(0), None, 1.0), (at(10), 2.0, None), (at(20), None, None)], "a double, b double")
    spare = series(spark, [(at(-1), 7.0, 8.0), (at(9), 7.5, 8.5)], "a double, b double")
    out = op.fill_from_secondary(primary, spare, TS, tolerance="1.5s", labels=("uw", "ship")).orderBy(TS).collect()
    assert [tuple(r) for r in out] == [
        (at(0), 7.0, 1.0, "ship"), (at(10), 2.0, 8.5, "uw"), (at(20), None, None, "ship"),
    ]


def test_empty_feeds_add_no_columns(spark):
    a = series(spark, [(at(0), 1.0)], "a double")
    b = series(spark, [], "b double")
    assert op.align_series([("a", a), ("b", b)], "2s").columns == [TS, "a"]
    assert op.align_series([("b", b)], "2s").count() == 0
    assert op.regularize(b, TS).count() == 0


def test_alignment_does_not_depend_on_chunks(spark, chunked):
    rnd = random.Random(11)
    feeds = []
    for name in ("a", "b", "c"):
        rows = [(BASE + timedelta(microseconds=rnd.randrange(200_000_000)), float(i)) for i in range(150)]
        feeds.append((name, series(spark, rows, f"{name} double")))
    results = []
    for n in (10**6, 30):
        chunked(n)
        results.append(sorted(map(tuple, op.align_series(feeds, "1s", tolerance="3s").collect())))
    assert results[0] == results[1]


def test_plan_has_one_window_for_all_feeds_and_no_python(spark, chunked):
    chunked(50)
    feeds = [(n, series(spark, [(at(i), float(i)) for i in range(200)], f"{n} double")) for n in "abc"]
    feeds = [(n, df.withColumn(n, F.col(n) + 1)) for n, df in feeds]
    plan = op.align_series(feeds, "1s")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [last(") == 1
    assert "Python" not in plan
