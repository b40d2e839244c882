import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelane import operators as op
from tidelane.operators.chunks import plan_chunks
from tidelane.operators.quantiles import exact_median, nearest_rank, order_statistics

BASE = datetime(2025, 1, 1)
TS = "datetime_utc"


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def times(spark, seconds, extra=None):
    if extra is None:
        return spark.createDataFrame([(None if s is None else at(s),) for s in seconds], f"{TS} timestamp_ntz")
    return spark.createDataFrame(
        [(None if s is None else at(s), x) for s, x in zip(seconds, extra)], f"{TS} timestamp_ntz, x int"
    )


def random_rows(seed, n=220, crowd=0.35):
    rnd = random.Random(seed)
    seconds = [150.0 if rnd.random() < crowd else rnd.randrange(300_000_000) / 1e6 for _ in range(n)]
    return seconds, list(range(n))


@pytest.mark.parametrize("rows_per_chunk", [10**6, 40, 7])
def test_previous_row_with_ties(spark, chunked, rows_per_chunk):
    chunked(rows_per_chunk)
    seconds, ids = random_rows(1)
    df = times(spark, [*seconds, None], [*ids, 999])
    got = {r.x: r.p for r in op.with_previous(df, TS, {"p": "x"}, tie=["x"]).collect()}
    order = [i for _, i in sorted(zip(seconds, ids))]
    assert got == {999: None, order[0]: None, **dict(zip(order[1:], order))}


@pytest.mark.parametrize("rows_per_chunk", [10**6, 20])
def test_identical_copies_are_not_lost(spark, chunked, rows_per_chunk):
    chunked(rows_per_chunk)
    df = times(spark, [1.0] * 150 + [float(i % 50) for i in range(100)])
    steps = [r.time_diff for r in op.lag_diff(df).collect()]
    assert len(steps) == 250 and steps.count(None) == 1 and steps.count(1.0) == 49 and steps.count(0.0) == 200


def test_row_numbers_of_copies(spark, chunked):
    from tidelane.operators.rolling import with_row_number

    chunked(20)
    df = times(spark, [1.0] * 150 + [float(i % 50) for i in range(100)])
    rows = with_row_number(df, TS).orderBy("__rn").collect()
    assert [r["__rn"] for r in rows] == list(range(250))
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)


@pytest.mark.parametrize("rows_per_chunk", [10**6, 15])
def test_gaps_and_regularity_against_plain_python(spark, chunked, rows_per_chunk):
    chunked(rows_per_chunk)
    seconds, _ = random_rows(2)
    df = times(spark, [*seconds, None])
    order = sorted(seconds)
    steps = [b - a for a, b in zip(order, order[1:])]
    gaps = sorted(r.gap for r in op.find_gaps(df, TS, "2s").collect())
    assert gaps == sorted(round(s * 1e6) for s in steps if s > 2)
    r = op.regularity_report(df).first()
    mean = sum(steps) / len(steps)
    std = (sum((s - mean) ** 2 for s in steps) / (len(steps) - 1)) ** 0.5
    assert r.intervals == len(steps) and r.mean_s == pytest.approx(mean) and r.std_s == pytest.approx(std)
    assert r.median_s == pytest.approx(sorted(steps)[len(steps) // 2])
    assert r.duplicates == len(seconds) - len(set(seconds))
    odd = sum(abs(s - mean) > 2 * std for s in steps)
    assert r.irregular == odd
    assert sum(x.n for x in op.irregular_intervals(df).collect()) == odd


def test_gap_limit_is_strict(spark):
    df = times(spark, [0, 5, 10.000001])
    assert [(r.prev_ts, r.curr_ts, r.gap) for r in op.find_gaps(df).collect()] == [(at(5), at(10.000001), 5_000_001)]


def test_equal_times_pass_the_monotonic_check(spark):
    df = times(spark, [0, 1, 1, 3, 2, 4], [0, 1, 2, 3, 4, 5])
    assert [r.x for r in op.non_monotonic(df, "x").collect()] == [4]


def test_single_row_and_empty_series(spark):
    for df in (times(spark, [1]), times(spark, [])):
        assert op.find_gaps(df).count() == 0
        assert op.series_completeness(df).count() == 0
        assert op.irregular_intervals(df).count() == 0
        assert op.sampling_interval(df).first().median_s is None


def test_completeness(spark):
    r = op.series_completeness(times(spark, [0, 1, 2, 3, 4, 20])).first()
    assert (r.time_range_s, r.median_s, r.expected_points, r.actual_points, r.large_gaps) == (20.0, 1.0, 20.0, 6, 1)
    assert r.completeness_pct == pytest.approx(30.0)
    assert op.series_completeness(times(spark, [1, 1, 1, 5])).count() == 0


def test_sampling_interval_steps_first_then_drops_incomplete_rows(spark):
    df = times(spark, [0, 1.9, 10, 13], [1, 2, None, 4])
    assert op.sampling_interval(df).first().median_s == 2.0  # whole seconds 1 and 3; the row at 10 is left out


def test_position_jumps(spark):
    df = spark.createDataFrame(
        [(at(0), 41.0, -70.0), (at(1), 41.0, -70.0), (at(2), 41.2, -70.0), (at(3), None, -70.0), (at(4), 41.21, -70.0)],
        f"{TS} timestamp_ntz, latitude double, longitude double",
    )
    out = op.position_jumps(df).collect()
    assert [(r[TS], round(r.distance_km, 6)) for r in out] == [(at(2), 22.2)]


def test_gap_context(spark):
    before = spark.createDataFrame(
        [(at(i), None if i == 20 else float(i)) for i in range(40)], f"{TS} timestamp_ntz, latitude double"
    )
    after = before.na.fill(-1.0)
    out = op.gap_context(before, after)
    assert out.groupBy("stage").count().collect().__len__() == 2 and out.count() == 42
    assert op.gap_context(after, after).count() == 0


@pytest.mark.parametrize("rows_per_chunk", [10**6, 11])
@pytest.mark.parametrize("window", [5, 4, 1])
def test_rolling_window(spark, chunked, rows_per_chunk, window):
    chunked(rows_per_chunk)
    seconds, ids = random_rows(3, 90)
    df = times(spark, [*seconds, *[None] * 30], [*ids, *range(1000, 1030)])  # no time: last, by tie
    got = {r.x: (r.x_mean, r.x_std) for r in op.rolling_deviation(df, ["x"], TS, window, tie=["x"]).collect()}
    order = [i for _, i in sorted(zip(seconds, ids))] + list(range(1000, 1030))
    for i, x in enumerate(order):
        part = order[max(0, i - window // 2) : i + (window - 1) // 2 + 1]
        mean = sum(part) / len(part)
        assert got[x][0] == pytest.approx(mean)
        if len(part) == 1:
            assert got[x][1] is None
        else:
            assert got[x][1] == pytest.approx((sum((v - mean) ** 2 for v in part) / (len(part) - 1)) ** 0.5)


def test_rolling_outliers_count_and_zero_deviation(spark):
    df = spark.createDataFrame(
        [(i, v) for i, v in enumerate([1.0, 1.0, 9.0, 1.0, 1.0, float("nan"), None, 2.0])], "i int, v double"
    )
    r = op.rolling_outliers(df, "i", ["v"], k=1.5).first()
    assert (r.outliers, r.percent) == (1, 12.5)
    assert op.rolling_outliers(df.limit(2), "i", ["v"], k=0.1).first().outliers == 0


def test_order_statistics_are_exact(spark):
    rnd = random.Random(4)
    values = [rnd.choice([rnd.gauss(0, 1e-9), rnd.gauss(5, 1e6), 3.25, -1e300, 1e300]) for _ in range(500)]
    df = spark.createDataFrame([("x", v, 1) for v in values] + [("one", 2.0, 3)], "item string, value double, weight long")
    out = order_statistics(df, [nearest_rank(q) for q in (0.0, 0.25, 0.5, 0.75, 1.0)])
    assert [v[0] for v in out["x"]] == [sorted(values)[int(499 * q + 0.5)] for q in (0.0, 0.25, 0.5, 0.75, 1.0)]
    assert out["one"] == [[2.0]] * 5
    assert exact_median(spark.createDataFrame([("x", 1, 2), ("x", 4, 2)], "item string, value long, weight long")) == 2.5


def test_chunks_are_even_and_split_a_crowded_instant(spark, chunked):
    chunked(100)
    df = spark.range(3000).selectExpr("case when id % 3 = 0 then 500 else id end as o", "id as t")
    plan = plan_chunks(spark, [df])
    sizes = [r["count"] for r in plan.place(df, "c", F.col("o"), F.col("t")).groupBy("c").count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 250
    single = plan_chunks(spark, [df.select("o")])
    assert len(single.hot) == 1


def test_session_zone_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            op.find_gaps(times(spark, [1, 2]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
