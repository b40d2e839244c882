import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelane import operators as op
from tidelane.operators import intervals

BASE = datetime(2025, 8, 13)
TS = "datetime_utc"


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def frames(spark, seconds, periods):
    df = spark.createDataFrame([(None if s is None else at(s), i, 2) for i, s in enumerate(seconds)], f"{TS} timestamp_ntz, i int, flag int")
    iv = spark.createDataFrame(
        [(at(a), at(b), 9, "x") for a, b in periods], "start_time timestamp_ntz, end_time timestamp_ntz, qc_flag int, comment string"
    )
    return df, iv


def test_ends_overlaps_and_empty_periods(spark):
    seconds = [0, 10, 15, 20, 25, 30, 40, None]
    df, iv = frames(spark, seconds, [(10, 20), (20, 30), (12, 14), (40, 40), (50, 45)])
    flags = lambda closed: [
        r.flag for r in op.flag_intervals(df, iv, ["flag"], closed).orderBy("i").collect()
    ]
    assert flags("both") == [2, 4, 4, 4, 4, 4, 4, 2]
    assert flags("neither") == [2, 2, 4, 2, 4, 2, 2, 2]


def test_flag_type_and_other_columns(spark):
    df, iv = frames(spark, [0, 5], [(4, 6)])
    out = op.flag_intervals(df.withColumn("other", F.lit(3)), iv, ["flag", "other"])
    assert out.columns == [TS, "i", "flag", "other"] and dict(out.dtypes)["flag"] == "tinyint"
    assert [tuple(r)[2:] for r in out.orderBy("i").collect()] == [(2, 3), (4, 4)]


def test_no_periods(spark):
    df, iv = frames(spark, [0, 5], [])
    assert op.flag_intervals(df, iv, ["flag"]).where("flag = 4").count() == 0
    assert op.period_extracts(df, iv).count() == 0


@pytest.mark.parametrize("rows_per_chunk", [10**6, 25])
@pytest.mark.parametrize("closed", ["both", "neither"])
def test_flags_agree_with_brute_force(spark, chunked, rows_per_chunk, closed):
    chunked(rows_per_chunk)
    rnd = random.Random(rows_per_chunk)
    seconds = [rnd.choice([500, rnd.randrange(1000)]) for _ in range(200)]
    periods = [(s, s + rnd.choice([0, 1, 7, 90])) for s in (rnd.randrange(1000) for _ in range(20))] + [(500, 520), (480, 500)]
    df, iv = frames(spark, seconds, periods)
    inside = lambda s: any(a <= s <= b if closed == "both" else a < s < b for a, b in periods)
    want = [4 if inside(s) else 2 for s in seconds]
    out = op.flag_intervals(df, iv, ["flag"], closed).orderBy("i").collect()
    assert [r.flag for r in out] == want


@pytest.mark.parametrize("rows_per_chunk", [10**6, 25])
def test_extracts_repeat_rows_of_overlapping_periods(spark, chunked, rows_per_chunk):
    chunked(rows_per_chunk)
    rnd = random.Random(8)
    seconds = [rnd.randrange(4000) for _ in range(150)]
    periods = [(s, s + rnd.choice([0, 3, 400, 2500])) for s in rnd.sample(range(4000), 15)] + [(-9000, 9000)]
    df, iv = frames(spark, seconds, periods)
    out = op.period_extracts(df, iv, "20s").collect()
    numbered = list(enumerate(sorted(periods), 1))
    want = {(i, n) for i, s in enumerate(seconds) for n, (a, b) in numbered if a - 20 <= s <= b + 20}
    assert len(out) == len(want) and {(r.i, r.period_no) for r in out} == want


def test_extracts_numbered_as_listed_with_comment(spark):
    df, iv = frames(spark, [0, 50, 100], [(90, 110), (0, 10)])
    listed = iv.withColumn("no", F.when(F.col("start_time") > at(50), 1).otherwise(2)).withColumn("comment", F.concat(F.lit("c"), "no"))
    out = op.period_extracts(df, listed, 0, order_by="no", carry=["comment"]).orderBy("i").collect()
    assert [(r.i, r.period_no, r.comment) for r in out] == [(0, 2, "c2"), (2, 1, "c1")]


def test_one_long_period_over_thousands_of_short_ones(spark, chunked):
    chunked(500)
    df, iv = frames(spark, list(range(0, 8000, 4)), [(-5, 9000), *((s, s + 1) for s in range(0, 8000, 2))])
    out = op.period_extracts(df, iv, 0)
    assert out.count() == 2000 * 2 and out.where("period_no = 1").count() == 2000
    assert op.flag_intervals(df, iv, ["flag"]).where("flag = 4").count() == 2000


@pytest.mark.parametrize("held", [10**5, 3])
def test_extracts_of_a_crowd_are_dealt_to_tasks_by_their_pairs(spark, monkeypatch, held):
    for name, value in {"PAIRS_PER_TASK": 1000, "PERIODS_PER_BLOCK": 64, "BROADCAST_SPANS": held}.items():
        monkeypatch.setattr(intervals, name, value, raising=False)
    df, iv = frames(spark, [*(i % 60 for i in range(200)), 5000, None], [*((i % 50, i % 50 + 30) for i in range(100)), (4990, 5010)])
    df = df.unionAll(df.where("i < 40")).coalesce(1)  # repeated rows stay as often
    periods = sorted([*((i % 50, i % 50 + 30) for i in range(100)), (4990, 5010)])
    want = sorted((i, n) for i in [*range(200), *range(40)] for n, (a, b) in enumerate(periods, 1) if a - 20 <= i % 60 <= b + 20)
    out = op.period_extracts(df, iv, "20s").withColumn("part", F.spark_partition_id()).collect()
    assert len(want) > 15_000 and sorted((r.i, r.period_no) for r in out) == sorted([*want, (200, 101)])
    parts = [r.part for r in out]
    assert max(parts.count(p) for p in set(parts)) <= 8000
