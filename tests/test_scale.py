"""Plans that have to hold at any size: what is shuffled, what is carried, how long the plan is."""

import gzip
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelane import operators as op, sources as src
from tidelane.operators import asof, chunks, intervals, rolling
from tidelane.operators.keyed import keyed_median, keyed_order_statistics

BASE = datetime(2025, 3, 1)
TS = "datetime_utc"


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def tree(df):
    """The plan as it is run, without the local tables in it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# Intervals


def period_frame(spark, periods):
    return spark.createDataFrame([(at(a), at(b)) for a, b in periods], "start_time timestamp_ntz, end_time timestamp_ntz")


def flag_frame(spark, seconds):
    rows = [(None if s is None else at(s), i, 2, "lo", "hi") for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, f"{TS} timestamp_ntz, i int, flag int, lo string, hi string")


def inside(seconds, periods, closed):
    ordered, out = sorted(periods), []
    for s in seconds:
        out.append(s is not None and any(a <= s <= b if closed == "both" else a < s < b for a, b in ordered))
    return out


def test_few_intervals_move_no_row(spark):
    df, iv = flag_frame(spark, range(500)), period_frame(spark, [(3, 9), (8, 20), (50, 50)])
    flags = tree(op.flag_intervals(df, iv, ["flag"]))
    assert "Exchange hashpartitioning" not in flags and "Sort [" not in flags and "BroadcastHashJoin" in flags
    out = op.period_extracts(df, iv, 0)
    assert "lo" in out.columns and out.count() == 20 + 1
    held = out._jdf.queryExecution().optimizedPlan().toString()
    assert held.count("Repartition") == 0


@pytest.mark.parametrize("broadcast", [100_000, 0])
@pytest.mark.parametrize("closed", ["both", "neither"])
def test_thousands_of_short_and_one_long_interval(spark, chunked, monkeypatch, broadcast, closed):
    chunked(900)
    monkeypatch.setattr(intervals, "BROADCAST_SPANS", broadcast)
    rnd = random.Random(2)
    seconds = [rnd.choice([None, rnd.randrange(20_000), rnd.randrange(20_000) + 0.5]) for _ in range(2500)]
    short = [(s, s + rnd.choice([0, 1, 2, 5])) for s in (rnd.randrange(20_000) for _ in range(4000))]
    for periods in (short, [*short, (-5, 30_000)]):
        out = op.flag_intervals(flag_frame(spark, seconds), period_frame(spark, periods), ["flag"], closed).orderBy("i").collect()
        assert [r.flag == 4 for r in out] == inside(seconds, periods, closed)
        assert [r[TS] for r in out] == [None if s is None else at(s) for s in seconds]


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_intervals_of_a_key_flag_its_rows_only(spark, monkeypatch, broadcast):
    monkeypatch.setattr(intervals, "BROADCAST_SPANS", broadcast)
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.randrange(300)]), i) for i in range(400)]
    periods = [(rnd.choice(["a", "b", None]), s, s + rnd.choice([0, 3, 40])) for s in (rnd.randrange(300) for _ in range(25))]
    df = spark.createDataFrame([(k, None if s is None else at(s), i, 2) for k, s, i in rows], f"k string, {TS} timestamp_ntz, i int, flag int")
    iv = spark.createDataFrame([(k, at(a), at(b)) for k, a, b in periods], "k string, start_time timestamp_ntz, end_time timestamp_ntz")
    out = op.flag_intervals(df, iv, ["flag"], keys=["k"]).orderBy("i").collect()
    want = [s is not None and any(k == p and a <= s <= b for p, a, b in periods) for k, s, _ in rows]
    assert [r.flag == 4 for r in out] == want and [r.k for r in out] == [k for k, *_ in rows]


@pytest.mark.parametrize("rows_per_chunk", [10**6, 7])
@pytest.mark.parametrize("closed", ["both", "neither"])
def test_merged_spans_share_no_instant(spark, chunked, rows_per_chunk, closed):
    chunked(rows_per_chunk)
    rnd = random.Random(rows_per_chunk)
    spans = [(k, a, a + rnd.choice([0, 1, 3, 3, 40])) for k, a in ((rnd.choice(["x", None]), rnd.randrange(300)) for _ in range(120))]
    spans = [s for s in spans if closed == "both" or s[1] < s[2]]
    df = spark.createDataFrame(spans, "k string, lo long, hi long")
    got = sorted(map(tuple, intervals.merged_spans(df, closed, ["k"]).select("k", "lo", "hi").collect()), key=str)
    want = []
    for k in ("x", None):
        own = []
        for _, lo, hi in sorted((s for s in spans if s[0] == k), key=lambda s: s[1:]):
            if own and (lo <= own[-1][1] if closed == "both" else lo < own[-1][1]):
                own[-1][1] = max(own[-1][1], hi)
            else:
                own.append([lo, hi])
        want += [(k, lo, hi) for lo, hi in own]
    assert got == sorted(want, key=str)


# Rolling windows


def rolling_brute(rows, window):
    """``{id: (mean, deviation)}`` of rows ``(order, tie, id, value)``."""
    out, order = {}, sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(order):
        part = [x[3] for x in order[max(0, i - window // 2) : i + (window - 1) // 2 + 1]]
        out[r[2]] = statistics.fmean(part), statistics.stdev(part) if len(part) > 1 else None
    return out


@pytest.mark.parametrize("run_bits", [10, 1])
@pytest.mark.parametrize("rows_per_chunk", [10**6, 40, 3])
@pytest.mark.parametrize("window", [7, 2])
def test_rolling_windows_across_chunks_and_keys(spark, chunked, monkeypatch, run_bits, rows_per_chunk, window):
    chunked(rows_per_chunk)
    monkeypatch.setattr(rolling, "RUN_BITS", run_bits)
    rnd = random.Random(window)
    rows = [(rnd.choice(["a", "a", "b", None]), rnd.choice([None, 50, rnd.randrange(100)]), i, float(rnd.randrange(50))) for i in range(150)]
    rows += [("lone", 20, 150, 1.0)]
    df = spark.createDataFrame(rows, "k string, o long, id long, v double")
    got = {r.id: (r.v_mean, r.v_std) for r in op.rolling_deviation(df, ["v"], "o", window, tie=["id"], keys=["k"]).collect()}
    want = {}
    for k in ("a", "b", None, "lone"):
        want |= rolling_brute([(o, i, i, v) for key, o, i, v in rows if key == k], window)
    assert got.keys() == want.keys()
    for i, (mean, std) in want.items():
        assert got[i][0] == pytest.approx(mean) and (got[i][1] == pytest.approx(std) if std is not None else got[i][1] is None)


@pytest.mark.parametrize("window", [5, 4, 1])
def test_rolling_windows_over_identical_rows(spark, chunked, window):
    chunked(20)
    rows = [(1, 0.0)] * 3 + [(5, 7.0)] * 200 + [(6, 1.0), (7, 2.0)]
    df = spark.createDataFrame(rows, "o long, v double")
    got = sorted((r.o, r.v_mean, r.v_std or 0.0) for r in op.rolling_deviation(df, ["v"], "o", window).collect())
    want = rolling_brute([(o, i, i, v) for i, (o, v) in enumerate(rows)], window)
    for g, w in zip(got, sorted((rows[i][0], m, s or 0.0) for i, (m, s) in want.items()), strict=True):
        assert g == pytest.approx(w)


def test_rolling_windows_have_one_full_exchange(spark, chunked):
    chunked(100)
    df = spark.range(1000).selectExpr("id as o", "cast(id as double) as v", "'payload' as text")
    plan = tree(op.rolling_deviation(df, ["v"], "o", 5, tie=["o"]).where("v >= 0"))
    full = [x for x in plan.split("Final Plan ==")[1].split("== Initial Plan")[0].split("\n") if "Exchange hashpartitioning" in x and "Reused" not in x]
    # By chunk, and by run of chunks for the few rows at the chunks' edges; the rows' branch reuses the first.
    assert len(full) <= 3 and "ReusedExchange" in plan


# As-of by key


def test_keyed_rows_are_carried_only_to_chunks_with_left_rows(spark, chunked, monkeypatch):
    chunked(100)
    rnd = random.Random(1)
    keys, span = 2000, 10_000
    left = [(k, at(rnd.randrange(span)), k) for k in range(keys)]  # one left row a key
    right = [(k, at(rnd.randrange(span)), i) for i, k in enumerate([*range(keys)] * 9)]
    spy, made = [], asof._carried

    def count(i, rows, probes, names, plan, tol):
        out = made(i, rows, probes, names, plan, tol)
        spy.append((out.count(), plan.last + 1))
        return out

    monkeypatch.setattr(asof, "_carried", count)
    out = op.asof_join(
        spark.createDataFrame(left, f"k int, {TS} timestamp_ntz, l int"),
        spark.createDataFrame(right, f"k int, {TS} timestamp_ntz, v int"), TS, "30d", keys=["k"], tie=["v"],
    )
    got = {r.k: r.v for r in out.collect()}
    for k, t, _ in left:
        earlier = [(rt, v) for rk, rt, v in right if rk == k and rt <= t] if k % 100 == 0 else None
        if earlier is not None:
            assert got[k] == (max(earlier)[1] if earlier else None)
    assert spy[0][1] >= 190 and spy[0][0] <= keys


# Order statistics by key


@pytest.mark.parametrize("rows_per_chunk", [10**6, 60])
def test_medians_of_many_keys_and_one_hot_key(spark, chunked, rows_per_chunk):
    chunked(rows_per_chunk)
    rnd = random.Random(5)
    values = {("hot" if rnd.random() < 0.4 else rnd.choice([None, *map(str, range(200))]), rnd.randrange(-400, 400)): rnd.randrange(1, 4) for _ in range(2500)}
    df = spark.createDataFrame([(k, v, w) for (k, v), w in values.items()], "k string, value long, weight long")
    flat = {}
    for (k, v), w in values.items():
        flat.setdefault(k, []).extend([v] * w)
    assert {r.k: r.median for r in keyed_median(df, ["k"]).collect()} == {k: statistics.median(v) for k, v in flat.items()}
    out = keyed_order_statistics(df, ["k"], {"least": lambda n: F.lit(0), "last": lambda n: n - 1, "third": lambda n: F.least(F.lit(2), n - 1)})
    got = {r.k: (r.least, r.last, r.third) for r in out.collect()}
    assert got == {k: (min(v), max(v), sorted(v)[min(2, len(v) - 1)]) for k, v in flat.items()}


@pytest.mark.parametrize("rows_per_chunk", [10**6, 25])
def test_reports_by_key_equal_reports_of_each_series(spark, chunked, rows_per_chunk):
    chunked(rows_per_chunk)
    rnd = random.Random(9)
    rows = [(rnd.choice(["a", "b", None]), at(rnd.choice([rnd.randrange(500), 77])), float(i)) for i in range(160)] + [("one", at(3), 0.0), ("none", None, 0.0)]
    df = spark.createDataFrame(rows, f"k string, {TS} timestamp_ntz, v double")
    near = lambda row: [round(x, 6) if isinstance(x, float) else x for x in row]
    for report in (op.regularity_report, op.series_completeness, op.irregular_intervals):
        got = sorted((near(r) for r in report(df, TS, keys=["k"]).collect()), key=str)
        want = []
        for k in ("a", "b", None, "one", "none"):
            own = df.where(F.col("k").eqNullSafe(F.lit(k)))
            want += [[k, *near(r)] for r in report(own, TS).collect()]
        assert got == sorted(want, key=str)


# Chunk plans of two levels


@pytest.fixture
def two_levels(monkeypatch):
    monkeypatch.setattr(chunks, "LITERAL_CUTS", 3)
    monkeypatch.setattr(chunks, "COARSE", 4)


def test_two_levels_cut_like_one(spark, chunked, two_levels):
    chunked(50)
    df = spark.range(3000).selectExpr("case when id % 3 = 0 then 500 else id end as o", "id as t")
    for frame, tie in ((df, F.col("t")), (df.select("o"), None), (df.where("o <> 500").select("o"), None)):
        plan = chunks.plan_chunks(spark, [frame])
        assert plan.fine is not None and len(plan.starts) <= 4 and plan.last >= 30
        rows = plan.place(frame, "c", F.col("o"), tie, end="e")
        got = rows.groupBy("c").agg(F.count("*").alias("n"), F.min("o").alias("lo"), F.max("o").alias("hi"), F.min("e").alias("e")).orderBy("c").collect()
        assert sum(r.n for r in got) == frame.count() and got[-1].c == plan.last
        assert all(a.hi <= b.lo and a.e <= b.lo for a, b in zip(got, got[1:])) or tie is not None
        assert max(r.n for r in got if r.c not in plan.hot) <= 200
        if plan.hot:
            assert {r.lo for r in got if r.c in plan.hot} == {500}
    assert plan.place(spark.createDataFrame([(None,)], "o long"), "c", F.col("o")).first().c == 0


def test_operators_with_two_levels(spark, chunked, two_levels):
    chunked(9)
    rnd = random.Random(3)
    rows = [(rnd.randrange(300) if rnd.random() < 0.7 else 100, i, float(rnd.randrange(9))) for i in range(300)]
    df = spark.createDataFrame([(at(o), i, v) for o, i, v in rows], f"{TS} timestamp_ntz, i long, v double")
    got = {r.i: r.v_mean for r in op.rolling_deviation(df, ["v"], TS, 5, tie=["i"]).collect()}
    assert got == pytest.approx({i: m for i, (m, _) in rolling_brute([(o, i, i, v) for o, i, v in rows], 5).items()})
    order = [i for _, i in sorted((o, i) for o, i, _ in rows)]
    prior = {r.i: r.p for r in op.with_previous(df, TS, {"p": "i"}, tie=["i"]).collect()}
    assert prior == dict(zip(order, [None, *order]))
    left = df.select(TS, F.col("i").alias("l"))
    joined = {r.l: r.i for r in op.asof_join(left, df, TS, "4s", tie=["i"]).collect()}
    assert joined == {i: max((b, j) for b, j, _ in rows if o - 4 <= b <= o)[1] for o, i, _ in rows}
    gaps = sorted(r.gap for r in op.find_gaps(df, TS, "2s").collect())
    seen = sorted({o for o, *_ in rows})
    assert gaps == sorted((b - a) * 10**6 for a, b in zip(seen, seen[1:]) if b - a > 2)
    flat = op.regularize(df, TS, "2s", tie=["i"])
    assert flat.count() == (max(seen) - min(seen)) // 2 + 1


def test_plan_does_not_grow_with_the_chunks(spark, chunked, two_levels):
    df, sizes = spark.range(4000).selectExpr("id as o", "id as v"), []
    for n in (100, 10):
        chunked(n)
        sizes.append(len(op.with_previous(df, "o", {"p": "v"})._jdf.queryExecution().logical().toString()))
    assert abs(sizes[0] - sizes[1]) < 400


# Logs that cannot be split


@pytest.mark.parametrize("piece_lines", [10**6, 37, 1])
def test_compressed_logs_in_pieces(spark, tmp_path, piece_lines):
    want = {}
    for f in range(2):
        lines, last = [], None
        for i in range(200):
            t, known = at(11 * i + f), i % 60 == 23
            if i % 17 == 5:
                lines.append("t1= 1.0, no more")
                continue
            last = t if known else (last + timedelta(seconds=2) if last else None)
            want[f * 1000 + i + 0.5] = last
            lines.append(f"t1= {f * 1000 + i}.5, c1= 4.5, s= 31.2" + (t.strftime(" hms=%H%M%S dmy=%d%m%y") if known else ""))
        with gzip.open(tmp_path / f"{f}.cap.gz", "wt") as out:
            out.write("\n".join(lines) + "\n")
    rows, rejects = src.ingest_keyvalue_log(spark, str(tmp_path / "*.gz"), piece_lines=piece_lines)
    assert {r.t1: r.ts for r in rows.collect()} == want
    assert rejects.count() == 24 and rows.select("block").distinct().count() == 1
