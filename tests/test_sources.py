from datetime import datetime, timedelta

import pytest

from tidelane import sources as src
from tidelane.operators.chunks import ROWS_PER_CHUNK

TS = "datetime_utc"
GOOD = "t1= 20.1, c1= 4.5, s= 31.2, t2= 20.3, lat= 12 15.2500 N, lon= 033 48.7500 W, hms=120000 dmy=120825"

LOG = [
    "header without pairs",
    "t1= 1.0, c1= 2.0, s= 3.0",  # no time yet: stays null
    GOOD,
    "t1= 20.2, c1= 4.5, s= 31.2, hms=120002 dmy=12082$*",  # damaged last digit
    "t1= 20.3, c1= 4.5, s= 31.2",  # no time: two seconds on
    "t1= 20.4, c1= 4.5, s= 31.2, hms=xx dmy=120825",
    "t1= 20.5, c1= 4.5, s= 31.2, hms=235960 dmy=120825",  # next day
    "t1= 20.6, c1= 4.5, s= 31.2, hms=120000 dmy=121325",  # month 13
    "t1= 20.7, c1= 4.5, s= 31.2, lat= 41.5",  # no hemisphere: dropped
    "t1= 20.8, s= 31.2",  # no conductivity: dropped
    "t1= 1.2.3, c1= 4.5, s= 31.2",  # unreadable: dropped
    "t1= 20.9, t1= 1.2.3, c1= 4.5, s= 31.2, t2= 9..9",  # last readable value stays
    "t1= 21.0, c1= 4.5, s= 31.2, hms=120060 dmy=311225",
    "t1= 21.1, c1= 4.5, s= 31.2, hms=1159 dmy=120825",  # no seconds
]


def d(h, m, s, day=12, month=8, year=2025):
    return datetime(year, month, day, h, m, s)


def test_log(spark, tmp_path):
    (tmp_path / "ship.cap").write_text("\n".join(LOG) + "\n")
    rows, rejects = src.ingest_keyvalue_log(spark, str(tmp_path / "ship.cap"))
    got = rows.orderBy("position").collect()
    assert [(r.t1, r.datetime, r.ts) for r in got] == [
        (1.0, None, None),
        (20.1, d(12, 0, 0), d(12, 0, 0)),
        (20.2, d(12, 0, 2), d(12, 0, 2)),
        (20.3, None, d(12, 0, 4)),
        (20.4, None, d(12, 0, 6)),
        (20.5, d(0, 0, 0, 13), d(0, 0, 0, 13)),
        (20.6, None, d(0, 0, 2, 13)),
        (20.9, None, d(0, 0, 4, 13)),
        (21.0, d(12, 1, 0, 31, 12), d(12, 1, 0, 31, 12)),
        (21.1, None, d(12, 1, 2, 31, 12)),
    ]
    assert (got[1].latitude, got[1].longitude) == (pytest.approx(12 + 15.25 / 60), pytest.approx(-(33 + 48.75 / 60)))
    assert [(r.reject_reason, r.dropped) for r in rejects.orderBy("position").collect()] == [
        ("invalid date or time", False),
        ("no hemisphere in lat", True),
        ("missing c1", True),
        ("unreadable value for t1", True),
        ("unreadable value for t1", False),
        ("invalid date or time", False),
    ]


def test_log_without_rows(spark, tmp_path):
    (tmp_path / "a.cap").write_text("nothing\n")
    rows, rejects = src.ingest_keyvalue_log(spark, str(tmp_path / "a.cap"))
    assert rows.count() == 0 and rejects.count() == 0


def test_log_over_many_splits_fills_as_one_file(spark, tmp_path):
    lines, want, last = [], [], None
    for i in range(400):
        t = datetime(2025, 8, 12) + timedelta(seconds=7 * i)
        known = i % 90 == 17
        last = t if known else (last + timedelta(seconds=2) if last else None)
        want.append(last)
        stamp = t.strftime(" hms=%H%M%S dmy=%d%m%y") if known else ""
        lines.append(f"t1= {i}.5, c1= 4.5, s= 31.2{stamp}")
    (tmp_path / "a.cap").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows, _ = src.ingest_keyvalue_log(spark, str(tmp_path / "a.cap"))
        assert rows.select("block").distinct().count() > 10
        assert [r.ts for r in rows.orderBy("t1").collect()] == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("rows_per_chunk", [10**6, 13])
def test_time_fill_by_order_column(spark, rows_per_chunk):
    base = datetime(2025, 1, 1)
    known = {5: base, 6: base + timedelta(hours=1), 70: base + timedelta(hours=9)}
    df = spark.createDataFrame([(i, known.get(i)) for i in range(100)], "i int, t timestamp_ntz")
    spark.conf.set(ROWS_PER_CHUNK, str(rows_per_chunk))
    try:
        got = [r.ts for r in src.fill_time_by_increment(df, "t", "i").orderBy("i").collect()]
    finally:
        spark.conf.unset(ROWS_PER_CHUNK)
    last, want = None, []
    for i in range(100):
        last = known[i] if i in known else (last + timedelta(seconds=2) if last else None)
        want.append(last)
    assert got == want


def test_track(spark, tmp_path):
    (tmp_path / "t.gpx").write_text(
        """<?xml version="1.0"?><gpx xmlns="http://www.topografix.com/GPX/1/1"><trk><trkseg>
        <trkpt lat="41.5" lon="-70.7"><ele>1</ele><time>2025-08-13T12:00:00Z</time></trkpt></trkseg><trkseg>
        <trkpt lat="41.6" lon="-70.8"><time>2025-08-13T14:00:01.500+02:00</time></trkpt></trkseg></trk>
        <trk><trkseg><trkpt lat="41.7" lon="-70.9"></trkpt></trkseg></trk></gpx>"""
    )
    got = [tuple(r) for r in src.ingest_track_points(spark, str(tmp_path / "t.gpx")).orderBy("latitude").collect()]
    assert got == [
        (datetime(2025, 8, 13, 12), 41.5, -70.7), (datetime(2025, 8, 13, 12, 0, 1, 500000), 41.6, -70.8), (None, 41.7, -70.9),
    ]


def test_interval_csv_is_strict(spark, tmp_path):
    (tmp_path / "a.csv").write_text("start_time,end_time,qc_flag,comment\n2025-08-13 04:11:00,2025-08-13 05:02:00,4,pump stopped")
    assert tuple(src.read_intervals(spark, str(tmp_path / "a.csv")).first())[:2] == (d(4, 11, 0, 13), d(5, 2, 0, 13))
    (tmp_path / "b.csv").write_text("start_time,end_time,qc_flag,comment\n13/08/2025,2025-08-13 05:02:00,4,x\n")
    with pytest.raises(Exception):
        src.read_intervals(spark, str(tmp_path / "b.csv")).collect()
    with pytest.raises(Exception):
        src.read_intervals(spark, str(tmp_path / "none.csv"))


def test_instrument_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("datetime,O2_calc,extra\n2025-08-13 09:27:00.5,250.5,1\n2025-08-13 09:27:02,,2\n")
    got = [tuple(r) for r in src.read_instrument_csv(spark, str(tmp_path / "a.csv")).orderBy(TS).collect()]
    assert got == [(datetime(2025, 8, 13, 9, 27, 0, 500000), 250.5), (d(9, 27, 2, 13), None)]
    (tmp_path / "b.csv").write_text("datetime,O2_calc\nyesterday,1\n")
    with pytest.raises(Exception):
        src.read_instrument_csv(spark, str(tmp_path / "b.csv")).collect()
    lenient = src.read_csv_lenient_time(spark, str(tmp_path / "b.csv"))
    assert lenient.first().datetime is None


def test_epoch_table(spark, tmp_path):
    spark.createDataFrame([(1755000000.75, 1)], f"{TS} double, v int").write.parquet(str(tmp_path / "p"))
    t = datetime(2025, 8, 12, 12)
    assert src.read_epoch_table(spark, str(tmp_path / "p")).first()[0] == t + timedelta(microseconds=750000)
    assert src.read_epoch_table(spark, str(tmp_path / "p"), truncate=True).first()[0] == t
    (tmp_path / "c.csv").write_text(f"{TS},v\n1755000000,1\n")
    assert src.read_epoch_table(spark, str(tmp_path / "c.csv"), "csv", header="true").first()[0] == t
    assert src.read_epoch_table(spark, str(tmp_path / "p"), time_col="other").dtypes[0][1] == "double"


def test_products(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2025, 8, 13, 1, 2, 3, 900000), 2, None)], f"{TS} timestamp_ntz, f tinyint, v double")
    done = src.write_products(df, {"parquet_path": str(tmp_path / "p"), "csv_path": str(tmp_path / "c")})
    assert done == ["parquet_path", "csv_path"]
    assert src.read_parquet_series(spark, str(tmp_path / "p")).collect() == df.collect()
    text = spark.read.text(str(tmp_path / "c")).collect()
    assert {r.value for r in text} == {f"{TS},f,v", "2025-08-13T01:02:03,2,"}
    assert src.write_products(df, {}) == []
