from datetime import datetime, timedelta

from tidelane import plans
from tidelane.plans.underway import PRODUCT_COLUMNS

BASE = datetime(2025, 8, 13, 9)
TS = "datetime_utc"


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def cruise(spark):
    make = lambda rows, cols: spark.createDataFrame(rows, f"{TS} timestamp_ntz, {cols}")
    periods = lambda rows: spark.createDataFrame(rows, "start_time timestamp_ntz, end_time timestamp_ntz, qc_flag int, comment string")
    return {
        "gps": make([(at(i), 41.5, -70.5) for i in range(60) if not 20 <= i < 30], "latitude double, longitude double"),
        "track": make([(at(i - 46), 41.6, -70.6) for i in range(60)], "latitude double, longitude double"),
        "tsg": make([(at(2 * i), 20.0, 4.5, 31.0 if i % 5 else 29.0) for i in range(30) if i != 10], "temp double, cond double, salinity double"),
        "log_rows": spark.createDataFrame([(at(19), 21.0, 4.6, 32.0)], "ts timestamp_ntz, t1 double, c1 double, s double"),
        "ph": make([(at(2 * i), -0.93, 9.5 if i == 3 else 8.0) for i in range(30)], "vrse double, ph_total double"),
        "ph_intervals": periods([(at(10), at(14), 4, "x")]),
        "rho": make([(at(2 * i), 1.0) for i in range(20)], "rho_ppb double"),
        "oxygen": make([(at(2 * i), 250.0) for i in range(30)], "oxygen_umol_kg double"),
        "shutdowns": periods([(at(40), at(44), 4, "x")]),
    }


def test_whole_product(spark, tmp_path):
    out = plans.process_underway(
        **cruise(spark), feed_dir=str(tmp_path / "feeds"), outputs={"parquet_path": str(tmp_path / "product")}
    )
    rows = {r[TS]: r for r in out["combined"].collect()}
    assert out["combined"].columns == [TS, *[c for cols in PRODUCT_COLUMNS.values() for c in cols], "ph_corrected"]
    assert len(rows) == 30
    assert rows[at(24)].latitude == 41.6 and rows[at(18)].latitude == 41.5
    assert (rows[at(20)].temperature, rows[at(20)].salinity, rows[at(20)].salinity_flag) == (21.0, 32.0, 2)
    assert rows[at(30)].salinity_flag == 4 and rows[at(32)].salinity_flag == 2
    assert [rows[at(s)].ph_flag for s in (4, 6, 8, 10, 12, 14, 16)] == [2, 4, 2, 4, 4, 4, 2]
    assert [rows[at(s)].temperature_flag for s in (40, 42, 44)] == [2, 4, 2]
    assert rows[at(42)].rho_ppb is None and rows[at(42)].rho_flag is None and rows[at(42)].ph_flag == 4
    assert abs(rows[at(2)].ph_corrected - 7.71) < 0.1
    assert spark.read.parquet(str(tmp_path / "product")).count() == 30
    assert out["validation"].where("not passed").count() == 0


def test_sources_of_patched_feeds(spark):
    c = cruise(spark)
    gps = plans.patch_gps(c["gps"], c["track"])
    assert {r.source: r["count"] for r in gps.groupBy("source").count().collect()} == {"gps": 51, "gpx": 9}
    tsg = plans.patch_tsg(c["tsg"], c["log_rows"])
    assert {r.source: r["count"] for r in tsg.groupBy("source").count().collect()} == {"uw": 29, "ship": 1}


def test_flagged_means(spark):
    c = cruise(spark)
    out = plans.flagged_minute_means(c["ph"], c["ph_intervals"]).first()
    assert out.ph_flag == "4"
    df = plans.flag_flow(plans.combine_underway({**c, "tsg": plans.patch_tsg(c["tsg"], c["log_rows"]), "ph": plans.flag_ph(c["ph"], c["ph_intervals"]),
                         "rho": c["rho"].selectExpr("*", "2 as rho_flag")}, -1.39, -0.001), c["shutdowns"])
    clean, raw = plans.clean_and_raw_means(df)
    assert "ph_flag" in clean.columns and "ph_flag" not in raw.columns
    assert clean.count() < raw.count() == 6
