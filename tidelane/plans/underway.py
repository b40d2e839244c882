"""Composite jobs: from the raw feeds of a cruise to one flagged product."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelane.functions.chemistry import add_corrected_ph
from tidelane.functions.time import time_shift
from tidelane.operators.asof import align_series, regularize_filled
from tidelane.operators.buckets import bucket_by_type, bucket_mean
from tidelane.operators.columns import select_as
from tidelane.operators.flags import (
    default_flag,
    drop_flagged,
    flag_tsg,
    null_flag_where_missing,
    null_flag_where_nan,
    threshold_flag,
)
from tidelane.operators.intervals import flag_intervals
from tidelane.operators.validate import check_feed, raise_failed, validate_feeds
from tidelane.session import new_shared_path
from tidelane.sources.sinks import write_products
from tidelane.sources.tables import read_epoch_table, read_intervals

TS = "datetime_utc"

# Columns each feed gives to the combined product, in order.
PRODUCT_COLUMNS = {
    "gps": ["latitude", "longitude"],
    "tsg": ["temperature", "temperature_flag", "salinity", "salinity_flag"],
    "ph": ["vrse", "ph_flag"],
    "rho": ["rho_ppb", "rho_flag"],
    "oxygen": ["oxygen_umol_kg"],
}
# Value column and its flag.
FLAG_OF = {
    "ph_corrected": "ph_flag",
    "salinity": "salinity_flag",
    "temperature": "temperature_flag",
    "rho_ppb": "rho_flag",
}
FLOW_FLAGS = ["temperature_flag", "salinity_flag", "ph_flag", "rho_flag"]


def patch_gps(
    gps: DataFrame, track: DataFrame, step: str | int | float = "1s", clock_offset: str | int | float = "46s",
    tolerance: str | int | float = 1.5, tie: Sequence[str] = (), track_tie: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """GPS on a regular grid (of each key), holes filled from a track whose clock is behind by ``clock_offset``."""
    shifted = time_shift(track.select(*keys, TS, "latitude", "longitude", *track_tie), TS, clock_offset)
    return regularize_filled(
        gps, shifted, TS, ["latitude", "longitude"], step, tolerance, tolerance, ("gps", "gpx"), tie, track_tie, keys
    )


def patch_tsg(
    tsg: DataFrame, log_rows: DataFrame, step: str | int | float = "2s", tolerance: str | int | float = 2.5,
    grid_tolerance: str | int | float = 1.5, keys: Sequence[str] = (),
) -> DataFrame:
    """Underway thermosalinograph on a regular grid (of each key), holes filled from the ship's log, flagged."""
    own = tsg.select(*keys, TS, F.col("temp").alias("temperature"), "cond", "salinity")
    ship = select_as(log_rows, {**{k: k for k in keys}, "ts": TS, "t1": "temperature", "c1": "cond", "s": "salinity"})
    return flag_tsg(regularize_filled(
        own, ship, TS, ["temperature", "cond", "salinity"], step, grid_tolerance, tolerance, ("uw", "ship"), keys=keys
    ))


def flag_ph(ph: DataFrame, intervals: DataFrame, value: str = "ph_total", limit: float = 9.0, flag: str = "ph_flag",
            keys: Sequence[str] = ()) -> DataFrame:
    """Bad above the limit and inside the listed periods (ends included; those of the key), else acceptable."""
    return flag_intervals(threshold_flag(ph, value, ">", limit, flag), intervals, [flag], closed="both", ts=TS, keys=keys)


def read_ph_and_flag(spark: SparkSession, path_or_table: str, flag_path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    ph = read_epoch_table(spark, path_or_table, fmt, truncate=True, **options)
    return flag_ph(ph, read_intervals(spark, flag_path))


def read_rho(spark: SparkSession, path_or_table: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The rhodamine feed, checked, with a default flag."""
    rho = read_epoch_table(spark, path_or_table, fmt, truncate=True, **options)
    return default_flag(check_feed(rho, "rho"), "rho_flag")


def store_feeds(feeds: Mapping[str, DataFrame], feed_dir: str) -> dict[str, DataFrame]:
    """Each feed written to a folder of its name and read back; the jobs run side by side."""

    def stored(name: str) -> DataFrame:
        feeds[name].write.parquet(f"{feed_dir}/{name}")
        return feeds[name].sparkSession.read.parquet(f"{feed_dir}/{name}")

    with ThreadPoolExecutor(max(1, len(feeds))) as pool:
        return dict(zip(feeds, pool.map(stored, feeds), strict=True))


def prepare_feeds(
    gps: DataFrame, track: DataFrame, tsg: DataFrame, log_rows: DataFrame, ph: DataFrame, ph_intervals: DataFrame,
    rho: DataFrame, oxygen: DataFrame, scale: float = 1.0, feed_dir: str | None = None, keys: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The five feeds patched, flagged and stored. They are made side by side, the statistics their plans begin with too."""
    s = lambda seconds: seconds * scale
    makers = {
        "gps": lambda: patch_gps(gps, track, s(1), s(46), s(1.5), keys=keys),
        "tsg": lambda: patch_tsg(tsg, log_rows, s(2), s(2.5), s(1.5), keys),
        "ph": lambda: flag_ph(ph, ph_intervals, keys=keys),
        "rho": lambda: default_flag(rho, "rho_flag"),
        "oxygen": lambda: oxygen,
    }
    with ThreadPoolExecutor(len(makers)) as pool:
        made = dict(zip(makers, pool.map(lambda make: make(), makers.values()), strict=True))
    return store_feeds(made, feed_dir or new_shared_path(gps.sparkSession, "feeds"))


def combine_underway(
    feeds: Mapping[str, DataFrame], k0: float, k2: float, interval: str | int | float = "2s", tolerance: str | int | float = "2s",
    ties: Mapping[str, Sequence[str]] | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """All feeds on one grid (of each key), with calibrated pH; a pH flag is cleared where the pH is NaN."""
    ties = ties or {}
    narrow = [
        (n, feeds[n].select(*keys, TS, *cols, *[F.col(t).alias(f"__{n}_{t}") for t in ties.get(n, ())]))
        for n, cols in PRODUCT_COLUMNS.items()
    ]
    own_ties = {n: [f"__{n}_{t}" for t in named] for n, named in ties.items()}
    joined = align_series(narrow, interval, TS, tolerance, keys, own_ties)
    present = [c for cols in PRODUCT_COLUMNS.values() for c in cols if c in joined.columns]
    out = add_corrected_ph(joined.select(*keys, TS, *present), k0, k2)
    return null_flag_where_nan(out, "ph_corrected", "ph_flag") if "ph_flag" in present else out


def flag_flow(df: DataFrame, shutdowns: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Everything bad while the flow (of the key) was off (ends excluded); no flag where there is no value."""
    own = [f for f in FLOW_FLAGS if f in df.columns]
    flagged = flag_intervals(df, shutdowns, own, closed="neither", ts=TS, keys=keys)
    pairs = {v: f for v, f in FLAG_OF.items() if v in df.columns and f in df.columns}
    return null_flag_where_missing(flagged, pairs)


def process_underway(
    gps: DataFrame,
    track: DataFrame,
    tsg: DataFrame,
    log_rows: DataFrame,
    ph: DataFrame,
    ph_intervals: DataFrame,
    rho: DataFrame,
    oxygen: DataFrame,
    shutdowns: DataFrame,
    k0: float = -1.3944286,
    k2: float = -0.0010700,
    interval: str | int | float = "2s",
    outputs: Mapping[str, str] | None = None,
    feed_dir: str | None = None,
    scale: float = 1.0,
    check: bool = True,
    keys: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The whole product: ``combined``, the patched feeds, and the ``validation`` report.

    A feed that fails a rule raises unless ``check`` is off. ``scale`` multiplies every step and tolerance
    of the feeds, for series sampled more slowly than by the second. The feeds and the joined product are each
    consumed several times, so they are stored once in ``feed_dir`` (default a new folder in the shared one) and read
    back. The rules of all feeds are one job, for the checks and the report alike. ``keys`` are columns of every input,
    intervals too, that tell the series of several vessels apart.
    """
    feed_dir = feed_dir or new_shared_path(gps.sparkSession, "feeds")
    feeds = prepare_feeds(gps, track, tsg, log_rows, ph, ph_intervals, rho, oxygen, scale, feed_dir, keys)
    validation = validate_feeds(feeds)
    if check:
        if feeds["tsg"].isEmpty():
            raise ValueError("tsg: no rows")
        raise_failed(validation, ("gps", "tsg", "rho", "oxygen"))
    joined = store_feeds({"joined": combine_underway(feeds, k0, k2, interval, 2 * scale, keys=keys)}, feed_dir)["joined"]
    combined = flag_flow(joined, shutdowns, keys)
    if outputs:
        write_products(combined, outputs, TS)
    return {"combined": combined, **feeds, "validation": validation}


def flagged_minute_means(ph: DataFrame, intervals: DataFrame, every: str | int | float = "1m", tie: Sequence[str] = ()) -> DataFrame:
    """Bucket means of flagged pH, with the flag as text so that the worst one of a bucket is kept."""
    flagged = flag_ph(ph, intervals)
    return bucket_by_type(flagged.withColumn("ph_flag", F.col("ph_flag").cast("string")), every, TS, tie=tie)


def clean_and_raw_means(df: DataFrame, every: str | int | float = "10s") -> tuple[DataFrame, DataFrame]:
    """Bucket means of the unflagged rows, and of all rows (then without the pH flag)."""
    clean = bucket_mean(drop_flagged(df, FLOW_FLAGS), every, ts=TS)
    return clean, bucket_mean(df, every, exclude=["ph_flag"], ts=TS)
