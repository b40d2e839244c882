"""Table and CSV sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelane.functions.time import epoch_to_time
from tidelane.operators.validate import check_feed
from tidelane.sources.sinks import DAY


def read_epoch_table(
    spark: SparkSession,
    path_or_table: str,
    fmt: str = "parquet",
    time_col: str = "datetime_utc",
    truncate: bool = False,
    lo: str | None = None,
    hi: str | None = None,
    **options: str,
) -> DataFrame:
    """A table whose ``time_col``, if it has one, counts seconds since 1970.

    ``fmt`` is any Spark source: ``parquet``, ``csv``, ... with a path, ``jdbc`` with a table name and its
    options (give ``partitionColumn`` and its bounds to read it in parallel), or ``table`` for a catalog table.
    Fractions of a second are kept unless ``truncate``. ``lo`` and ``hi`` (UTC times, both included) limit the
    stored numbers themselves, so the limits reach the scan.
    """
    if fmt == "table":
        df = spark.table(path_or_table)
    elif fmt == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=path_or_table, **options).load()
    else:
        df = spark.read.format(fmt).options(**options).load(path_or_table)
    if time_col not in df.columns:
        return df
    raw = F.col(time_col)
    if df.schema[time_col].dataType.typeName() == "string":
        raw = raw.cast("double")
    for text, bound in ((lo, raw.__ge__), (hi, raw.__le__)):
        if text is not None:
            seconds = (datetime.fromisoformat(text) - datetime(1970, 1, 1)).total_seconds()
            if truncate and text is hi:
                seconds, bound = float(int(seconds // 1) + 1), raw.__lt__
            whole = seconds == int(seconds) and isinstance(df.schema[time_col].dataType, T.IntegralType)
            df = df.where(bound(F.lit(int(seconds) if whole else seconds)))
    return df.withColumn(time_col, epoch_to_time(raw, truncate))


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """Interval CSV ``start_time, end_time, qc_flag, comment``; a malformed line fails the job."""
    return (
        spark.read.schema("start_time timestamp_ntz, end_time timestamp_ntz, qc_flag int, comment string")
        .option("header", True)
        .option("enforceSchema", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_instrument_csv(
    spark: SparkSession,
    path: str,
    value: str = "O2_calc",
    out: str = "oxygen_umol_kg",
    feed: str = "oxygen",
    ts: str = "datetime_utc",
) -> DataFrame:
    """Instrument CSV with a strict ``yyyy-MM-dd HH:mm:ss[.ffffff]`` time in ``datetime`` or ``datetime_utc``.

    Keeps the time and one renamed value. A time that does not parse or a value that is no number fails
    the job.
    """
    df = spark.read.option("header", True).csv(path)
    if "datetime" in df.columns and ts not in df.columns:
        df = df.withColumnRenamed("datetime", ts)
    missing = {ts, value} - set(df.columns)
    if missing:
        raise ValueError(f"{path}: missing columns {sorted(missing)}")
    time = F.to_timestamp_ntz(F.col(ts), F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]"))
    return df.select(time.alias(ts), F.col(value).cast("double").alias(out))


def read_csv_lenient_time(spark: SparkSession, path: str, col: str = "datetime") -> DataFrame:
    """CSV with a header; times that do not parse become null."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.withColumn(col, F.col(col).try_cast("timestamp_ntz"))


def read_oxygen(spark: SparkSession, path: str) -> DataFrame:
    """The oxygen feed, checked."""
    return check_feed(read_instrument_csv(spark, path), "oxygen")


def read_parquet_series(spark: SparkSession, path: str, keep_day: bool = False) -> DataFrame:
    """A stored product; the day it is partitioned by is dropped unless asked for."""
    df = spark.read.parquet(path)
    return df if keep_day else df.drop(DAY)
