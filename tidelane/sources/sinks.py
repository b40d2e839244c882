"""Product files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

DAY = "utc_day_partition"


def write_parquet_series(df: DataFrame, path: str, ts: str = "datetime_utc", mode: str = "errorifexists") -> None:
    """Parquet partitioned by day, under the reserved column ``DAY``, which ``df`` must not have.

    The rebalance hint lets adaptive execution gather each day's rows into files of even size, splitting a
    day that is too large for one.
    """
    if DAY in df.columns:
        raise ValueError(f"column name {DAY} is reserved for the partition")
    dated = df.withColumn(DAY, F.to_date(ts)).hint("rebalance", DAY)
    dated.sortWithinPartitions(DAY, ts).write.mode(mode).partitionBy(DAY).parquet(path)


def write_csv_series(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and times cut to whole seconds."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss")
        .csv(path)
    )


def write_products(df: DataFrame, outputs: Mapping[str, str], ts: str = "datetime_utc", mode: str = "errorifexists") -> list[str]:
    """Write each format that has a path: ``parquet_path`` and ``csv_path``. Returns what was written."""
    done = []
    if outputs.get("parquet_path"):
        write_parquet_series(df, outputs["parquet_path"], ts, mode)
        done.append("parquet_path")
    if outputs.get("csv_path"):
        write_csv_series(df, outputs["csv_path"], mode)
        done.append("csv_path")
    return done
