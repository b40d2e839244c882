"""GPS track files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def ingest_track_points(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every track point of GPX files: ``datetime_utc, latitude, longitude`` (a point without time keeps null)."""
    points = (
        spark.read.format("xml")
        .option("rowTag", "trkpt")
        .schema("_lat double, _lon double, time timestamp")
        .load(paths)
    )
    return points.select(
        F.col("time").cast("timestamp_ntz").alias("datetime_utc"),
        F.col("_lat").alias("latitude"),
        F.col("_lon").alias("longitude"),
    )
