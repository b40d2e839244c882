"""Time bounds and regular time grids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelane.functions.time import duration_us, floor_us, from_micros, micros

POINTS_PER_BLOCK = 100_000


def time_bounds(
    frames: DataFrame | Sequence[DataFrame], ts: str = "datetime_utc", keys: Sequence[str] = ()
) -> DataFrame:
    """First and last time over one or many series: ``lo`` and ``hi`` (one row per key)."""
    frames = [frames] if isinstance(frames, DataFrame) else list(frames)
    parts = [
        f.groupBy(*keys).agg(F.min(ts).cast("timestamp_ntz").alias("lo"), F.max(ts).cast("timestamp_ntz").alias("hi"))
        for f in frames
    ]
    if len(parts) == 1:
        return parts[0]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def time_grid(
    bounds: DataFrame,
    step: str | int | float,
    ts: str = "datetime_utc",
    keys: Sequence[str] = (),
    floored: bool = False,
) -> DataFrame:
    """Regular grid over the ``lo``/``hi`` row (or one row per key) of ``bounds``, both ends closed.

    The origin is ``lo`` itself, so ``hi`` is on the grid only if it falls there. ``floored`` starts at
    the epoch-aligned bin of ``lo`` and runs to one step past ``hi``. Points are made in two levels:
    blocks first, spread over the cluster, then the points of each block.
    """
    step_us = duration_us(step)
    if step_us <= 0:
        raise ValueError("the grid step must be positive")
    lo, hi = micros("lo"), micros("hi")
    if floored:
        lo, hi = floor_us(lo, step_us), hi + F.lit(step_us)
    spans = bounds.select(*keys, lo.alias("__lo"), hi.alias("__hi")).where("__lo is not null")
    spans = spans.withColumn("__n", F.expr(f"(__hi - __lo) div {step_us}"))
    blocks = spans.withColumn(
        "__block", F.explode(F.expr(f"sequence(0L, __n div {POINTS_PER_BLOCK})"))
    ).repartition(*keys, "__block")
    first = F.col("__block") * F.lit(POINTS_PER_BLOCK)
    points = blocks.withColumn(
        "__i", F.explode(F.sequence(first, F.least(F.col("__n"), first + F.lit(POINTS_PER_BLOCK - 1))))
    )
    return points.select(*keys, from_micros(F.col("__lo") + F.col("__i") * F.lit(step_us)).alias(ts))


def range_grid(spark: SparkSession, lo: int, hi: int, step_us: int, ts: str) -> tuple[DataFrame, int]:
    """Grid of one series with known bounds, straight from a range scan; also its number of points."""
    points = (hi - lo) // step_us + 1
    tasks = max(1, min(-(-points // 50_000), 4 * spark.sparkContext.defaultParallelism + points // 5_000_000))
    ids = spark.range(0, points, 1, numPartitions=tasks)
    return ids.select(from_micros(F.lit(lo) + F.col("id") * F.lit(step_us)).alias(ts)), points


def join_on_grid(grid: DataFrame, parts: Sequence[DataFrame], ts: str = "datetime_utc", keys: Sequence[str] = ()) -> DataFrame:
    """Keep every grid row; each part adds its columns, null where it has no row for the bin."""
    return reduce(lambda acc, part: acc.join(part, [*keys, ts], "left"), parts, grid)
