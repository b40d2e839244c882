"""Rows that are identical in every column and alone fill a chunk: folded to one, then expanded again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

COPIES_PER_BLOCK = 1_000_000
COUNT = "__n"


def fold_copies(
    df: DataFrame, copies: Sequence[tuple[int, int]], order: str, tie: str
) -> DataFrame:
    """Add ``__n``; rows at one of the crowded ``(order, tie)`` pairs are kept once with their number.

    The count is taken map-side before the shuffle, so the crowd itself never meets in one task.
    """
    if not copies:
        return df.withColumn(COUNT, F.lit(1).cast("long"))
    crowded = F.coalesce(
        F.struct(order, tie).isin([F.struct(F.lit(o).cast("long"), F.lit(t).cast("long")) for o, t in copies]), F.lit(False)
    )
    alone = df.where(~crowded).withColumn(COUNT, F.lit(1).cast("long"))
    return alone.unionByName(df.where(crowded).groupBy(*df.columns).agg(F.count("*").alias(COUNT)))


def expand_copies(df: DataFrame, index: str = "__copy") -> DataFrame:
    """Give every folded row back as often as it was counted, numbered from 0, spread over the cluster."""
    blocks = df.where(F.col(COUNT) > 1).withColumn(
        "__block", F.explode(F.expr(f"sequence(0L, ({COUNT} - 1) div {COPIES_PER_BLOCK})"))
    ).repartition("__block")
    lo = F.col("__block") * F.lit(COPIES_PER_BLOCK)
    hi = F.least(F.col(COUNT) - 1, lo + F.lit(COPIES_PER_BLOCK - 1))
    many = blocks.withColumn(index, F.explode(F.sequence(lo, hi))).drop("__block")
    return df.where(F.col(COUNT) == 1).withColumn(index, F.lit(0).cast("long")).unionByName(many)
