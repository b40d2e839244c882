"""Exact order statistics of any number of rows, by narrowing value ranges.

Each pass counts the values of the still open ranges in even bins (at most ``BINS`` rows per range come
back) and keeps the bin that holds the wanted rank, until it holds a single value. Values that are costly to
compute are first folded to distinct ones and cut from their lineage by a checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tidelane.session import shared_folder

BINS = 4096


def nearest_rank(q: float) -> Callable[[int], list[int]]:
    return lambda n: [int((n - 1) * q + 0.5)]


def middle_ranks(n: int) -> list[int]:
    return [(n - 1) // 2, n // 2]


def fold_values(values: DataFrame) -> DataFrame:
    """Distinct ``(item, value)`` with their total ``weight``, checkpointed; null and NaN are left out."""
    shared_folder(values.sparkSession)
    return (
        _usable(values).groupBy("item", "value").agg(F.sum("weight").cast("long").alias("weight")).checkpoint()
    )


def _usable(values: DataFrame) -> DataFrame:
    return values.select("item", F.col("value").cast("double").alias("value"), "weight").where(
        "value is not null and not isnan(value)"
    )


def order_statistics(
    values: DataFrame, ranks: Sequence[Callable[[int], list[int]]]
) -> dict[str, list[list[float]]]:
    """Values at wanted ranks, per item.

    ``values`` has ``item`` (string), ``value`` (numeric) and ``weight`` (how often it occurs); it is read
    once per pass, so fold it first unless it is a plain scan. Each entry of ``ranks`` maps the number of
    values of an item to the 0-based ranks it wants.
    """
    spark, folded = values.sparkSession, _usable(values)
    totals = folded.groupBy("item").agg(
        F.sum("weight").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    ).collect()
    found: dict[tuple[str, int], float] = {}
    want: dict[str, list[list[int]]] = {}
    cells: dict[tuple[str, float, float], list[tuple[int, int]]] = {}
    for row in totals:
        want[row.item] = [r(row.n) for r in ranks]
        for rank in {k for ks in want[row.item] for k in ks}:
            if row.lo == row.hi:
                found[row.item, rank] = row.lo
            else:
                cells.setdefault((row.item, row.lo, row.hi), []).append((rank, rank))
    while cells:
        keys = list(cells)
        table = spark.createDataFrame(
            [(i, item, lo, hi) for i, (item, lo, hi) in enumerate(keys)], "cell int, item string, lo double, hi double"
        )
        share = (F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bins = (
            folded.join(F.broadcast(table), "item")
            .where("value between lo and hi")
            .groupBy("cell", F.least(F.floor(share * F.lit(BINS)), F.lit(BINS - 1)).alias("bin"))
            .agg(F.sum("weight").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
            .collect()
        )
        open_cells: dict[tuple[str, float, float], list[tuple[int, int]]] = {}
        for i, key in enumerate(keys):
            mine = sorted((b for b in bins if b.cell == i), key=lambda b: b.bin)
            for rank, left in cells[key]:
                for b in mine:
                    if left < b.n:
                        break
                    left -= b.n
                if b.lo == b.hi:
                    found[key[0], rank] = b.lo
                else:
                    open_cells.setdefault((key[0], b.lo, b.hi), []).append((rank, left))
        cells = open_cells
    return {item: [[found[item, k] for k in ks] for ks in wanted] for item, wanted in want.items()}


def exact_median(folded: DataFrame) -> float | None:
    """Median of the values of one item (the mean of the middle two for an even number)."""
    found = list(order_statistics(folded, [middle_ranks]).values())
    if not found:
        return None
    low, high = found[0][0]
    return (low + high) / 2
