"""Statistics of very many series at once, one row for each key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelane.operators.chunks import plan_chunks
from tidelane.session import shared_folder

CHUNK, BEFORE, TOTAL = "__chunk", "__before", "__total"


def join_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``df`` beside the rows of ``other`` of the same keys, null keys included."""
    names = {c: f"__other_{c}" for c in keys}
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return df.join(other.withColumnsRenamed(names), same, how).drop(*names.values())


def fold_keyed(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ``(keys, value)`` with their total ``weight``, checkpointed; null values are left out."""
    shared_folder(values.sparkSession)
    known = values.where("value is not null").groupBy(*keys, F.col("value").cast("long").alias("value"))
    return known.agg(F.sum("weight").cast("long").alias("weight")).checkpoint()


def keyed_order_statistics(
    folded: DataFrame, keys: Sequence[str], ranks: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """For each key the values at wanted ranks: ``keys`` and a column for each entry of ``ranks``.

    ``folded`` has distinct whole ``(keys, value)`` and how often each occurs (``weight``); an entry of ``ranks`` maps the
    number of a key's values to a 0-based rank. Values are put in order by running sums within chunks of the value
    range, into which the sums of the chunks before are carried, one row for each key and chunk. The cuts
    follow the density of all values, so a key that holds most of them is spread over most of the chunks.
    """
    keys = list(keys)
    plan = plan_chunks(folded.sparkSession, [folded.select(F.col("value").alias("o"))])
    rows = plan.place(folded, CHUNK, F.col("value"))
    sums = rows.groupBy(*keys, CHUNK).agg(F.sum("weight").alias("__sum"))
    own = Window.partitionBy(*keys, F.lit(0))
    earlier = own.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({
        BEFORE: F.coalesce(F.sum("__sum").over(earlier), F.lit(0)), TOTAL: F.sum("__sum").over(own),
    })
    # Only chunks that hold a wanted rank go on; the others have no part in the result.
    at = {name: rank(F.col(TOTAL)) for name, rank in ranks.items()}
    wanted = F.lit(False)
    for rank in at.values():
        wanted = wanted | ((rank >= F.col(BEFORE)) & (rank < F.col(BEFORE) + F.col("__sum")))
    near = join_keys(rows, sums.where(wanted).drop("__sum"), [*keys, CHUNK])
    so_far = Window.partitionBy(*keys, CHUNK).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col(BEFORE) + F.col("__upto")
    placed = near.withColumn("__upto", F.sum("weight").over(so_far))
    return placed.groupBy(*keys).agg(*[
        F.max(F.when((rank >= end - F.col("weight")) & (rank < end), F.col("value"))).alias(name) for name, rank in at.items()
    ])


def keyed_median(folded: DataFrame, keys: Sequence[str], out: str = "median") -> DataFrame:
    """Median of each key's values (the mean of the middle two for an even number)."""
    middle = keyed_order_statistics(
        folded, keys, {"__low": lambda n: F.shiftright(n - 1, 1), "__high": lambda n: F.shiftright(n, 1)}
    )
    return middle.select(*keys, ((F.col("__low") + F.col("__high")) / 2).alias(out))


def keyed_moments(folded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``n``, ``mean`` and sample standard deviation ``std`` of each key's values, in two passes over the folded ones."""
    value, weight = F.col("value").cast("double"), F.col("weight")
    total = folded.groupBy(*keys).agg(F.sum("weight").alias("n"), (F.sum(value * weight) / F.sum("weight")).alias("mean"))
    away = value - F.col("mean")
    squares = join_keys(folded, total.drop("n"), keys).groupBy(*keys).agg(F.sum(away * away * weight).alias("squares"))
    spread = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    return join_keys(total, squares, keys).select(*keys, "n", "mean", spread.alias("std"))
