"""Binary search over a sorted constant array, as one Catalyst expression."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, functions as F


def constant_longs(values: Sequence[int]) -> Column:
    """One array literal, folded by the optimizer from a single text: values do not cross to the JVM one by one."""
    if len(values) == 0:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, np.asarray(values, dtype="int64").tolist()))), ",").cast("array<bigint>")


def count_at_or_below(
    values: Sequence[int], col: Column, second: tuple[Sequence[int], Column] | None = None
) -> Column:
    """How many of the ascending ``values`` are ``<= col``; 0 where ``col`` is null.

    ``second`` gives a tie-breaking array and column: pairs are then compared in order. The search is a
    fold over the halving steps, so it costs log2(n) comparisons per row and needs no join.
    """
    if len(values) == 0:
        return F.when(col.isNull(), 0).otherwise(0)
    other = (constant_longs(second[0]), second[1]) if second else None
    return count_in_array(constant_longs(values), len(values), col, other)


def count_in_array(
    firsts: Column, width: int, col: Column, second: tuple[Column, Column] | None = None
) -> Column:
    """The same over an array column of at most ``width`` ascending values."""
    steps = [1 << b for b in range(width.bit_length())][::-1]

    def step(found: Column, jump: Column) -> Column:
        at = found + jump - F.lit(1)
        below = F.get(firsts, at) <= col
        if second:
            below = (F.get(firsts, at) < col) | ((F.get(firsts, at) == col) & (F.get(second[0], at) <= second[1]))
        return F.when(below, found + jump).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
