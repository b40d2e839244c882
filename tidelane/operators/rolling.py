"""Centred windows over a fixed number of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidelane.operators.chunks import BEYOND, order_key, plan_chunks, tie_key, tie_rest
from tidelane.operators.copies import expand_copies, fold_copies

CHUNK, ORDER, TIE = "__chunk", "__order", "__tie"
#: Chunks whose edges are windowed together, as a power of two.
RUN_BITS = 10


def with_row_number(
    df: DataFrame, order: str, tie: Sequence[str] = (), out: str = "__rn", keys: Sequence[str] = ()
) -> DataFrame:
    """Number the rows 0, 1, 2, ... over the whole order (of each key): a start row per chunk carries its offset.

    Rows without an order value come last, as one crowded instant beyond every other.
    """
    o, t = F.coalesce(order_key(df, order), F.lit(BEYOND)), tie_key(df, tie)
    plan = plan_chunks(df.sparkSession, [df.select(o.alias("o"), t.alias("t"))])
    rows = df.withColumns({ORDER: o, TIE: t})
    rows = plan.place(rows, CHUNK, F.col(ORDER), F.col(TIE))
    rows = fold_copies(rows, plan.copies, ORDER, TIE).withColumn("__step", F.col("__n"))
    if not plan.single:
        before = Window.partitionBy(*keys, F.lit(0)).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        starts = rows.groupBy(*keys, CHUNK).agg(F.sum("__step").alias("__step"))
        starts = starts.withColumn("__step", F.coalesce(F.sum("__step").over(before), F.lit(0)))
        rows = rows.withColumn("__real", F.lit(1)).unionByName(
            starts.withColumn("__real", F.lit(0)), allowMissingColumns=True
        )
    else:
        rows = rows.withColumn("__real", F.lit(1))
    by = Window.partitionBy(*keys, CHUNK).orderBy(
        "__real", ORDER, TIE, *tie_rest(df, tie)
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn(out, F.sum("__step").over(by) - F.col("__step")).where("__real = 1")
    if plan.copies:
        numbered = expand_copies(numbered).withColumn(out, F.col(out) + F.col("__copy"))
    return numbered.select(*df.columns, out)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _thinned(rows: DataFrame, before: int, after: int) -> DataFrame:
    """Folded copies as a window's width of rows: every copy further inside sees copies only, like the one kept for them."""
    n, one = F.col("__n"), F.lit(1).cast("long")
    inner = F.concat(F.array_repeat(one, before), F.array(n - (before + after)), F.array_repeat(one, after))
    sizes = F.when(n > before + after + 1, inner).otherwise(F.array_repeat(one, n.cast("int")))
    return rows.select(*[c for c in rows.columns if c != "__n"], F.posexplode(sizes).alias("__sub", "__n"))


def rolling_deviation(
    df: DataFrame, cols: Sequence[str], order: str, window: int = 5, tie: Sequence[str] = (), keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``<c>_mean`` and ``<c>_std`` over ``window`` rows centred on each row (of each key).

    Every chunk is windowed by itself, after the one shuffle and sort there is. Rows less than half a window from
    an edge of their chunk lack neighbours there: they and the rows they see, a window's width at each edge, go on to
    a second window over runs of ``2^RUN_BITS`` chunks, and from its edges to further ones until a run holds all. Between
    them only whole chunks' inner rows are missing, which no edge row sees; a chunk shorter than that goes on whole.
    Rows without an order value come last.
    """
    before, after = window // 2, (window - 1) // 2
    o, t = F.coalesce(order_key(df, order), F.lit(BEYOND)), tie_key(df, tie)
    plan = plan_chunks(df.sparkSession, [df.select(o.alias("o"), t.alias("t"))])
    rows = df.withColumns({ORDER: o, TIE: t})
    rows = fold_copies(plan.place(rows, CHUNK, F.col(ORDER), F.col(TIE)), plan.copies, ORDER, TIE)
    rows = _thinned(rows, before, after) if plan.copies else rows.withColumn("__sub", F.lit(0))
    rows = rows.withColumn("__done", F.lit(False))
    names = [f"{c}_{s}" for c in cols for s in ("mean", "std")]
    done, shift = [], 0
    while True:
        by = Window.partitionBy(*keys, F.shiftright(CHUNK, shift)).orderBy(CHUNK, ORDER, TIE, *tie_rest(df, tie), "__sub")
        near = by.rowsBetween(-before, after)
        stats = {f"{c}_mean": F.avg(c).over(near) for c in cols} | {f"{c}_std": F.stddev_samp(c).over(near) for c in cols}
        last = plan.last >> shift == 0
        there = lambda n: F.lead(F.lit(True), n, False).over(by) if n else F.lit(True)
        edge = {} if last else {"__at": F.row_number().over(by), "__whole": there(after), "__inner": there(before + after)}
        seen = rows.withColumns({**stats, **edge})
        if last:
            done.append(seen.where("not __done"))
            break
        whole = (F.col("__at") > before) & F.col("__whole")
        done.append(seen.where(whole & ~F.col("__done")).drop(*edge))
        rows = seen.where((F.col("__at") <= before + after) | ~F.col("__inner"))
        rows = rows.withColumn("__done", F.col("__done") | whole).drop(*edge, *names)
        shift += RUN_BITS
    out = reduce(DataFrame.unionByName, done)
    return (expand_copies(out) if plan.copies else out).select(*df.columns, *names)


def _nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    real = [c for c in cols if df.schema[c].dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in real}) if real else df


def rolling_outlier_rows(
    df: DataFrame, cols: Sequence[str], order: str, window: int = 5, k: float = 3.0, tie: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``<c>_outlier``: further than ``k`` rolling deviations from the rolling mean (NaN is missing)."""
    wide = rolling_deviation(_nan_to_null(df, cols), cols, order, window, tie, keys)
    odd = {
        f"{c}_outlier": F.coalesce(
            F.abs(F.col(c) - F.col(f"{c}_mean")) > F.lit(k) * F.when(F.col(f"{c}_std") != 0, F.col(f"{c}_std")),
            F.lit(False),
        )
        for c in cols
    }
    return wide.withColumns(odd)


def rolling_outliers(
    df: DataFrame,
    order: str,
    cols: Sequence[str] | None = None,
    window: int = 5,
    k: float = 3.0,
    tie: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Per numeric column (and key), the number and percentage of rolling outliers."""
    cols = list(cols) if cols is not None else [c for c in numeric_columns(df) if c != order and c not in keys]
    narrow = df.select(*dict.fromkeys([*keys, order, *tie, *cols]))
    rows = rolling_outlier_rows(narrow, cols, order, window, k, tie, keys)
    one = rows.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.count_if(f"{c}_outlier").alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("outliers")) for c in cols])
    share = F.when(F.col("__n") > 0, F.lit(100.0) * F.col("outliers") / F.col("__n")).otherwise(F.lit(0.0))
    return one.select(*keys, "__n", F.explode(entries).alias("e")).select(*keys, "e.column", "e.outliers", "__n").select(
        *keys, "column", "outliers", share.alias("percent")
    )
