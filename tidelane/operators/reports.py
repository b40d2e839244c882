"""Counts, summaries and quality scores of a table, each in one aggregate job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidelane.functions.time import MICROS, is_time
from tidelane.operators.chunks import order_key
from tidelane.operators.quantiles import nearest_rank, order_statistics


def flag_counts(df: DataFrame, flag: str) -> DataFrame:
    return df.groupBy(flag).agg(F.count("*").alias("count"))


def missing(col: str, dtype: T.DataType) -> Column:
    """Null, or NaN in a floating column."""
    c = F.col(col)
    return (c.isNull() | F.isnan(c)) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c.isNull()


def null_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_if(F.col(col).isNull()).alias("null_count"))


def row_range(df: DataFrame, ts: str = "datetime_utc") -> DataFrame:
    """Number of rows, first and last time."""
    return df.agg(F.count("*").alias("row_count"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def duplicate_times(df: DataFrame, ts: str = "datetime_utc") -> DataFrame:
    """Rows that repeat an earlier time; missing times repeat each other."""
    per_time = df.groupBy(ts).agg(F.count("*").alias("n"))
    return per_time.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def correlation(
    df: DataFrame, x: str, y: str, complete: Sequence[str] = (), least_rows: int = 10, low: float = 0.5,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pearson correlation over complete rows (of each key), given only for more than ``least_rows`` of them."""
    cols = list(dict.fromkeys([x, y, *complete]))
    whole = ~F.greatest(*[missing(c, df.schema[c].dataType).cast("int") for c in cols], F.lit(0)).cast("boolean")
    one = df.where(whole).groupBy(*keys).agg(F.count("*").alias("n"), F.corr(x, y).alias("correlation"))
    return one.where(F.col("n") > least_rows).select(*keys, "n", "correlation", (F.col("correlation") < low).alias("low"))


def missing_report(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Missing values per column (and key), as number and percentage of the rows."""
    fields = [(f.name, f.dataType) for f in df.schema if f.name not in keys]
    one = df.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.count_if(missing(c, t)).alias(f"__{i}") for i, (c, t) in enumerate(fields)])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("missing")) for i, (c, _) in enumerate(fields)])
    share = F.when(F.col("__n") > 0, F.lit(100.0) * F.col("missing") / F.col("__n")).otherwise(F.lit(0.0))
    return one.select(*keys, "__n", F.explode(entries).alias("e")).select(*keys, "__n", "e.*").select(
        *keys, "column", "missing", share.alias("percent")
    )


def quality_scores(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of filled cells and of rows that are not full repeats of another row (for each key).

    Equal rows are folded map-side with their number, so copies cost no shuffle. Keys are not among the cells.
    """
    cols = [c for c in df.columns if c not in keys]
    # Floating columns are grouped with NaN read as missing, as the cell count does.
    plain = df.select(
        *keys, *[F.when(~missing(f.name, f.dataType), F.col(f.name)).alias(f.name) for f in df.schema if f.name in cols]
    )
    folded = plain.groupBy(*keys, *cols).agg(F.count("*").alias("__n"))
    blanks = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0))
    one = folded.groupBy(*keys).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(blanks * F.col("__n")), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    cells = F.col("rows") * F.lit(len(cols))
    return one.select(
        *keys,
        "rows",
        cells.alias("total_cells"),
        "missing_cells",
        "duplicate_rows",
        F.when(cells > 0, F.lit(100.0) * (cells - F.col("missing_cells")) / cells).alias("completeness"),
        F.when(F.col("rows") > 0, F.lit(100.0) * (F.col("rows") - F.col("duplicate_rows")) / F.col("rows"))
        .otherwise(F.lit(0.0)).alias("uniqueness"),
    )


def describe_series(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: count, nulls, mean, deviation, least, exact quartiles (nearest), greatest.

    Times are described in seconds since 1970. If there are text columns, ``min_text`` and ``max_text`` hold their least and
    greatest values, and their numbers are null.
    """
    fields = [f for f in df.schema if cols is None or f.name in cols]
    texts = {f.name for f in fields if isinstance(f.dataType, T.StringType)}
    values = {}
    for f in fields:
        if isinstance(f.dataType, T.NumericType):
            values[f.name] = F.col(f.name).cast("double")
        elif is_time(f.dataType):
            values[f.name] = order_key(df, f.name) / F.lit(float(MICROS))
    aggs = []
    for i, f in enumerate(fields):
        aggs += [F.count(f.name).alias(f"c{i}"), F.count_if(F.col(f.name).isNull()).alias(f"n{i}")]
        v = values.get(f.name, F.lit(None).cast("double"))
        if texts:
            own = F.col(f.name) if f.name in texts else F.lit(None).cast("string")
            aggs += [F.min(own).alias(f"ta{i}"), F.max(own).alias(f"tz{i}")]
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"z{i}")]
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("item"), v.alias("value")) for c, v in values.items()])).alias("e")
    ).select("e.item", "e.value", F.lit(1).cast("long").alias("weight"))
    quartiles = order_statistics(long, [nearest_rank(q) for q in (0.25, 0.5, 0.75)]) if values else {}
    entries = []
    for i, f in enumerate(fields):
        q = [p[0] for p in quartiles.get(f.name, [])] or [None] * 3
        entries.append(
            F.struct(
                F.lit(f.name).alias("column"), F.col(f"c{i}").alias("count"), F.col(f"n{i}").alias("null_count"),
                F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"), F.col(f"a{i}").alias("min"),
                *[F.lit(v).cast("double").alias(n) for v, n in zip(q, ("q25", "q50", "q75"))],
                F.col(f"z{i}").alias("max"),
                *([F.col(f"ta{i}").alias("min_text"), F.col(f"tz{i}").alias("max_text")] if texts else []),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
