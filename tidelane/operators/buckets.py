"""Aggregates per time bucket: epoch-aligned, closed on the left, labelled by their start.

Every operator here is one partial aggregate, one shuffle of partial results and one final aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidelane.functions.time import duration_us, floor_us, from_micros
from tidelane.operators.chunks import order_key
from tidelane.operators.columns import drop_all_null_rows, ensure_columns, first_per_time

BIN = "__bin"

# Columns, in order, of the product of ``resample_mean_join``.
MEAN_PRODUCT = {
    "datetime_utc": "timestamp_ntz",
    "latitude": "double",
    "longitude": "double",
    "rho_ppb": "double",
    "ph_total": "double",
    "vrse": "double",
    "temp": "double",
    "salinity": "double",
}


def _by_bucket(df: DataFrame, every: str | int | float, ts: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    start = floor_us(order_key(df, ts), duration_us(every))
    rows = df.where(F.col(ts).isNotNull()).withColumn(BIN, start)
    out = rows.groupBy(*keys, BIN).agg(*(aggs or [F.lit(1).alias("__none")])).drop("__none")
    rest = [c for c in out.columns if c != BIN and c not in keys]
    return out.select(*keys, from_micros(BIN).alias(ts), *rest)


def _first(c: str, ts: str, tie: Sequence[str]) -> Column:
    """Value of the earliest row, null included."""
    return F.min_by(F.col(c), F.struct(ts, *tie) if tie else F.col(ts))


def bucket_first(
    df: DataFrame, every: str | int | float, cols: Sequence[str], ts: str = "datetime_utc",
    keys: Sequence[str] = (), tie: Sequence[str] = (),
) -> DataFrame:
    """First row's values per bucket; buckets without rows do not appear."""
    return _by_bucket(df, every, ts, keys, [_first(c, ts, tie).alias(c) for c in cols])


def bucket_mean(
    df: DataFrame, every: str | int | float, exclude: Sequence[str] = (), ts: str = "datetime_utc", keys: Sequence[str] = ()
) -> DataFrame:
    """Mean of every other column per bucket (nulls skipped; a text column has no mean and gives null)."""
    skip = {ts, *exclude, *keys}
    aggs = []
    for f in df.schema:
        if f.name not in skip:
            numeric = isinstance(f.dataType, (T.NumericType, T.BooleanType))
            value = F.col(f.name).cast("double") if numeric else F.lit(None).cast("double")
            aggs.append(F.avg(value).alias(f.name))
    return _by_bucket(df, every, ts, keys, aggs)


def bucket_mean_first(
    df: DataFrame, every: str | int | float, first: Sequence[str] = ("source",), ts: str = "datetime_utc",
    keys: Sequence[str] = (), tie: Sequence[str] = (),
) -> DataFrame:
    """Mean of the numeric columns and the first value of the named ones."""
    skip = {ts, *first, *keys, *tie}
    means = [F.avg(c).alias(c) for c in df.columns if c not in skip]
    return _by_bucket(df, every, ts, keys, [*means, *[_first(c, ts, tie).alias(c) for c in first]])


def bucket_by_type(
    df: DataFrame, every: str | int | float = "1m", ts: str = "datetime_utc", skip: Sequence[str] = ("timestamp",),
    worst: Sequence[str] = ("ph_flag",), keys: Sequence[str] = (), tie: Sequence[str] = (),
) -> DataFrame:
    """Aggregate chosen by column type.

    Four- and eight-byte numbers give their mean, a ``worst`` column of another type its maximum, and
    everything else (the time itself included) its first value as ``<column>_first``.
    """
    aggs = []
    for f in df.schema:
        if f.name in skip or f.name in keys:
            continue
        if isinstance(f.dataType, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
            aggs.append(F.avg(f.name).alias(f.name))
        elif f.name in worst:
            aggs.append(F.max(f.name).alias(f.name))
        else:
            aggs.append(_first(f.name, ts, tie).alias(f"{f.name}_first"))
    return _by_bucket(df, every, ts, keys, aggs)


def resample_mean_join(
    feeds: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]],
    interval: str | int | float,
    ts: str = "datetime_utc",
    expected: Mapping[str, str] | None = None,
    ties: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Bucket means of several feeds side by side, without buckets that have no value at all.

    Rows repeating a time of their feed are dropped first (the first by tie stays). Numbers give their
    mean with NaN as missing, other columns their first non-null value. All feeds share one aggregate:
    a bucket of the common grid survives only if some feed has a value there, so no grid is joined.
    """
    expected = MEAN_PRODUCT if expected is None else expected
    named = list(feeds.items()) if isinstance(feeds, Mapping) else list(feeds)
    usable = [(name, df) for name, df in named if ts in df.columns]
    if not usable:
        spark = named[0][1].sparkSession
        return spark.createDataFrame([], ", ".join(f"`{c}` {k}" for c, k in expected.items()))
    parts, aggs, seen = [], [], set()
    for name, df in usable:
        unique = first_per_time(df.where(F.col(ts).isNotNull()), (ties or {}).get(name, ()), ts)
        for f in df.schema:
            if f.name == ts:
                continue
            if f.name in seen:
                raise ValueError(f"column {f.name} appears in more than one feed")
            seen.add(f.name)
            if isinstance(f.dataType, T.NumericType):
                value = F.col(f.name).cast("double")
                aggs.append(F.avg(F.when(~F.isnan(value), value)).alias(f.name))
            else:
                by = F.when(F.col(f.name).isNotNull(), F.col(ts))
                aggs.append(F.min_by(f.name, by).alias(f.name))
        parts.append(unique)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    bins = _by_bucket(rows, interval, ts, (), aggs)
    return ensure_columns(drop_all_null_rows(bins, sorted(seen)), expected)
