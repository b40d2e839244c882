"""Projections and filters on series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidelane.operators.flags import _COMPARE


def select_as(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Project ``{source: output name}`` in the order given."""
    return df.select(*[F.col(c).alias(n) for c, n in columns.items()])


def coalesce_columns(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Fill each column from its second column where it is null."""
    return df.withColumns({a: F.coalesce(F.col(a), F.col(b)) for a, b in pairs.items()})


def slice_time(
    df: DataFrame,
    lo: datetime | str,
    hi: datetime | str,
    closed: str = "neither",
    ts: str = "datetime_utc",
) -> DataFrame:
    """Rows between two times, ends excluded (``"neither"``) or included (``"both"``)."""
    a, b = F.lit(str(lo)).cast("timestamp_ntz"), F.lit(str(hi)).cast("timestamp_ntz")
    if closed == "both":
        return df.where((F.col(ts) >= a) & (F.col(ts) <= b))
    if closed == "neither":
        return df.where((F.col(ts) > a) & (F.col(ts) < b))
    raise ValueError("closed must be 'both' or 'neither'")


def filter_value(df: DataFrame, col: str, op: str, value: float) -> DataFrame:
    return df.where(_COMPARE[op](F.col(col), F.lit(value)))


def cast_columns(df: DataFrame, types: Mapping[str, str], errors: str = "raise") -> DataFrame:
    """Cast columns; ``errors="coerce"`` makes values that do not fit null."""

    def to(c: Column, kind: str) -> Column:
        return c.cast(kind) if errors == "raise" else c.try_cast(kind)

    return df.withColumns({c: to(F.col(c), kind) for c, kind in types.items()})


def ensure_columns(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Exactly the expected ``{name: type}`` columns in order; missing ones are null, others dropped."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in expected.items()]
    )


def drop_all_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna("all", subset=list(cols))


def drop_any_null_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(cols) if cols else None)


def sort_by_time(df: DataFrame, ts: str = "datetime_utc", *tie: str) -> DataFrame:
    return df.orderBy(ts, *tie)


def first_rows(df: DataFrame, n: int, ts: str = "datetime_utc", *tie: str) -> DataFrame:
    """The first ``n`` rows in time order (a top-n plan, not a full sort)."""
    return df.orderBy(F.col(ts).asc_nulls_last(), *tie).limit(n)


def last_rows(df: DataFrame, n: int, ts: str = "datetime_utc", *tie: str) -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_last(), *[F.col(t).desc() for t in tie]).limit(n)


def first_per_time(df: DataFrame, order: Sequence[str], ts: str = "datetime_utc", keys: Sequence[str] = ()) -> DataFrame:
    """One row per time: the first in the given order. Rows without a time count as one time."""
    rest = [c for c in df.columns if c != ts and c not in keys]
    if not rest:
        return df.dropDuplicates()
    by = F.struct(*[F.col(c) for c in order]) if order else F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*keys, ts).agg(F.min_by(F.struct(*rest), by).alias("__row"))
    return picked.select(*[F.col(c) if c == ts or c in keys else F.col(f"__row.{c}") for c in df.columns])
