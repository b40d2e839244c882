"""Time columns. Every series carries a zone-less UTC timestamp; arithmetic runs on microseconds."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

MICROS = 1_000_000

_UNIT_US = {
    "us": 1, "microsecond": 1,
    "ms": 1_000, "millisecond": 1_000,
    "s": MICROS, "second": MICROS,
    "m": 60 * MICROS, "minute": 60 * MICROS,
    "h": 3_600 * MICROS, "hour": 3_600 * MICROS,
    "d": 86_400 * MICROS, "day": 86_400 * MICROS,
}
_DURATION = re.compile(r"\s*(?:interval\s+)?'?(\d+(?:\.\d+)?)'?\s*([a-z]+)\s*", re.IGNORECASE)


def duration_us(value: str | int | float | timedelta) -> int:
    """Microseconds of ``"2s"``, ``"10 seconds"``, ``"1m"``, a timedelta, or a number of seconds.

    An unknown unit is an error; it is never silently read as seconds.
    """
    if isinstance(value, timedelta):
        return value // timedelta(microseconds=1)
    if isinstance(value, (int, float)):
        return round(value * MICROS)
    match = _DURATION.fullmatch(value)
    if match:
        number, unit = match.groups()
        unit = unit.lower()
        scale = _UNIT_US.get(unit) or _UNIT_US.get(unit.removesuffix("s"))
        if scale:
            return round(float(number) * scale)
    raise ValueError(f"not a duration: {value!r}")


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def micros(col: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp (the session zone must be UTC)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(col.cast("timestamp"))


def from_micros(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros(col).cast("timestamp_ntz")


def floor_us(col: Column, width_us: int) -> Column:
    """Start of the epoch-aligned bin that holds ``col`` (right for times before 1970 as well)."""
    return col - F.pmod(col, F.lit(width_us))


def epoch_to_time(col: Column, truncate: bool = False) -> Column:
    """Epoch seconds to a timestamp; ``truncate`` drops the fraction of a second first."""
    if truncate:
        return F.timestamp_seconds(col.cast("long")).cast("timestamp_ntz")
    return from_micros((col * F.lit(MICROS)).cast("long"))


def total_seconds(span_us: Column, whole: bool = False) -> Column:
    """Seconds of a microsecond span; ``whole`` cuts the fraction off, toward zero."""
    if whole:
        return (span_us - span_us % F.lit(MICROS)).cast("long") / F.lit(MICROS)
    return span_us / F.lit(float(MICROS))


def normalize_time(df: DataFrame, col: str, errors: str = "raise", unit: str = "s") -> DataFrame:
    """Turn ``col`` into a zone-less timestamp: an integer column counts ``unit``s, else it is parsed.

    ``errors="raise"`` fails the job on a bad value, ``"coerce"`` makes it null.
    """
    if errors not in ("raise", "coerce"):
        raise ValueError("errors must be 'raise' or 'coerce'")
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.IntegralType):
        out = from_micros(c.cast("long") * F.lit(_UNIT_US[unit]))
    elif is_time(dtype):
        out = c.cast("timestamp_ntz")
    elif errors == "raise":
        out = c.cast("timestamp_ntz")
    else:
        out = c.cast("string").try_cast("timestamp_ntz")
    return df.withColumn(col, out)


def time_shift(df: DataFrame, ts: str, shift: str | int | float | timedelta, back: bool = False) -> DataFrame:
    """Move every time of ``ts`` by a constant (a clock offset)."""
    us = duration_us(shift)
    return df.withColumn(ts, F.col(ts) + F.lit(timedelta(microseconds=-us if back else us)))
