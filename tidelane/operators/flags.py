"""Quality flags: 2 acceptable, 3 questionable, 4 bad, as one-byte integers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

GOOD, QUESTIONABLE, BAD = 2, 3, 4

_COMPARE = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
}


def default_flag(df: DataFrame, flag: str, value: int = GOOD, only_if_absent: bool = False) -> DataFrame:
    """A constant flag column; with ``only_if_absent`` an existing one is left alone."""
    if only_if_absent and flag in df.columns:
        return df
    return df.withColumn(flag, F.lit(value).cast("tinyint"))


def threshold_flag(
    df: DataFrame, col: str, op: str, limit: float, flag: str, bad: int = BAD, good: int = GOOD
) -> DataFrame:
    """``bad`` where the comparison holds, else ``good``; a null value counts as good."""
    hit = _COMPARE[op](F.col(col), F.lit(limit))
    return df.withColumn(flag, F.when(hit, F.lit(bad)).otherwise(F.lit(good)).cast("tinyint"))


def flag_tsg(df: DataFrame) -> DataFrame:
    """Temperature is taken as good; salinity under 30 is bad."""
    return threshold_flag(default_flag(df, "temperature_flag"), "salinity", "<", 30.0, "salinity_flag")


def null_flag_where_missing(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Clear the flag of each ``{value column: flag column}`` where the value is null."""
    return df.withColumns({f: F.when(F.col(v).isNotNull(), F.col(f)) for v, f in pairs.items()})


def null_flag_where_nan(df: DataFrame, value: str, flag: str) -> DataFrame:
    """Clear the flag where the value is NaN; a null value leaves the flag."""
    return df.withColumn(flag, F.when(F.isnan(value), F.lit(None)).otherwise(F.col(flag)))


def drop_flagged(df: DataFrame, flags: Sequence[str], bad: Sequence[int | str] = (QUESTIONABLE, BAD)) -> DataFrame:
    """Keep rows none of whose flags is in ``bad``; a null flag drops the row too."""
    for flag in flags:
        df = df.where(~F.col(flag).isin(list(bad)))
    return df
