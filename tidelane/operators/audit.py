"""All checks of a finished series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from tidelane.operators.lag import folded_steps, non_monotonic, position_jumps, regularity_report, series_completeness
from tidelane.operators.reports import correlation, missing_report, quality_scores
from tidelane.operators.rolling import rolling_outliers
from tidelane.operators.validate import range_report


def audit_series(
    df: DataFrame,
    ts: str = "datetime_utc",
    arrival: str | None = None,
    window: int = 5,
    k: float = 3.0,
    jump_km: float = 10.0,
    ranges: dict | None = None,
    tie: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Reports by name: missing, non_monotonic (with an arrival column), regularity, ranges, correlation
    and jumps (where their columns exist), outliers, completeness, quality.

    With ``keys`` every report has the rows of each key's series, judged by itself. A count of rows found is given
    for the keys that have some; without keys it may be zero.
    """
    out = {"missing": missing_report(df, keys)}
    if arrival:
        out["non_monotonic"] = non_monotonic(df, arrival, ts, keys).groupBy(*keys).agg(F.count("*").alias("rows"))
    steps = folded_steps(df, ts, keys)  # put in order once, for both reports on spacing
    out["regularity"] = regularity_report(df, ts, steps=steps, keys=keys)
    out["ranges"] = range_report(df, ranges, keys)
    if {"temperature", "salinity", "conductivity"} <= set(df.columns):
        out["correlation"] = correlation(df, "salinity", "conductivity", ["temperature"], keys=keys)
    if {"latitude", "longitude"} <= set(df.columns):
        out["jumps"] = position_jumps(df, ts=ts, km=jump_km, keys=keys).groupBy(*keys).agg(F.count("*").alias("jumps"))
    out["outliers"] = rolling_outliers(df, ts, window=window, k=k, tie=tie, keys=keys)
    out["completeness"] = series_completeness(df, ts, steps, keys)
    out["quality"] = quality_scores(df, keys)
    return out


def collect_audit(reports: dict[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """The reports as one long table ``(keys, check, item, metric, value)``."""
    parts = []
    for name, report in reports.items():
        item = F.col("column") if "column" in report.columns else F.lit(None).cast("string")
        numbers = [f.name for f in report.schema if f.name not in keys and isinstance(f.dataType, (T.NumericType, T.BooleanType))]
        entries = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in numbers])
        parts.append(
            report.select(*keys, F.lit(name).alias("check"), item.alias("item"), F.explode(entries).alias("e")).select(
                *keys, "check", "item", "e.metric", "e.value"
            )
        )
    return reduce(DataFrame.unionByName, parts)
