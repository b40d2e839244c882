"""Range and type rules per feed, reported as rows ``(feed, rule, column, severity, violations, passed)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, functions as F, types as T

from tidelane.functions.time import MICROS
from tidelane.operators.chunks import order_key

REPORT = "feed string, rule string, column string, severity string, violations bigint, passed boolean"


@dataclass(frozen=True)
class FeedRules:
    """``ranges`` maps a required column to its inclusive bounds; columns in ``strict`` must keep them."""

    ranges: Mapping[str, tuple[float, float]]
    strict: Sequence[str] = ()
    integers: Sequence[str] = ()


# Accepted ranges per feed, inclusive.
RULES = {
    "gps": FeedRules({"latitude": (-90, 90), "longitude": (-180, 180)}),
    "tsg": FeedRules({"temperature": (-2, 35), "salinity": (0, 40)}),
    "ph": FeedRules({"vrse": (-1, 1), "ph_flag": (0, 4)}, strict=("ph_flag",), integers=("ph_flag",)),
    "rho": FeedRules({"rho_ppb": (-1, 500)}),
    "oxygen": FeedRules({"oxygen_umol_kg": (200, 300)}),
}

# Expected ranges of a finished series, inclusive; names match whatever their case.
PRODUCT_RANGES = {
    "temperature": (10, 25),
    "salinity": (25, 37),
    "ph": (7.5, 9.5),
    "rho_ppb": (-1, 1000),
    "latitude": (41.4, 43),
    "longitude": (-71, -69),
    "conductivity": (0, 70),
}


def validate_feed(
    df: DataFrame, feed: str, rules: FeedRules | None = None, ts: str = "datetime_utc"
) -> DataFrame:
    """All rules of a feed in one pass over it.

    A missing column or a value that is no number is an error; a value out of range is a warning that
    still passes, unless its column is strict. Nulls break no rule.
    """
    rules = rules or RULES[feed]
    aggs, rows = [F.lit(0).alias("__none")], []

    def entry(rule, column, severity, violations, passed):
        rows.append(
            F.struct(
                F.lit(feed).alias("feed"), F.lit(rule).alias("rule"), F.lit(column).alias("column"),
                F.lit(severity).alias("severity"), violations.cast("bigint").alias("violations"), passed.alias("passed"),
            )
        )

    for column in [ts, *rules.ranges]:
        absent = column not in df.columns
        entry("required", column, "error", F.lit(int(absent)), F.lit(not absent))
    for i, (column, (lo, hi)) in enumerate(rules.ranges.items()):
        if column not in df.columns:
            continue
        kind = "bigint" if column in rules.integers else "double"
        value = F.col(column) if isinstance(df.schema[column].dataType, T.NumericType) else F.col(column).try_cast(kind)
        aggs.append(F.count_if(F.col(column).isNotNull() & value.isNull()).alias(f"t{i}"))
        aggs.append(F.count_if((value < lo) | (value > hi)).alias(f"r{i}"))
        entry("type", column, "error", F.col(f"t{i}"), F.col(f"t{i}") == 0)
        strict = column in rules.strict
        ok = F.col(f"r{i}") == 0 if strict else F.lit(True)
        entry("range", column, "error" if strict else "warning", F.col(f"r{i}"), ok)
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def validate_gps(df: DataFrame) -> DataFrame:
    return validate_feed(df, "gps")


def validate_tsg(df: DataFrame) -> DataFrame:
    return validate_feed(df, "tsg")


def validate_ph(df: DataFrame) -> DataFrame:
    return validate_feed(df, "ph")


def validate_rho(df: DataFrame) -> DataFrame:
    return validate_feed(df, "rho")


def validate_oxygen(df: DataFrame) -> DataFrame:
    return validate_feed(df, "oxygen")


def validate_feeds(feeds: Mapping[str, DataFrame], ts: str = "datetime_utc") -> DataFrame:
    """The rules of several feeds in one job, the report held by the driver: a handful of rows for each feed."""
    rows = reduce(DataFrame.unionByName, [validate_feed(df, name, ts=ts) for name, df in feeds.items()]).collect()
    return next(iter(feeds.values())).sparkSession.createDataFrame(rows, REPORT)


def raise_failed(report: DataFrame, feeds: Sequence[str]) -> None:
    """Raise for the first of ``feeds`` that fails a rule."""
    for feed in feeds:
        failed = report.where((F.col("feed") == feed) & ~F.col("passed")).collect()
        if failed:
            what = ", ".join(f"{r.rule} {r.column} ({r.violations})" for r in failed)
            raise ValueError(f"{feed}: validation failed: {what}")


def check_feed(df: DataFrame, feed: str, ts: str = "datetime_utc", not_empty: bool = False) -> DataFrame:
    """Run the rules and raise if one fails; returns ``df``."""
    if not_empty and df.isEmpty():
        raise ValueError(f"{feed}: no rows")
    raise_failed(validate_feeds({feed: df}, ts), [feed])
    return df


def range_report(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Out-of-range counts of a finished series (of each key), with the least and greatest value of the columns checked."""
    ranges = PRODUCT_RANGES if ranges is None else ranges
    checked = [
        (f.name, *ranges[f.name.lower()])
        for f in df.schema
        if f.name.lower() in ranges and f.name not in keys and isinstance(f.dataType, T.NumericType)
    ]
    if not checked:
        nothing = "column string, lo double, hi double, out_of_range bigint, min_value double, max_value double"
        own = [f"{c} {t}" for c, t in df.dtypes if c in keys]
        return df.sparkSession.createDataFrame([], ", ".join([*own, nothing]))
    aggs, rows = [], []
    for i, (c, lo, hi) in enumerate(checked):
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        aggs += [F.count_if((v < lo) | (v > hi)).alias(f"n{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"z{i}")]
        rows.append(
            F.struct(
                F.lit(c).alias("column"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"),
                F.col(f"n{i}").alias("out_of_range"), F.col(f"a{i}").alias("min_value"), F.col(f"z{i}").alias("max_value"),
            )
        )
    return df.groupBy(*keys).agg(*aggs).select(*keys, F.explode(F.array(*rows)).alias("e")).select(*keys, "e.*")


def table_overlap(tables: Mapping[str, DataFrame], ts: str = "datetime_utc") -> DataFrame:
    """Time range shared by each pair of named tables; null and zero where they do not overlap."""
    usable = [(name, df) for name, df in tables.items() if ts in df.columns]
    pairs = list(combinations(range(len(usable)), 2))
    schema = "table1 string, table2 string, overlap_start timestamp_ntz, overlap_end timestamp_ntz, overlap_s double"
    if not pairs:
        return next(iter(tables.values())).sparkSession.createDataFrame([], schema)
    bounds = [
        df.agg(F.min(ts).cast("timestamp_ntz").alias("lo"), F.max(ts).cast("timestamp_ntz").alias("hi")).select(
            F.lit(i).alias("i"), "lo", "hi"
        )
        for i, (_, df) in enumerate(usable)
    ]
    at = lambda side, i: F.max(F.when(F.col("i") == i, F.col(side))).alias(f"{side}{i}")
    one = reduce(DataFrame.unionAll, bounds).agg(*[at(s, i) for i in range(len(usable)) for s in ("lo", "hi")])
    rows = [
        F.struct(
            F.lit(usable[a][0]).alias("table1"), F.lit(usable[b][0]).alias("table2"),
            F.when(_known(a, b), F.greatest(f"lo{a}", f"lo{b}")).alias("overlap_start"),
            F.when(_known(a, b), F.least(f"hi{a}", f"hi{b}")).alias("overlap_end"),
        )
        for a, b in pairs
    ]
    out = one.select(F.explode(F.array(*rows)).alias("e")).select("e.*")
    shared = F.col("overlap_start") < F.col("overlap_end")
    span = (order_key(out, "overlap_end") - order_key(out, "overlap_start")) / F.lit(float(MICROS))
    return out.select(
        "table1", "table2",
        F.when(shared, F.col("overlap_start")).alias("overlap_start"),
        F.when(shared, F.col("overlap_end")).alias("overlap_end"),
        F.when(shared, span).otherwise(F.lit(0.0)).alias("overlap_s"),
    )


def _known(a: int, b: int):
    return F.col(f"lo{a}").isNotNull() & F.col(f"lo{b}").isNotNull()
