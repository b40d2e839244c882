"""Bounded backward as-of joins and what is built on them.

For each left row, the newest right row at or before it, at most ``tolerance`` older, is taken as a whole.
Left rows, right rows of every feed and one carried row per chunk go through a single shuffle and a single
window, however many feeds there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tidelane.functions.time import duration_us
from tidelane.operators.chunks import ChunkPlan, Extent, extents, newest_per_chunk, order_key, plan_chunks
from tidelane.operators.grid import range_grid, time_bounds, time_grid

CHUNK, ORDER, SIDE, ROW = "__chunk", "__order", "__side", "__row"


@dataclass(frozen=True)
class Feed:
    """One right-hand series. ``tie`` orders rows of equal time (the last wins); by default all values. ``tolerance`` is
    its own, where it is not that of the join."""

    df: DataFrame
    tie: Sequence[str] = ()
    tolerance: str | int | float | None = None

    def values(self, ts: str, keys: Sequence[str]) -> list[str]:
        return [c for c in self.df.columns if c != ts and c not in keys]


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _feed_rows(i: int, feed: Feed, ts: str, keys: Sequence[str], plan: ChunkPlan) -> DataFrame:
    """Right rows in window form: payload ``__f{i}`` (time and values) and tie ``__t{i}``."""
    names = feed.values(ts, keys)
    tie = list(feed.tie) or names
    order = order_key(feed.df, ts)
    rows = feed.df.where(F.col(ts).isNotNull()).select(
        *keys,
        order.alias(ORDER),
        F.struct(order.alias(ORDER), *[F.col(c) for c in names]).alias(f"__f{i}"),
        F.struct(*[F.col(c) for c in tie]).alias(f"__t{i}") if tie else F.lit(0).alias(f"__t{i}"),
    )
    return plan.place(rows, CHUNK, F.col(ORDER)).withColumn(SIDE, F.lit(0))


def _carried(
    i: int, rows: DataFrame, probes: DataFrame, keys: Sequence[str], plan: ChunkPlan, tolerance: int
) -> DataFrame:
    """The row each later chunk inherits: the newest one before its start, if within the tolerance.

    Only rows near the end of a chunk can matter, and they are folded map-side to one per chunk and key. With keys
    they are handed only to chunks in which the key has left rows, so the table is bounded by such pairs whatever the
    tolerance; without, to every chunk in reach. A hot instant inherits its own newest row.
    """
    payload, tie = f"__f{i}", f"__t{i}"
    near = plan.place(rows, CHUNK, F.col(ORDER), end="__end").where(F.col("__end") - 1 - F.col(ORDER) <= tolerance).drop("__end")
    edges = newest_per_chunk(near, payload, keys, CHUNK, ORDER, tie)
    if keys:
        # In key order the edge of a hot chunk stands before its left rows, that of any other chunk behind them.
        hot = plan.is_hot(F.col(CHUNK)).cast("int")
        asked = probes.select(*keys, CHUNK).distinct().withColumn(SIDE, hot).withColumn("__asked", F.lit(True))
        stream = edges.withColumn(SIDE, 1 - hot).unionByName(asked, allowMissingColumns=True)
        so_far = Window.partitionBy(*keys).orderBy(CHUNK, SIDE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        held = stream.withColumn(payload, F.last(payload, ignorenulls=True).over(so_far)).where("__asked")
        held = plan.place(held.where(F.col(payload).isNotNull()), "__reach", F.col(f"{payload}.{ORDER}") + F.lit(tolerance))
        return held.where(F.col("__reach") >= F.col(CHUNK)).select(*keys, CHUNK, payload)
    per_key = Window.partitionBy(F.lit(i)).orderBy(CHUNK)
    edges = edges.withColumn("__next", F.lead(CHUNK).over(per_key))
    edges = plan.place(edges, "__reach", F.col(f"{payload}.{ORDER}") + F.lit(tolerance))
    upto = F.when(plan.is_hot(F.col("__next")), F.col("__next") - 1).otherwise(F.col("__next"))
    since = F.when(plan.is_hot(F.col(CHUNK)), F.col(CHUNK)).otherwise(F.col(CHUNK) + 1)
    spans = edges.withColumn("__since", since).withColumn(
        "__upto", F.least("__reach", F.coalesce(upto, F.lit(plan.last)))
    )
    return spans.where("__since <= __upto").select(F.explode(F.sequence("__since", "__upto")).alias(CHUNK), payload)


def _output_names(left_names: Sequence[str], feeds: Sequence[Feed], ts: str, keys: Sequence[str]) -> list[list[str]]:
    """Output names per feed; a name already taken gets the suffix ``_right``."""
    taken = set(left_names)
    out = []
    for feed in feeds:
        names = []
        for c in feed.values(ts, keys):
            name = c if c not in taken else f"{c}_right"
            if name in taken:
                raise ValueError(f"column {name} appears in more than two inputs; rename it first")
            taken.add(name)
            names.append(name)
        out.append(names)
    return out


def latest_within(
    left: DataFrame,
    feeds: Sequence[Feed],
    ts: str,
    tolerance: str | int | float,
    keys: Sequence[str] = (),
    grid: tuple[int, int, int] | None = None,
    known: Sequence[Extent] | None = None,
) -> DataFrame:
    """Left rows with the columns of the newest row of each feed (nulls where none is near enough).

    ``grid`` says that ``left`` is a regular grid ``(lo, hi, points)``, which then needs no statistics.
    """
    spark, keys = left.sparkSession, list(keys)
    tol = [duration_us(tolerance if f.tolerance is None else f.tolerance) for f in feeds]
    order_of = lambda df: df.select(order_key(df, ts))
    right_known = list(known) if known is not None else None
    if grid:
        plan = plan_chunks(spark, [order_of(f.df) for f in feeds], right_known, grid)
        null_times = False
    else:
        both = extents(spark, [order_of(left), *[order_of(f.df) for f in feeds]])
        plan = plan_chunks(spark, [order_of(left), *[order_of(f.df) for f in feeds]], both)
        null_times = both[0].nulls > 0

    names = _output_names(left.columns, feeds, ts, keys)
    own = [c for c in left.columns if c not in keys]
    payloads = [f"__f{i}" for i in range(len(feeds))]
    order = order_key(left, ts)
    probes = left.where(F.col(ts).isNotNull()).select(
        *keys,
        order.alias(ORDER),
        F.struct(*[F.col(c) for c in own]).alias(ROW),
    )
    probes = plan.place(probes, CHUNK, F.col(ORDER)).withColumn(SIDE, F.lit(1))
    rights = [_feed_rows(i, f, ts, keys, plan) for i, f in enumerate(feeds)]
    carried = [] if plan.single else [_carried(i, r, probes, keys, plan, tol[i]) for i, r in enumerate(rights)]

    def finish(rows: DataFrame) -> DataFrame:
        picks = [F.col(f"{ROW}.{c}").alias(c) if c not in keys else F.col(c) for c in left.columns]
        for i, feed in enumerate(feeds):
            fresh = F.col(f"__f{i}.{ORDER}") >= F.col(ORDER) - F.lit(tol[i])
            for source, name in zip(feed.values(ts, keys), names[i]):
                picks.append(F.when(fresh, F.col(f"__f{i}.{source}")).alias(name))
        return rows.select(*picks)

    cold = ~plan.is_hot(F.col(CHUNK))
    stream = [probes.where(cold) if plan.hot else probes]
    for i, r in enumerate(rights):
        stream.append(r.where(cold) if plan.hot else r)
    for i, c in enumerate(carried):
        rows = c.where(cold) if plan.hot else c
        stream.append(rows.withColumn(ORDER, F.col(f"__f{i}.{ORDER}")).withColumn(SIDE, F.lit(0)))
    so_far = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(ORDER, SIDE, *[f"__t{i}" for i in range(len(feeds))])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    windowed = union_all(stream).withColumns({p: F.last(p, ignorenulls=True).over(so_far) for p in payloads})
    parts = [finish(windowed.where(F.col(SIDE) == 1))]
    if plan.hot:
        # Rows that crowd one instant all get the same answer, so they are joined to it instead of being
        # sorted: adaptive execution may split such a join side, which it cannot do to a window.
        held = union_all([c.where(~cold) for c in carried]).groupBy(*keys, CHUNK).agg(
            *[F.first(p, ignorenulls=True).alias(p) for p in payloads]
        )
        names_held = {c: f"__held_{c}" for c in (*keys, CHUNK)}
        same = [F.col(c).eqNullSafe(F.col(h)) for c, h in names_held.items()]
        held = held.withColumnsRenamed(names_held)
        if not keys:
            held = F.broadcast(held)  # one row per hot instant, so fewer than there are chunks
        parts.append(finish(probes.where(~cold).join(held, same, "left")))
    if null_times:
        blank = [
            F.lit(None).cast(f.df.schema[s].dataType).alias(n)
            for f, ns in zip(feeds, names)
            for s, n in zip(f.values(ts, keys), ns)
        ]
        parts.append(left.where(F.col(ts).isNull()).select(*left.columns, *blank))
    return reduce(DataFrame.unionByName, parts)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    ts: str = "datetime_utc",
    tolerance: str | int | float = "2s",
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Backward as-of join: the newest right row with ``0 <= left - right <= tolerance``."""
    return latest_within(left, [Feed(right, tie)], ts, tolerance, keys)


def _on_grid(
    feeds: Sequence[Feed], ts: str, step: str | int | float, tolerance: str | int | float,
    keys: Sequence[str], known: Sequence[Extent],
) -> DataFrame:
    spark = feeds[0].df.sparkSession
    lo, hi = min(e.lo for e in known if e.rows), max(e.hi for e in known if e.rows)
    step_us = duration_us(step)
    if not keys:
        grid, points = range_grid(spark, lo, hi, step_us, ts)
        return latest_within(grid, feeds, ts, tolerance, grid=(lo, hi, points), known=known)
    bounds = time_bounds([f.df for f in feeds], ts, keys)
    return latest_within(time_grid(bounds, step, ts, keys), feeds, ts, tolerance, keys)


def regularize(
    df: DataFrame,
    ts: str = "datetime_utc",
    step: str | int | float = "2s",
    tolerance: str | int | float = 1.5,
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Put one series on a regular grid that starts at its first time."""
    known = extents(df.sparkSession, [df.select(order_key(df, ts))])
    if known[0].rows == 0:
        return df.limit(0)
    out = _on_grid([Feed(df, tie)], ts, step, tolerance, keys, known)
    return out.select(*keys, ts, *[c for c in df.columns if c != ts and c not in keys])


def fill_from_secondary(
    primary: DataFrame,
    secondary: DataFrame,
    ts: str = "datetime_utc",
    value_cols: Sequence[str] | None = None,
    tolerance: str | int | float = 1.5,
    labels: tuple[str, str] = ("primary", "secondary"),
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Fill null values from the newest secondary row and say where each row came from.

    ``source`` is the second label wherever the first value column of the primary is null, even if the
    secondary had nothing to give. Each column is filled on its own.
    """
    values = list(value_cols) if value_cols else [c for c in primary.columns if c != ts and c not in keys]
    spare = secondary.select(*keys, ts, *tie, *[F.col(c).alias(f"{c}_sec") for c in values if c not in tie])
    spare = spare.withColumns({f"{c}_sec": F.col(c) for c in values if c in tie})
    joined = latest_within(primary.select(*keys, ts, *values), [Feed(spare, tie)], ts, tolerance, keys)
    source = F.when(F.col(values[0]).isNull(), F.lit(labels[1])).otherwise(F.lit(labels[0]))
    return joined.select(
        *keys, ts, *[F.coalesce(F.col(c), F.col(f"{c}_sec")).alias(c) for c in values], source.alias("source")
    )


def regularize_filled(
    primary: DataFrame,
    secondary: DataFrame,
    ts: str = "datetime_utc",
    value_cols: Sequence[str] | None = None,
    step: str | int | float = "2s",
    tolerance: str | int | float = 1.5,
    fill_tolerance: str | int | float = 1.5,
    labels: tuple[str, str] = ("primary", "secondary"),
    tie: Sequence[str] = (),
    secondary_tie: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """:func:`regularize` and then :func:`fill_from_secondary`, in one pass over both series.

    The grid is that of the primary (of each key); each of the two has its own tolerance to it. One job takes the
    statistics of both, and one exchange and window find the rows of both for every point.
    """
    values = list(value_cols) if value_cols else [c for c in primary.columns if c not in (ts, *tie, *keys)]
    known = extents(primary.sparkSession, [df.select(order_key(df, ts)) for df in (primary, secondary)])
    kinds = [F.lit(None).cast(primary.schema[c].dataType).alias(c) for c in values]
    if known[0].rows == 0:
        return primary.limit(0).select(*keys, ts, *kinds, F.lit("").alias("source"))
    spare = secondary.select(*keys, F.col(ts), *[F.col(c).alias(f"__tie_{c}") for c in secondary_tie], *[F.col(c).alias(f"__sec_{c}") for c in values])
    feeds = [Feed(primary.select(*keys, ts, *dict.fromkeys([*values, *tie])), tie, tolerance),
             Feed(spare, [f"__tie_{c}" for c in secondary_tie], fill_tolerance)]
    if keys:
        grid = time_grid(time_bounds([primary], ts, keys), step, ts, keys)
        joined = latest_within(grid, feeds, ts, tolerance, keys)
    else:
        lo, hi = known[0].lo, known[0].hi
        grid, points = range_grid(primary.sparkSession, lo, hi, duration_us(step), ts)
        joined = latest_within(grid, feeds, ts, tolerance, grid=(lo, hi, points), known=known)
    source = F.when(F.col(values[0]).isNull(), F.lit(labels[1])).otherwise(F.lit(labels[0]))
    return joined.select(
        *keys, ts, *[F.coalesce(F.col(c), F.col(f"__sec_{c}")).alias(c) for c in values], source.alias("source"))


def align_series(
    feeds: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]],
    interval: str | int | float,
    ts: str = "datetime_utc",
    tolerance: str | int | float = "2s",
    keys: Sequence[str] = (),
    ties: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All feeds on one grid from their common first to their common last time, in the order given.

    A feed without rows adds no columns; one whose rows all lack a time adds its columns as nulls. The tolerance does not follow the interval.
    """
    named = list(feeds.items()) if isinstance(feeds, Mapping) else list(feeds)
    if not named:
        raise ValueError("no feeds to align")
    spark = named[0][1].sparkSession
    known = extents(spark, [df.select(order_key(df, ts)) for _, df in named])
    kept = [(Feed(df, (ties or {}).get(name, ())), e) for (name, df), e in zip(named, known) if e.rows or e.nulls]
    if not any(e.rows for _, e in kept):
        return named[0][1].select(*keys, F.col(ts).cast("timestamp_ntz").alias(ts)).limit(0)
    return _on_grid([f for f, _ in kept], ts, interval, tolerance, keys, [e for _, e in kept])
