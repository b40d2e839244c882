"""Operators that compare a row with the one before it in one long order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidelane.functions.time import MICROS, duration_us, from_micros, total_seconds
from tidelane.operators.chunks import newest_per_chunk, order_key, plan_chunks, tie_key, tie_rest
from tidelane.operators.copies import expand_copies, fold_copies
from tidelane.operators.keyed import fold_keyed, join_keys, keyed_median, keyed_moments
from tidelane.operators.quantiles import exact_median, fold_values

CHUNK, ORDER, TIE, ROW = "__chunk", "__order", "__tie", "__row"


def _into_next_chunk(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hand each chunk's edge row to the next chunk that has rows (one row per chunk and key)."""
    per_key = Window.partitionBy(*keys, F.lit(0)).orderBy(CHUNK)
    moved = edges.withColumn("__next", F.lead(CHUNK).over(per_key))
    return moved.where("__next is not null").drop(CHUNK).withColumnRenamed("__next", CHUNK)


def with_previous(
    df: DataFrame,
    order: str,
    previous: Mapping[str, str],
    keys: Sequence[str] = (),
    tie: Sequence[str] = (),
    like: DataFrame | None = None,
) -> DataFrame:
    """Add ``{new name: column}`` taken from the previous row in the order of ``order`` (then ``tie``).

    ``order`` is a time or an integer. Rows of equal order follow the ``tie`` columns (nulls first), or
    a hash of the whole row when none is given. Rows with a null order get nulls. ``like`` may be a cheaper
    frame of the same columns and about the same density, to place the cuts by.
    """
    keys = list(keys)
    o, t = order_key(df, order), tie_key(df, tie)
    plan = plan_chunks(df.sparkSession, [(df if like is None else like).select(o.alias("o"), t.alias("t"))])
    base = df.select(*keys, o.alias(ORDER), t.alias(TIE), F.struct(*[F.col(c) for c in df.columns]).alias(ROW))
    ordered = plan.place(base.where(F.col(ORDER).isNotNull()), CHUNK, F.col(ORDER), F.col(TIE))

    later_ties = [F.col(f"{ROW}.{c}") for c in tie_rest(df, tie)]
    ordered = fold_copies(ordered, plan.copies, ORDER, TIE)
    rows = ordered.withColumn("__real", F.lit(True))
    if not plan.single:
        by_tie = ordered.withColumn("__full", F.struct(TIE, *[c.alias(f"t{i}") for i, c in enumerate(later_ties)]))
        edges = newest_per_chunk(by_tie, ROW, keys, CHUNK, ORDER, "__full")
        carried = _into_next_chunk(edges, keys).withColumn("__real", F.lit(False))
        carried = carried.withColumns({ORDER: F.lit(None).cast("long"), TIE: F.lit(None).cast("long")})
        rows = rows.unionByName(carried, allowMissingColumns=True)
    by = Window.partitionBy(*keys, CHUNK).orderBy(F.col(ORDER).asc_nulls_first(), TIE, *later_ties)
    prior = {name: F.lag(F.col(f"{ROW}.{c}")).over(by) for name, c in previous.items()}
    out = rows.withColumns(prior).where("__real")
    if plan.copies:
        out = expand_copies(out)
        again = F.col("__copy") > 0
        out = out.withColumns({n: F.when(again, F.col(f"{ROW}.{c}")).otherwise(F.col(n)) for n, c in previous.items()})
    result = out.select(*[F.col(f"{ROW}.{c}").alias(c) for c in df.columns], *previous)
    if df.schema[order].nullable:
        blank = [F.lit(None).cast(df.schema[c].dataType).alias(n) for n, c in previous.items()]
        result = result.unionByName(df.where(F.col(order).isNull()).select(*df.columns, *blank))
    return result


def lag_diff(
    df: DataFrame, ts: str = "datetime_utc", keys: Sequence[str] = (), tie: Sequence[str] = (), out: str = "time_diff"
) -> DataFrame:
    """Add the seconds since the previous row in time order (null for the first)."""
    prior = with_previous(df, ts, {"__prev": ts}, keys, tie)
    span = order_key(prior, ts) - order_key(prior, "__prev")
    return prior.withColumn(out, total_seconds(span)).drop("__prev")


def instants(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct times with their number of rows ``n``, each with the distinct time before it.

    The other rows of an instant follow at a distance of zero, which is all the gap reports need to know
    about them. One shuffle by chunk serves both the folding of equal times and the window; only where an
    instant is so crowded that it fills chunks are equal times folded map-side before it.
    """
    keys = list(keys)
    o = order_key(df, ts)
    plan = plan_chunks(df.sparkSession, [df.select(o.alias("o"))])
    times = df.where(F.col(ts).isNotNull()).select(*keys, o.alias(ORDER))
    points = times.withColumn("n", F.lit(1).cast("long"))
    if plan.hot:
        points = times.groupBy(*keys, ORDER).agg(F.count("*").alias("n"))
    points = plan.place(points, CHUNK, F.col(ORDER))
    if not plan.single:
        ends = plan.place(times, CHUNK, F.col(ORDER)).groupBy(*keys, CHUNK).agg(F.max(ORDER).alias(ORDER))
        points = points.unionByName(_into_next_chunk(ends, keys).withColumn("n", F.lit(0).cast("long")))
    points = points.repartition(*keys, CHUNK).groupBy(*keys, CHUNK, ORDER).agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, CHUNK).orderBy(ORDER)
    return (
        points.withColumn("__prev", F.lag(ORDER).over(by))
        .where("n > 0")
        .select(
            *keys,
            from_micros("__prev").alias("prev_ts"),
            from_micros(ORDER).alias("curr_ts"),
            (F.col(ORDER) - F.col("__prev")).alias("gap"),
            "n",
        )
    )


def find_gaps(
    df: DataFrame, ts: str = "datetime_utc", min_gap: str | int | float = "5s", keys: Sequence[str] = ()
) -> DataFrame:
    """Steps in time longer than ``min_gap``: ``prev_ts, curr_ts, gap`` (microseconds)."""
    return instants(df, ts, keys).where(F.col("gap") > duration_us(min_gap)).drop("n")


def non_monotonic(df: DataFrame, arrival: str, ts: str = "datetime_utc", keys: Sequence[str] = ()) -> DataFrame:
    """Rows whose time is earlier than that of the row that arrived before them (equal times pass)."""
    return with_previous(df, arrival, {"prev_ts": ts}, keys).where(F.col(ts) < F.col("prev_ts"))


def _steps(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Steps of ``instants`` with their multiplicity: one per instant after the first, zeros inside them."""
    pair = lambda v, w: F.struct(v.cast("long").alias("value"), w.cast("long").alias("weight"))
    both = F.array(pair(F.col("gap"), F.lit(1)), pair(F.lit(0), F.col("n") - 1))
    rows = points.select(*keys, F.explode(both).alias("s")).select(*keys, F.lit("step").alias("item"), "s.value", "s.weight")
    return rows.where("value is not null and weight > 0")


def _moments(steps: DataFrame) -> DataFrame:
    """One row: number, mean and sample standard deviation (microseconds) of weighted steps."""
    value, weight = F.col("value").cast("double"), F.col("weight")
    total = steps.agg(F.sum("weight").alias("n"), (F.sum(value * weight) / F.sum("weight")).alias("mean"))
    away = value - total.select("mean").scalar()
    spread = steps.agg(F.sum("weight").alias("n"), F.sum(away * away * weight).alias("squares"))
    return spread.select(
        "n",
        total.select("mean").scalar().alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("std"),
    )


def irregular_intervals(
    df: DataFrame, ts: str = "datetime_utc", stds: float = 2.0, keys: Sequence[str] = ()
) -> DataFrame:
    """Steps further than ``stds`` standard deviations from the mean step (of their key); ``n`` counts equal ones."""
    points = instants(df, ts, keys)
    if keys:
        own = keyed_moments(fold_keyed(_steps(points, keys), keys), keys).select(*keys, "mean", "std")
        points, mean, std = join_keys(points, own, keys), F.col("mean"), F.col("std")
    else:
        found = _moments(fold_values(_steps(points))).first()  # one row of three numbers
        if not found.n or found.std is None:
            return points.limit(0).select(
                F.col("prev_ts").alias("start_ts"), F.col("curr_ts").alias("end_ts"), F.lit(0.0).alias("seconds"), "n"
            )
        mean, std = F.lit(found.mean), F.lit(found.std)
    step = lambda start, us, n: F.struct(
        F.col(start).alias("start_ts"), F.col("curr_ts").alias("end_ts"),
        (us / F.lit(float(MICROS))).alias("seconds"), n.cast("long").alias("n"),
        (F.abs(us - mean) > F.lit(stds) * std).alias("odd"),
    )
    both = F.array(step("prev_ts", F.col("gap"), F.lit(1)), step("curr_ts", F.lit(0).cast("long"), F.col("n") - 1))
    rows = points.select(*keys, F.explode(both).alias("s")).select(*keys, "s.*")
    return rows.where("seconds is not null and n > 0 and odd").drop("odd")


def folded_steps(df: DataFrame, ts: str = "datetime_utc", keys: Sequence[str] = ()) -> DataFrame:
    """The distinct steps of a series (of each key) with their number, checkpointed; serves several reports on it."""
    steps = _steps(instants(df, ts, keys), keys)
    return fold_keyed(steps, keys) if keys else fold_values(steps)


def regularity_report(
    df: DataFrame, ts: str = "datetime_utc", stds: float = 2.0, steps: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """One row (for each key) on the spacing of a series: step statistics, duplicates, share of irregular steps.

    The series is put in order once; everything here comes from the table of its :func:`folded_steps`, which may
    be given. A key with fewer than two times has no row.
    """
    steps = folded_steps(df, ts, keys) if steps is None else steps
    if keys:
        own = join_keys(keyed_moments(steps, keys).drop("n"), keyed_median(steps, keys), keys)
        steps, grouping = join_keys(steps, own, keys), [*keys, "mean", "median", "std"]
        mean, median, std = F.col("mean"), F.col("median"), F.col("std")
    else:
        found, middle = _moments(steps).first(), exact_median(steps)
        mean, std = F.lit(found.mean).cast("double"), F.lit(found.std).cast("double")
        median, grouping = F.lit(middle).cast("double"), []
    weight_of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("weight"))), F.lit(0))
    value, second = F.col("value"), F.lit(float(MICROS))
    one = steps.groupBy(*grouping).agg(
        F.sum("weight").alias("n"),
        (F.min(value) / second).alias("min_s"),
        (F.max(value) / second).alias("max_s"),
        weight_of(value == 0).alias("duplicates"),
        weight_of(F.abs(value - mean) > F.lit(stds) * std).alias("irregular"),
    )
    return one.where("n > 0").select(
        *keys,
        (F.col("n") + 1).alias("rows"),
        F.col("n").alias("intervals"),
        (mean / second).alias("mean_s"),
        (median / second).alias("median_s"),
        (std / second).alias("std_s"),
        "min_s", "max_s", "duplicates", "irregular",
        (F.lit(100.0) * F.col("irregular") / F.col("n")).alias("irregular_pct"),
    )


def sampling_interval(
    df: DataFrame, ts: str = "datetime_utc", keys: Sequence[str] = (), tie: Sequence[str] = ()
) -> DataFrame:
    """Median whole seconds between rows, over rows that have no null in any column.

    The step is taken to the previous row whether or not that one is complete. With ``keys`` there is a row for each
    key that has a step.
    """
    prior = with_previous(df, ts, {"__prev": ts}, keys, tie).dropna("any", subset=[*df.columns, "__prev"])
    step = order_key(prior, ts) - order_key(prior, "__prev")
    whole = prior.select(*keys, (step / F.lit(MICROS)).cast("long").alias("value"))
    if keys:
        return keyed_median(fold_keyed(whole.withColumn("weight", F.lit(1)), keys), keys, "median_s")
    median = exact_median(fold_values(whole.select(F.lit("step").alias("item"), "value", F.lit(1).alias("weight"))))
    return df.sparkSession.range(1).select(F.lit(median).cast("double").alias("median_s"))


def series_completeness(
    df: DataFrame, ts: str = "datetime_utc", steps: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows present against rows expected at the median step (of each key), and steps over five times the median.

    ``steps`` may be given as :func:`folded_steps`. Where the median step is zero there is no row.
    """
    steps = folded_steps(df, ts, keys) if steps is None else steps
    if keys:
        middle = keyed_median(steps, keys).where("median > 0")
        steps, grouping, med = join_keys(steps, middle, keys), [*keys, "median"], F.col("median")
    else:
        median = exact_median(steps)
        grouping, med = [], F.lit(median if median and median > 0 else None).cast("double")
    wide = F.coalesce(F.sum(F.when(F.col("value") > F.lit(5.0) * med, F.col("weight"))), F.lit(0))
    one = steps.groupBy(*grouping).agg(F.sum(F.col("value") * F.col("weight")).alias("span"), wide.alias("large_gaps"))
    total = df.groupBy(*keys).agg(F.count("*").alias("n"))
    if keys:
        one, n = join_keys(one, total, keys), F.col("n")
    else:
        one, n = one.where(med.isNotNull()), total.scalar()
    expected = F.col("span") / med
    return one.select(
        *keys,
        total_seconds(F.col("span")).alias("time_range_s"),
        (med / F.lit(float(MICROS))).alias("median_s"),
        expected.alias("expected_points"),
        n.alias("actual_points"),
        F.when(expected > 0, F.lit(100.0) * n / expected).otherwise(F.lit(0.0)).alias("completeness_pct"),
        "large_gaps",
    )


def position_jumps(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    ts: str = "datetime_utc",
    km: float = 10.0,
    km_per_degree: float = 111.0,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows further than ``km`` from the fix before them (flat distance), nulls left out.

    Fixes of equal time follow a hash of the row, so repeats of one stand together and cannot jump.
    """
    fixes = df.select(*keys, ts, lat, lon)
    for c in (lat, lon):
        if fixes.schema[c].dataType.typeName() in ("double", "float"):
            fixes = fixes.withColumn(c, F.when(~F.isnan(c), F.col(c)))
    fixes = fixes.dropna("any", subset=[ts, lat, lon])
    prior = with_previous(fixes, ts, {"prev_ts": ts, "__lat": lat, "__lon": lon}, keys)
    dlat, dlon = F.col(lat) - F.col("__lat"), F.col(lon) - F.col("__lon")
    far = F.sqrt(dlat * dlat + dlon * dlon) * F.lit(km_per_degree)
    return prior.withColumn("distance_km", far).where(F.col("distance_km") > km).select(
        *keys, "prev_ts", ts, lat, lon, "distance_km"
    )


def gap_context(
    before: DataFrame, after: DataFrame, col: str = "latitude", ts: str = "datetime_utc", pad: str | int | float = "10s"
) -> DataFrame:
    """Rows around the first null of ``col``, before and after filling (empty when nothing is null)."""
    us = duration_us(pad)
    first = before.where(F.col(col).isNull()).agg(F.min(order_key(before, ts)).alias("o"))
    shown = [c for c in before.columns if c in after.columns]

    def near(df: DataFrame, stage: str) -> DataFrame:
        around = F.abs(order_key(df, ts) - first.scalar()) <= us
        return df.where(around).withColumn("stage", F.lit(stage))

    return near(before.select(*shown), "before").unionByName(near(after, "after"), allowMissingColumns=True)
