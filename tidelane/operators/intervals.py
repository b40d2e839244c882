"""Flag or extract the rows of a series that fall in a table of time intervals.

Overlapping intervals are merged to spans that share no instant. A span is put into the one or two cells it touches of a
width next above its length, so a cell holds a bounded number of spans however crowded the time axis is, and a row
finds its span by an equi-join on the cell. Spans are few as a rule: their number is checked, and up to
``BROADCAST_SPANS`` they are broadcast, so that rows are neither shuffled nor sorted; more of them are joined by shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidelane.functions.time import duration_us
from tidelane.operators.chunks import Extent, extents, order_key, plan_chunks, rows_per_chunk
from tidelane.operators.rolling import with_row_number

CHUNK, ORDER, LO, HI = "__chunk", "__order", "__lo", "__hi"
#: Lengths within a factor of 2^BAND_BITS share cells of one width, which then hold some 2^(BAND_BITS + 1) spans at most.
BAND_BITS = 6
LAST_BAND = 9
#: Rows of spans that are sent to every executor: two or three longs each.
BROADCAST_SPANS = 100_000
#: Pairs of a row and a period that are compared in one task on average, and the periods that meet a row there at once.
PAIRS_PER_TASK = 20_000_000
PERIODS_PER_BLOCK = 4096
#: A row that meets fewer periods counts as so many pairs, as it is sorted too.
LEAST_PAIRS = 16
#: More tasks than this cost the driver more than they spare; above it they grow.
MOST_TASKS = 20_000


def _spans(
    intervals: DataFrame, start: str, end: str, closed: str, pad: int = 0, keep: Sequence[str] = ()
) -> DataFrame:
    """Start and end in microseconds, without intervals that hold no instant."""
    if closed not in ("both", "neither"):
        raise ValueError("closed must be 'both' or 'neither'")
    lo = order_key(intervals, start) - F.lit(pad)
    hi = order_key(intervals, end) + F.lit(pad)
    spans = intervals.select(lo.alias("lo"), hi.alias("hi"), *keep)
    return spans.where("lo <= hi" if closed == "both" else "lo < hi")


def _held(rows: DataFrame) -> tuple[DataFrame, pa.Table | None]:
    """Up to ``BROADCAST_SPANS`` rows as a local table, made once, and their values; more rows as they are."""
    found = rows.limit(BROADCAST_SPANS + 1).toArrow()
    if found.num_rows > BROADCAST_SPANS:
        return rows, None
    return rows.sparkSession.createDataFrame(found, rows.schema), found


def merged_spans(
    spans: DataFrame, closed: str = "both", keys: Sequence[str] = (), rows: int | None = None
) -> DataFrame:
    """Spans ``lo, hi`` (of each key) that share no instant and hold the same instants as the given ones.

    Gaps and islands in start order: a span begins where every earlier one has ended. The greatest end so far
    and the start of the open island cross a chunk of starts as one row for each chunk and key. ``rows`` may tell how
    many spans there are.
    """
    keys = list(keys)
    first = spans.groupBy(*keys, "lo").agg(F.max("hi").alias("hi"))  # no ties, however many start together
    known = None if rows is None else [Extent(rows, 0, None, None)]
    plan = plan_chunks(spans.sparkSession, [spans.select(F.col("lo").alias("o"))], known)
    rows = plan.place(first, CHUNK, F.col("lo"))
    inside = Window.partitionBy(*keys, CHUNK).orderBy("lo")
    across = Window.partitionBy(*keys, F.lit(0)).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)

    def carry(df: DataFrame, value: str) -> DataFrame:
        """Add ``__carry``: the greatest ``value`` of the earlier chunks."""
        if plan.single:
            return df.withColumn("__carry", F.lit(None).cast("long"))
        edges = df.groupBy(*keys, CHUNK).agg(F.max(value).alias("__carry"))
        edges = edges.withColumn("__carry", F.max("__carry").over(across)).where("__carry is not null")
        names = {c: f"__edge_{c}" for c in (*keys, CHUNK)}
        same = [F.col(c).eqNullSafe(F.col(e)) for c, e in names.items()]
        return df.join(edges.withColumnsRenamed(names), same, "left").drop(*names.values())

    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = carry(rows, "hi").withColumn("__reach", F.greatest(F.max("hi").over(before), "__carry")).drop("__carry")
    new = F.col("__reach").isNull() | (F.col("lo") > F.col("__reach") if closed == "both" else F.col("lo") >= F.col("__reach"))
    rows = rows.withColumn("__from", F.when(new, F.col("lo"))).drop("__reach")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = carry(rows, "__from").withColumn("__from", F.greatest(F.max("__from").over(so_far), "__carry"))
    return rows.groupBy(*keys, F.col("__from").alias("lo")).agg(F.max("hi").alias("hi"))


def _in_cells(spans: DataFrame) -> tuple[DataFrame, list[int]]:
    """Spans with ``__band`` and ``__cell``, once for each cell they touch, and the bands there are; few are broadcast."""
    bits = F.length(F.conv((F.col("hi") - F.col("lo")).cast("string"), 10, 2))  # 0 and 1 have one
    band = F.least(F.floor(bits / BAND_BITS), F.lit(LAST_BAND)).cast("int")
    cells = F.expr(f"sequence(shiftright(lo, {BAND_BITS} * (__band + 1)), shiftright(hi, {BAND_BITS} * (__band + 1)))")
    placed = spans.withColumn("__band", band).withColumn("__cell", F.explode(cells)).withColumnsRenamed({"lo": LO, "hi": HI})
    placed, values = _held(placed)
    if values is not None:
        return F.broadcast(placed), sorted(set(values.column("__band").to_pylist()))
    return placed, sorted(r["__band"] for r in placed.select("__band").distinct().collect())  # ten values at most


def _holds(closed: str):
    at = F.col(ORDER)
    return (at >= F.col(LO)) & (at <= F.col(HI)) if closed == "both" else (at > F.col(LO)) & (at < F.col(HI))


def mark_inside(
    df: DataFrame, ts: str, spans: DataFrame, closed: str, out: str = "__inside", keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``out``: whether the time is in any of the spans (of its key). Every row stays once; a null time is in none."""
    names = {c: f"__key_{c}" for c in keys}
    spans, values = _held(spans)
    merged = merged_spans(spans, closed, keys, None if values is None else values.num_rows)
    placed, bands = _in_cells(merged.withColumnsRenamed(names))
    rows = df.withColumns({ORDER: order_key(df, ts), out: F.lit(False)})
    for b in bands:
        # Spans share no instant, so a row meets one at most and is never doubled.
        own = placed.where(F.col("__band") == b).drop("__band")
        met = F.expr(f"shiftright({ORDER}, {BAND_BITS * (b + 1)})") == F.col("__cell")
        for c, n in names.items():
            met = met & F.col(c).eqNullSafe(F.col(n))
        rows = rows.join(own, met & _holds(closed), "left").withColumn(out, F.col(out) | F.col(LO).isNotNull())
        rows = rows.drop("__cell", LO, HI, *names.values())
    return rows.drop(ORDER)


def flag_intervals(
    df: DataFrame,
    intervals: DataFrame,
    flag_cols: Sequence[str],
    closed: str = "both",
    flag: int = 4,
    ts: str = "datetime_utc",
    start: str = "start_time",
    end: str = "end_time",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Set every flag column to ``flag`` where the time is in any interval; other flags stay as they are.

    With ``keys``, columns of both tables, an interval counts for the rows of its key only. Rows are never duplicated, whatever the number of intervals and their overlaps; rows without a time keep
    their flags, and a flag kept in the interval table itself is not used.
    """
    marked = mark_inside(df, ts, _spans(intervals, start, end, closed, keep=keys), closed, keys=keys)
    new = {c: F.when(F.col("__inside"), F.lit(flag)).otherwise(F.col(c)).cast("tinyint") for c in flag_cols}
    return marked.withColumns(new).drop("__inside")


def _in_blocks(rows: DataFrame, pieces: DataFrame, cell: Sequence[str], spread: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows and pieces of periods dealt out for their join, and the columns to join by.

    The pairs of a cell are the product of its rows and its pieces, which the bytes that are shuffled do not show. They
    are counted first. A cell with more of them than a task should compare is cut to blocks of rows times blocks of
    pieces, every two of which meet in one place, and there are as many tasks as all pairs ask for. Rows are dealt to
    blocks by a hash of ``spread``, so that a repeated task gives the same; rows equal in all of it stay together.
    """
    spark, cell = rows.sparkSession, list(cell)
    met = rows.groupBy(*cell).agg(F.count("*").alias("__rows")).join(pieces.groupBy(*cell).agg(F.count("*").alias("__periods")), cell)
    pairs = F.col("__rows").cast("double") * F.greatest(F.col("__periods"), F.lit(LEAST_PAIRS))
    at_once = F.least(F.greatest(F.col("__periods"), F.lit(LEAST_PAIRS)), F.lit(PERIODS_PER_BLOCK))
    blocks = {
        "__row_blocks": F.ceil(F.col("__rows") * at_once / F.lit(PAIRS_PER_TASK)),
        "__piece_blocks": F.ceil(F.col("__periods") / F.lit(PERIODS_PER_BLOCK)),
    }
    met = met.withColumns(blocks).withColumn("__pairs", pairs)
    # The cells that need no cutting are one row, without a number; it only adds its pairs.
    cut = (F.col("__row_blocks") > 1) | (F.col("__piece_blocks") > 1)
    met = met.groupBy(*[F.when(cut, F.col(c)).alias(c) for c in cell]).agg(F.sum("__pairs").alias("__pairs"), *[F.max(c).alias(c) for c in blocks])
    met, values = _held(met)
    total = met.agg(F.sum("__pairs").alias("n")).first()["n"] if values is None else sum(values.column("__pairs").to_pylist())
    tasks = -(-int(total or 0) // PAIRS_PER_TASK)
    if tasks <= 1:
        return rows, pieces, cell
    blocks = met.drop("__pairs") if values is None else F.broadcast(met.drop("__pairs"))
    rows_in, pieces_in = (F.coalesce(c, F.lit(1).cast("long")) for c in ("__row_blocks", "__piece_blocks"))
    own = F.pmod(F.xxhash64(*spread), rows_in)
    rows = rows.join(blocks, cell, "left").withColumn("__row_block", own).withColumn(
        "__piece_block", F.explode(F.sequence(F.lit(0).cast("long"), pieces_in - 1)))
    own = F.pmod(F.col("__no"), pieces_in)
    pieces = pieces.join(blocks, cell, "left").withColumn("__piece_block", own).withColumn(
        "__row_block", F.explode(F.sequence(F.lit(0).cast("long"), rows_in - 1)))
    by = [*cell, "__row_block", "__piece_block"]
    parts = min(MOST_TASKS, max(tasks, spark.sparkContext.defaultParallelism))
    dealt = [df.drop("__row_blocks", "__piece_blocks").repartition(parts, *by) for df in (rows, pieces)]
    return dealt[0], dealt[1], by


def period_extracts(
    df: DataFrame,
    intervals: DataFrame,
    pad: str | int | float = "20m",
    ts: str = "datetime_utc",
    start: str = "start_time",
    end: str = "end_time",
    order_by: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows of each padded interval (closed ends) with ``period_no``; a row may be in several periods.

    Periods are numbered from 1 by start, then end, or by the integer or time column ``order_by`` of the interval
    table. ``carry`` names columns of the interval table to add.

    Intervals of like length (a power of two) share cells of that width, so each fills at most three cells and a row
    meets few intervals that do not hold it. The merged spans of each length class are joined first: rows outside
    every period go there, and a row is copied only for the classes that have a period at its time. Cells are never
    wider than a chunk of rows is on average; a longer interval fills more of them. The result may grow with the product
    of rows and periods: the pairs of each cell are counted and dealt to tasks of bounded work.
    """
    spark, at = df.sparkSession, order_key(df, ts)
    spans = _spans(intervals, start, end, "both", duration_us(pad), [*([order_by] if order_by else []), *carry])
    spans, values = _held(spans)
    whole = extents(spark, [df.select(at)])[0]
    if not whole.rows:
        return df.limit(0).select(*df.columns, F.lit(0).cast("long").alias("period_no"), *[
            F.lit(None).cast(intervals.schema[c].dataType).alias(c) for c in carry])
    width = max(1, (whole.hi - whole.lo + 1) // (1 + whole.rows // rows_per_chunk(spark)))
    numbered = with_row_number(spans, order_by or "lo", () if order_by else ["hi"], "__rn")
    length = F.least(F.floor(F.log2(F.expr("hi - lo + 1"))), F.lit(width.bit_length() - 1)).cast("int")
    near = [F.greatest("lo", F.lit(whole.lo)), F.least("hi", F.lit(whole.hi))]
    numbered = numbered.withColumns({"__k": length, "__from": near[0], "__to": near[1]}).where("__from <= __to")
    pieces = numbered.withColumn("__cell", F.explode(F.expr("sequence(shiftright(__from, __k), shiftright(__to, __k))")))
    pieces = pieces.select("__k", "__cell", F.col("lo").alias(LO), F.col("hi").alias(HI), (F.col("__rn") + 1).alias("__no"), *[
        F.col(c).alias(f"__carry_{c}") for c in carry])

    near = numbered.select("__k", F.col("__from").alias("lo"), F.col("__to").alias("hi"))
    classes, bands = _in_cells(merged_spans(near, keys=["__k"], rows=None if values is None else values.num_rows))
    rows = df.withColumn(ORDER, at).where(F.col(ORDER).isNotNull())
    spots = F.array(*[F.struct(F.lit(b).alias("b"), F.expr(f"shiftright({ORDER}, {BAND_BITS * (b + 1)})").alias("c")) for b in bands])
    spot = rows.withColumn("__spot", F.explode(spots if bands else spots.cast("array<struct<b:int,c:bigint>>")))
    met = (F.col("__spot.b") == F.col("__band")) & (F.col("__spot.c") == F.col("__cell"))
    held = spot.join(classes, met & _holds("both")).drop("__spot", "__band", "__cell", LO, HI)
    held = held.withColumn("__cell", F.expr(f"shiftright({ORDER}, __k)"))
    spread = [ORDER, *(f.name for f in df.schema if not re.search("map<|variant", f.dataType.simpleString()))]  # no hash of these
    held, pieces, by = _in_blocks(held, pieces, ["__k", "__cell"], spread)
    joined = held.join(pieces, by).where(_holds("both"))
    return joined.select(*df.columns, F.col("__no").alias("period_no"), *[F.col(f"__carry_{c}").alias(c) for c in carry])
