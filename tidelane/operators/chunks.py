"""Even, order-respecting chunks of one long series.

A time series has no natural partition key, and a window over its whole order would run in one task.
Here the order is cut at literal cut points into chunks of about the same number of rows; a window then
runs per chunk, and the little state that crosses a cut is carried in by one extra row per chunk.

Cut points come from two narrow aggregate jobs over the ordering column only: count/min/max, and (only
when more than one chunk is needed) a sample. The sample places the cuts and nothing else: every row goes
through the operator whatever the cuts are, and the result does not depend on them. Because cuts follow the
row density, a burst that holds a third of all rows gets a third of the chunks. One instant that alone fills
several chunks is reported in ``hot``, for the operator to treat apart.

Up to ``LITERAL_CUTS`` cuts are found on the driver and stand in the plan. More of them are found by a range sort of the
sample and kept in two levels: ``COARSE`` of them in the plan, the others in a table with one row for each, joined
by the coarse number; the plan and what the driver holds then stay the same however many chunks there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidelane.functions.search import constant_longs, count_at_or_below, count_in_array
from tidelane.functions.time import is_time, micros
from tidelane.session import new_shared_path, require_utc

ROWS_PER_CHUNK = "tidelane.rowsPerChunk"
DEFAULT_ROWS_PER_CHUNK = 500_000
LEAST_ROWS = 100_000
SAMPLES_PER_CHUNK = 100
LITERAL_CUTS = 20_000
COARSE = 4096
BEYOND = 1 << 62


def order_key(df: DataFrame, col: str) -> Column:
    """The ordering column as a long: microseconds of a time, or the integer itself."""
    dtype = df.schema[col].dataType
    if is_time(dtype):
        require_utc(df.sparkSession)
        return micros(col)
    if isinstance(dtype, T.IntegralType):
        return F.col(col).cast("long")
    raise TypeError(f"order column {col} must be a time or an integer, not {dtype.simpleString()}")


def tie_key(df: DataFrame, tie: Sequence[str]) -> Column:
    """Second long of the order: the first tie column, or a hash of the row when there is none.

    Of a text it is the first seven bytes, of a fraction its whole part: it rises with the column but may be equal
    for different values, which :func:`tie_rest` then orders.
    """
    if not tie:
        return F.xxhash64(*[F.col(c) for c in df.columns])
    dtype, c = df.schema[tie[0]].dataType, F.col(tie[0])
    if is_time(dtype) or isinstance(dtype, T.IntegralType):
        return order_key(df, tie[0])
    if isinstance(dtype, T.BooleanType):
        return c.cast("long")
    if isinstance(dtype, T.StringType):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("long")
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        whole = F.greatest(F.least(c.cast("double"), F.lit(1e18)), F.lit(-1e18))
        known = F.when(F.isnan(c.cast("double")), F.lit(BEYOND)).otherwise(F.floor(whole).cast("long"))
        return F.when(c.isNotNull(), known)
    raise TypeError(f"tie column {tie[0]} must be a time, number, text or boolean, not {dtype.simpleString()}")


def tie_rest(df: DataFrame, tie: Sequence[str]) -> list[str]:
    """Columns that complete the order after :func:`tie_key`."""
    if not tie:
        return []
    dtype = df.schema[tie[0]].dataType
    exact = is_time(dtype) or isinstance(dtype, (T.IntegralType, T.BooleanType))
    return list(tie[1:] if exact else tie)


@dataclass(frozen=True)
class Extent:
    """Row count and range of an ordering column."""

    rows: int
    nulls: int
    lo: int | None
    hi: int | None


def extents(spark: SparkSession, keys: Sequence[DataFrame]) -> list[Extent]:
    """Extent of each one-column frame, all in one job that returns one row per frame."""
    parts = [
        k.select(F.col(k.columns[0]).alias("o")).agg(
            F.lit(i).alias("i"), F.count("o").alias("n"), F.count_if(F.col("o").isNull()).alias("nulls"),
            F.min("o").alias("lo"), F.max("o").alias("hi"),
        )
        for i, k in enumerate(keys)
    ]
    rows = sorted(reduce(DataFrame.unionAll, parts).collect(), key=lambda r: r.i)
    return [Extent(r.n, r.nulls, r.lo, r.hi) for r in rows]


@dataclass(frozen=True)
class ChunkPlan:
    """Cuts in order: all of them in ``starts``, or each ``fan``-th one there and all in the rows of ``fine``."""

    starts: tuple[int, ...] = ()
    tie_starts: tuple[int, ...] = ()
    hot: tuple[int, ...] = ()
    copies: tuple[tuple[int, int], ...] = field(default=())
    fine: DataFrame | None = None
    cuts: int = 0

    @property
    def single(self) -> bool:
        return not self.starts

    @property
    def last(self) -> int:
        return self.cuts or len(self.starts)

    def place(self, df: DataFrame, out: str, order: Column, tie: Column | None = None, end: str | None = None) -> DataFrame:
        """Add the chunk number ``out`` and, if asked for, ``end``: the first key after the chunk (beyond all for the last)."""
        at = (self.tie_starts, tie) if self.tie_starts else None
        if self.fine is None:
            placed = df.withColumn(out, count_at_or_below(self.starts, order, at))
            return placed.withColumn(end, F.get(constant_longs([*self.starts, BEYOND]), F.col(out))) if end else placed
        # The table has 16 bytes for each cut; a row of it goes to the keys between two coarse cuts.
        placed = df.withColumns({"__coarse": count_at_or_below(self.starts, order, at), "__at": order})
        placed = placed.withColumn("__tie_at", tie if at else F.lit(None).cast("long")).join(F.broadcast(self.fine), "__coarse")
        # The longest array is as wide as the others or wider, so its width bounds the halving steps of all.
        width = -(-self.cuts // len(self.starts))
        found = count_in_array(F.col("__cuts"), width, F.col("__at"), (F.col("__ties"), F.col("__tie_at")) if at else None)
        placed = placed.withColumn("__found", found).withColumn(out, (F.col("__base") + F.col("__found")).cast("int"))
        if end:
            inner = F.get("__cuts", F.col("__found"))
            placed = placed.withColumn(end, F.coalesce(inner, F.col("__after")))
        return placed.drop("__coarse", "__at", "__tie_at", "__base", "__cuts", "__ties", "__after", "__found")

    def is_hot(self, chunk: Column) -> Column:
        return chunk.isin(list(self.hot)) if self.hot else F.lit(False)


def rows_per_chunk(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_CHUNK, str(DEFAULT_ROWS_PER_CHUNK)))


def _chunk_rows(spark: SparkSession, total: int) -> int:
    """Rows of a chunk: as set, else less where there would be fewer chunks than cores, but not under ``LEAST_ROWS``."""
    if spark.conf.get(ROWS_PER_CHUNK, None) is not None:
        return rows_per_chunk(spark)
    return min(DEFAULT_ROWS_PER_CHUNK, max(LEAST_ROWS, -(-total // spark.sparkContext.defaultParallelism)))


def plan_chunks(
    spark: SparkSession,
    keys: Sequence[DataFrame],
    known: Sequence[Extent] | None = None,
    grid: tuple[int, int, int] | None = None,
) -> ChunkPlan:
    """Cut the common order of several one- or two-column frames (order, or order and tie).

    With a tie column, an instant that fills several chunks is cut again by tie. ``grid`` is a regular
    grid ``(lo, hi, points)`` that shares the order; its even density needs no sampling.
    """
    known = known if known is not None else extents(spark, keys)
    sampled = sum(e.rows for e in known)
    total = sampled + (grid[2] if grid else 0)
    chunks = -(-total // _chunk_rows(spark, total)) if total else 0
    if chunks <= 1:
        return ChunkPlan()
    fraction = min(1.0, chunks * SAMPLES_PER_CHUNK / total)
    composite = bool(keys) and len(keys[0].columns) > 1
    names = ["o", "t"] if composite else ["o"]
    picked = reduce(DataFrame.unionAll, [k.toDF(*names) for k in keys]).where("o is not null") if keys else None
    if fraction < 1.0 and keys:
        picked = picked.sample(fraction, seed=17)
    if chunks > LITERAL_CUTS:
        return _sorted_plan(spark, picked, composite, grid, fraction, chunks)
    table = picked.toArrow()
    order = table.column("o").to_numpy().astype("int64")
    tie = table.column("t").fill_null(-BEYOND).to_numpy().astype("int64") if composite else np.zeros(len(order), "int64")
    if grid:
        even = np.linspace(grid[0], grid[1], max(2, int(grid[2] * fraction))).astype("int64")
        order, tie = np.concatenate([order, even]), np.concatenate([tie, np.zeros(len(even), "int64")])
    if len(order) == 0:
        return ChunkPlan()
    by = np.lexsort((tie, order))
    at = by[(np.arange(1, chunks) * len(by)) // chunks]
    cut_o, cut_t = order[at], tie[at]
    values, times = np.unique(cut_o, return_counts=True)
    repeated = values[times > 1]
    if not composite or len(repeated) == 0:
        starts = np.unique(np.concatenate([values, repeated + 1]))
        hot = tuple(int(i) + 1 for i in np.searchsorted(starts, repeated))
        return ChunkPlan(tuple(int(v) for v in starts), hot=hot)
    pairs, pair_times = np.unique(np.stack([cut_o, cut_t], axis=1), axis=0, return_counts=True)
    copies = tuple((int(o), int(t)) for o, t in pairs[pair_times > 1])
    return ChunkPlan(
        tuple(int(o) for o in pairs[:, 0]), tuple(int(t) for t in pairs[:, 1]), copies=copies
    )


def _numbered(df: DataFrame, by: Sequence[str], out: str) -> tuple[DataFrame, int]:
    """The rows in order with their number from 0, and how many there are: a range sort, written once, and one row of
    each of its partitions on the driver."""
    spark = df.sparkSession
    path = new_shared_path(spark, "cuts")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The order of partitions is in the high bits of the row's id.
    df.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn(
        out, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__part", F.shiftright(out, 33))
    sizes = sorted((r["__part"], r["n"]) for r in rows.groupBy("__part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    if not offsets:
        return rows.drop("__part"), 0
    table = F.broadcast(spark.createDataFrame(offsets, "__part long, __offset long"))  # one row for each partition
    inside = F.col(out).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(table, "__part").withColumn(out, inside + F.col("__offset")).drop("__part", "__offset"), total


def _sorted_plan(spark: SparkSession, picked: DataFrame | None, composite: bool, grid: tuple[int, int, int] | None,
                 fraction: float, chunks: int) -> ChunkPlan:
    """The cuts of :func:`plan_chunks` where they are very many: the sample is sorted and cut in Spark, and kept in two levels."""
    tie = F.coalesce(F.col("t"), F.lit(-BEYOND)) if composite else F.lit(0).cast("long")
    sample = picked.select(F.col("o").cast("long").alias("o"), tie.alias("t")) if picked is not None else None
    if grid:
        points = max(2, int(grid[2] * fraction))
        place = F.lit(grid[0]) + F.floor(F.col("id") * F.lit((grid[1] - grid[0]) / (points - 1)))
        even = spark.range(points).select(place.cast("long").alias("o"), F.lit(0).cast("long").alias("t"))
        sample = sample.unionAll(even) if sample is not None else even
    rows, total = _numbered(sample, ["o", "t"], "r")
    if not total:
        return ChunkPlan()
    # Row r is the i-th cut if r = i * total div chunks.
    i = F.ceil(F.col("r") * F.lit(chunks) / F.lit(total)).cast("long")
    cut = (F.expr(f"(ceil(r * {chunks}L / {total}L) * {total}L) div {chunks}L") == F.col("r")) & (i >= 1) & (i < chunks)
    cuts = rows.where(cut).groupBy("o", "t").agg(F.count("*").alias("times"))
    per_instant = cuts.groupBy("o").agg(F.sum("times").alias("times"))
    crowded = per_instant.where("times > 1")
    copies: tuple[tuple[int, int], ...] = ()
    if not composite or crowded.isEmpty():
        composite = False
        after = crowded.select((F.col("o") + 1).alias("o"), F.lit(False).alias("hot"))
        both = per_instant.select("o", (F.col("times") > 1).alias("hot")).unionAll(after)
        starts = both.groupBy("o").agg(F.max("hot").alias("hot")).select("o", F.lit(0).cast("long").alias("t"), "hot")
    else:
        copies = tuple((r["o"], r["t"]) for r in cuts.where("times > 1").select("o", "t").collect())  # fill chunks alone
        starts = cuts.select("o", "t", F.lit(False).alias("hot"))
    starts, n = _numbered(starts, ["o", "t"], "i")
    fan = -(-n // COARSE)
    listed = F.array_sort(F.collect_list(F.struct("i", "o", "t")))
    rows = starts.groupBy((F.floor(F.col("i") / fan) + 1).cast("int").alias("__coarse")).agg(listed.alias("l"))
    rows = rows.select("__coarse", F.transform("l", lambda x: x["o"]).alias("__cuts"), F.transform("l", lambda x: x["t"]).alias("__ties"))
    follow = rows.select((F.col("__coarse") - 1).alias("__coarse"), F.element_at("__cuts", 1).alias("__after"))
    nothing = F.array().cast("array<bigint>")
    first = spark.range(1).select(F.lit(0).alias("__coarse"), nothing.alias("__cuts"), nothing.alias("__ties"))
    fine = rows.unionAll(first).join(follow, "__coarse", "left").select(
        "__coarse", "__cuts", "__ties", F.coalesce("__after", F.lit(BEYOND)).alias("__after"),
        (F.greatest(F.col("__coarse") - 1, F.lit(0)) * fan).alias("__base"))
    path = new_shared_path(spark, "cuts")
    fine.write.parquet(path)
    coarse = sorted((r["i"], r["o"], r["t"]) for r in starts.where(F.col("i") % fan == 0).select("i", "o", "t").collect())
    hot = tuple(sorted(r["i"] + 1 for r in starts.where("hot").select("i").collect()))  # instants that fill chunks alone
    return ChunkPlan(
        tuple(o for _, o, _ in coarse), tuple(t for *_, t in coarse) if composite else (), hot, copies,
        spark.read.parquet(path), n,
    )


def newest_per_chunk(
    rows: DataFrame, payload: str, keys: Sequence[str], chunk: str, order: str, tie: str
) -> DataFrame:
    """``payload`` of the last row of every chunk (of every key).

    The last time of each chunk is found first, with a hash aggregate over two longs; only the rows at
    those times are then compared by tie. Without keys the first result has one row for each chunk.
    """
    ends = rows.groupBy(*keys, chunk).agg(F.max(order).alias("__end"))
    ends = ends.select(*[F.col(c).alias(f"__end_{c}") for c in (*keys, chunk)], "__end")
    same = F.col(order) == F.col("__end")
    for c in (*keys, chunk):
        same = same & F.col(c).eqNullSafe(F.col(f"__end_{c}"))
    last = rows.join(ends if keys else F.broadcast(ends), same, "left_semi")
    return last.groupBy(*keys, chunk).agg(F.max_by(payload, tie).alias(payload))
