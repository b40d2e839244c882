"""Instrument text logs of ``key= value`` lines, parsed with column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidelane.functions.time import duration_us, from_micros, micros
from tidelane.operators.chunks import ChunkPlan, order_key, plan_chunks
from tidelane.session import new_shared_path

# Patterns of the log format. (?U) makes the classes match all Unicode digits and letters.
DAMAGED_DATE = r"(?U)dmy=(\d{5})\$\*?.*$"
REPAIRED_DATE = "dmy=$15"  # the five digits, then a 5 for the unreadable last one
KEY_VALUE = r"(?U)(\w+)=\s*([-\d.]+(?:\s+[-\d.]+\s+[NSEW])?)"
NUMBER = r"-?(?:\d+\.?\d*|\.\d+)"
MEASURES = ("t1", "c1", "s", "t2")
REQUIRED = ("t1", "c1", "s")
COORDINATES = {"lat": "latitude", "lon": "longitude"}
NO_HEMISPHERE = "no hemisphere in "

#: Lines of a file block that are filled together.
PIECE_LINES = 1 << 17
PART, RN, ANCHOR = "__part", "__rn", "__anchor"

# Control characters that mark a pair in a marked line: before the key, before the value, after it.
KEY_AT, VALUE_AT, END_AT, OTHER = "\u0001", "\u0002", "\u0003", "\u0004"
UNREADABLE = (
    f"{KEY_AT}(?:{'|'.join(MEASURES)}){VALUE_AT}(?!{NUMBER}{END_AT})"
    f"|{KEY_AT}(?:{'|'.join(COORDINATES)}){VALUE_AT}(?!{NUMBER}\\s+{NUMBER}\\s+[NSEW]{END_AT})"
)


def repair_date_token(line: Column) -> Column:
    """Restore a date whose last digit was overwritten by ``$``; whatever follows it is dropped."""
    damaged = line.contains("dmy=") & line.contains("$")
    return F.when(damaged, F.regexp_replace(line, DAMAGED_DATE, REPAIRED_DATE)).otherwise(line)


def extract_pairs(line: Column) -> Column:
    """All key-value pairs of a line, in order, as an array of ``(k, v, number, problem)``.

    ``number`` is the value of a measurement or a coordinate in decimal degrees; ``problem`` says why a
    measurement or coordinate could not be read.
    """
    matches = F.regexp_extract_all(line, F.lit(KEY_VALUE), F.lit(0))
    cut = lambda m: F.struct(
        F.substring_index(m, "=", 1).alias("k"),
        F.regexp_replace(F.substr(m, F.instr(m, "=") + 1), r"(?U)^\s+", "").alias("v"),
    )
    return F.transform(F.transform(matches, cut), _read_pair)


def _read_pair(pair: Column) -> Column:
    key, value = pair["k"], pair["v"]
    # A one-element array binds the tokens, so that the value is split once.
    place = F.get(F.transform(F.array(F.split(value, r"(?U)\s+")), _read_place), 0)
    unreadable = F.concat(F.lit("unreadable value for "), key)
    number = F.when(key.isin(*MEASURES), value.try_cast("double")).when(key.isin(*COORDINATES), place)
    bare = ~F.regexp_like(value, F.lit(r"(?U)\s")) & value.try_cast("double").isNotNull()
    problem = F.when(key.isin(*COORDINATES) & bare, F.concat(F.lit(NO_HEMISPHERE), key)).when(
        key.isin(*MEASURES, *COORDINATES), unreadable
    )
    bound = lambda n: F.struct(
        key.alias("k"), value.alias("v"), n.alias("number"), F.when(n.isNull(), problem).alias("problem")
    )
    return F.get(F.transform(F.array(number), bound), 0)


def _read_place(tokens: Column) -> Column:
    """Decimal degrees of ``[degrees, minutes, hemisphere]``, negative for S and W; null if unreadable."""
    size = F.get(tokens, 0).try_cast("double") + F.get(tokens, 1).try_cast("double") / F.lit(60.0)
    return F.when(F.get(tokens, 2).isin("S", "W"), -size).when(F.get(tokens, 2).isNotNull(), size)


def mark_pairs(line: Column) -> Column:
    """The line with every key-value pair set off by control characters (any of its own are masked)."""
    masked = F.translate(line, KEY_AT + VALUE_AT + END_AT, OTHER * 3)
    return F.regexp_replace(masked, KEY_VALUE, f"{KEY_AT}$1{VALUE_AT}$2{END_AT}")


def _last_marked(marked: Column, key: str) -> Column:
    """Last value of a key in a marked line, or null; plain substring search."""
    head = f"{KEY_AT}{key}{VALUE_AT}"
    return F.when(
        marked.contains(head), F.substring_index(F.substring_index(marked, head, -1), END_AT, 1)
    )


def _marked_place(marked: Column, key: str) -> Column:
    value = _last_marked(marked, key)
    degrees = F.regexp_extract(value, r"^(\S+)\s", 1).try_cast("double")
    minutes = F.regexp_extract(value, r"\s(\S+)\s", 1).try_cast("double")
    size = degrees + minutes / F.lit(60.0)
    return F.when(F.right(value, F.lit(1)).isin("S", "W"), -size).otherwise(size)


def parse_number(marked: Column, pairs: Column, key: str) -> Column:
    """Last readable measurement or coordinate of a key.

    Where every value of the line is readable (``pairs`` is null) that is simply the last one.
    """
    good = F.filter(pairs, lambda p: (p["k"] == key) & p["number"].isNotNull())
    plain = _marked_place(marked, key) if key in COORDINATES else _last_marked(marked, key).try_cast("double")
    return F.when(pairs.isNotNull(), F.try_element_at(good, F.lit(-1))["number"]).otherwise(plain)


def parse_hms_dmy(hms: Column, dmy: Column) -> Column:
    """Time of ``HHMMSS`` and ``DDMMYY`` (years from 2000), null if there is none such.

    Only the first six characters are read. A time that ends in 60 is the start of the next minute.
    """
    two = lambda text, start: F.trim(F.substring(text, start, 2)).try_cast("int")
    rolls = hms.endswith("60")
    second = F.when(rolls, F.lit(0)).otherwise(two(hms, 5))
    base = F.try_make_timestamp_ntz(
        F.lit(2000) + two(dmy, 5), two(dmy, 3), two(dmy, 1), two(hms, 1), two(hms, 3), second
    )
    base = F.when(second.between(0, 59), base)
    return F.when(rolls, base + F.expr("interval 1 minute")).otherwise(base)


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add the parsed values, ``kept`` and ``reject_reason`` (the first thing wrong) to every line.

    Lines without any pair are neither kept nor reported. A line is not kept if a coordinate lacks its hemisphere
    or a required measurement is missing; other problems leave a null.
    """
    marked, pairs = F.col("__marked"), F.col("__pairs")
    fixed = repair_date_token(F.col(line))
    df = lines.withColumn("__marked", mark_pairs(fixed))
    # Few lines hold an unreadable value; only those are taken apart pair by pair.
    df = df.withColumn("__pairs", F.when(marked.rlike(UNREADABLE), extract_pairs(fixed)))
    df = df.withColumns(
        {
            **{m: parse_number(marked, pairs, m) for m in MEASURES},
            **{name: parse_number(marked, pairs, key) for key, name in COORDINATES.items()},
            "__hms": F.trim(_last_marked(marked, "hms")),
            "__dmy": F.trim(_last_marked(marked, "dmy")),
            "__problems": F.when(
                pairs.isNotNull(), F.filter(F.transform(pairs, lambda p: p["problem"]), lambda r: r.isNotNull())
            ),
            "__any": marked.contains(END_AT),
        }
    )
    df = df.withColumn("datetime", parse_hms_dmy(F.col("__hms"), F.col("__dmy")))
    bad_time = F.col("__hms").isNotNull() & F.col("__dmy").isNotNull() & F.col("datetime").isNull()
    absent = F.concat_ws(", ", *[F.when(F.col(m).isNull(), F.lit(m)) for m in REQUIRED])
    broken = F.coalesce(F.exists("__problems", lambda r: r.startswith(NO_HEMISPHERE)), F.lit(False))
    reason = (
        F.when(~F.col("__any"), F.lit(None))
        .when(F.size("__problems") > 0, F.get("__problems", 0))
        .when(bad_time, F.lit("invalid date or time"))
        .when(absent != "", F.concat(F.lit("missing "), absent))
    )
    df = df.withColumns({"kept": ~broken & (absent == ""), "reject_reason": reason})
    names = [*lines.columns, *MEASURES, *COORDINATES.values(), "datetime", "kept", "reject_reason"]
    # The one-element explode keeps later filters on the parsed columns from being pushed below the
    # parsing, where every expression would be evaluated a second time.
    return df.select(F.explode_outer(F.array(F.struct(*names))).alias("p")).select("p.*")


def fill_time_by_increment(
    df: DataFrame,
    time: str,
    order: str,
    step: str | int | float = "2s",
    keys: Sequence[str] = (),
    part: str | None = None,
    out: str = "ts",
    plan: ChunkPlan | None = None,
) -> DataFrame:
    """Add ``out``: a null time is the last known time plus ``step`` per row since; leading nulls stay.

    ``part`` may name a column that already cuts the order of each key into pieces (a piece of a file), or ``plan`` may
    hold the cuts; otherwise the order is cut here. Each piece passes its row count and last known time on to the next.
    """
    keys = list(keys)
    order_col, step_us = order_key(df, order), duration_us(step)
    if part:
        single, rows = False, df.withColumn(PART, F.col(part))
    else:
        plan = plan or plan_chunks(df.sparkSession, [df.select(order_col.alias("o"))])
        single, rows = plan.single, plan.place(df, PART, order_col)
    by = Window.partitionBy(*keys, PART).orderBy(order_col)
    so_far = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.when(F.col(time).isNotNull(), F.struct(micros(time).alias("at"), F.col(RN).alias("rn")))
    rows = rows.withColumn(RN, F.row_number().over(by).cast("long"))
    rows = rows.withColumn(ANCHOR, F.last(known, ignorenulls=True).over(so_far))
    near = F.col(f"{ANCHOR}.at") + (F.col(RN) - F.col(f"{ANCHOR}.rn")) * F.lit(step_us)
    if single:
        return rows.withColumn(out, from_micros(near)).drop(PART, RN, ANCHOR)
    edges = rows.groupBy(*keys, PART).agg(F.count("*").alias("__rows"), F.max_by(ANCHOR, RN).alias("__end"))
    earlier = Window.partitionBy(*keys, F.lit(0)).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("__offset", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    placed = F.when(
        F.col("__end").isNotNull(),
        F.struct(F.col("__end.at").alias("at"), (F.col("__offset") + F.col("__end.rn")).alias("rn")),
    )
    edges = edges.withColumn("__placed", placed)
    edges = edges.select(*keys, PART, "__offset", F.last("__placed", ignorenulls=True).over(earlier).alias("__carry"))
    far = F.col("__carry.at") + (F.col("__offset") + F.col(RN) - F.col("__carry.rn")) * F.lit(step_us)
    named = {c: f"__edge_{c}" for c in (*keys, PART)}
    same = [F.col(c).eqNullSafe(F.col(e)) for c, e in named.items()]
    joined = rows.join(edges.withColumnsRenamed(named), same, "left")
    filled = joined.withColumn(out, from_micros(F.coalesce(near, far)))
    return filled.select(*df.columns, out)


def parse_keyvalue_lines(
    lines: DataFrame, line: str, order: str, step: str | int | float = "2s", keys: Sequence[str] = (), part: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Typed rows with filled times, and the report of lines with a problem, from a table of lines.

    ``order`` gives the order of the lines (of each key), ``part`` a column that cuts it already. The cuts are made on the
    raw lines. Where there are several pieces, the parsed lines are stored once: rows, what crosses the pieces, and
    the report are read from there.
    """
    where = [*keys, *([part] if part else []), order]
    raw = lines.select(*where, line)
    plan = None if part else plan_chunks(raw.sparkSession, [raw.select(order_key(raw, order).alias("o"))])
    parsed = parse_lines(raw, line)
    if part or not plan.single:
        path = new_shared_path(raw.sparkSession, "parsed")
        parsed.where("kept or reject_reason is not null").write.parquet(path)
        parsed = raw.sparkSession.read.parquet(path)
    kept = parsed.where("kept").select(*where, *MEASURES, *COORDINATES.values(), "datetime")
    rows = fill_time_by_increment(kept, "datetime", order, step, keys, part, plan=plan)
    rejects = parsed.where("reject_reason is not null").select(
        *where, (~F.col("kept")).alias("dropped"), "reject_reason", F.col(line).alias("line")
    )
    return rows, rejects


def ingest_keyvalue_log(
    spark: SparkSession, paths: str | list[str], step: str | int | float = "2s", piece_lines: int = PIECE_LINES
) -> tuple[DataFrame, DataFrame]:
    """Read log files; times are filled along each file. No valid line gives empty frames.

    The order of lines is their file, the block of the file they were read with, and their position. A block is cut
    into pieces of at most ``piece_lines`` lines that leave the task that read them: a compressed file, which is one block
    whatever its length, is read by one task, and parsed and filled by many.
    """
    lines = spark.read.text(paths).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )
    number = F.col("position").bitwiseAND(F.lit((1 << 33) - 1))  # of the line in the task that read it
    pieces = lines.withColumn("piece", F.struct("block", F.floor(number / piece_lines).alias("n")))
    rows, rejects = parse_keyvalue_lines(
        pieces.repartition("file", "piece"), "line", "position", step, keys=["file"], part="piece")
    named = lambda df: df.select(*[F.col("piece.block").alias("block") if c == "piece" else F.col(c) for c in df.columns])
    return named(rows), named(rejects)

