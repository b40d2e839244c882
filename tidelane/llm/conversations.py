"""Repair of a conversation's role structure at least cost, by bidirectional Dijkstra over the edit lattice.

A node of the lattice is a number of rows consumed and the state of the roles given so far (none, system, user,
assistant); edges keep, rerole or delete the next row or insert an empty one. Two heaps, one from the start and one
from the goals, settle nodes by cost until their tops together exceed the best crossing, so that every crossing of
least cost is known; of those the least concatenated audit wins.

Conversations may be of any length. Rows are numbered by a range sort (equal rows are folded first), blocks of at
most ``BLOCK`` neighbouring rows are searched apart for each state in and out, and one search over the blocks joins
them. A digest of the repaired text is serial by nature: there the rows of a conversation stream through one task.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelane.session import new_shared_path

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK_BITS = 9
BLOCK = 1 << BLOCK_BITS
SPACES = " \t\n\x0b\x0c\r"

#: States: no role yet, system, user, assistant. A conversation may end in the first or the last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
GOALS = (NONE, ASSISTANT)
#: Where an empty row may be put, or a row reroled: to the user, or from there to the assistant.
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEPS = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}

Edge = tuple[int, int, int, str]
Layer = tuple[Edge, ...]


@lru_cache(maxsize=4096)
def row_edges(initial: str, truncated: bool, deletes: int) -> Layer:
    """Edges (state, state, cost, audit) over a row, or over ``deletes`` rows that have to go (initial '')."""
    gone = tuple((s, s, DELETE * max(deletes, 1), "D" * max(deletes, 1)) for s in NEXT)
    if deletes:
        return gone
    more = TRUNCATED if truncated else 0
    return (*gone, *((s, t, more, "K") for s, t in KEEPS.get(initial, {}).items()),
            *((s, t, more + REROLE, "R") for s, t in NEXT.items()))


def cheapest(layers: Sequence[Layer], start: int, goals: Sequence[int], inserts: bool = True) -> tuple[int, str] | None:
    """Least cost, and least audit of that cost, of a way over all ``layers`` from ``start`` to one of ``goals``.

    At one cost nodes are settled layer by layer: edges of cost 0 lead to the next layer, so all ways of a node's
    cost have arrived when it is settled. Audits of one node and cost are never the beginning of each other (the longer
    would hold further inserted rows), so the least beginning and the least rest make the least whole.
    """
    n = len(layers)
    done: tuple[dict, dict] = {}, {}
    heaps: tuple[list, list] = [(0, 0, "", start)], [(0, 0, "", g) for g in goals]
    best = float("inf")

    def edges(way: int, i: int, s: int) -> Iterator[tuple[int, int, int, str]]:
        """Nodes one edge on (way 0) or back (way 1), with cost and audit."""
        if inserts:
            for a, b in NEXT.items():
                if s == (a, b)[way]:
                    yield i, (b, a)[way], INSERT, "I"
        if i < n if way == 0 else i > 0:
            for a, b, cost, label in layers[i - way]:
                if s == (a, b)[way]:
                    yield i + 1 - 2 * way, (b, a)[way], cost, label

    while True:
        tops = [h[0][0] if h else float("inf") for h in heaps]
        if sum(tops) > best or not (heaps[0] or heaps[1]):
            break
        way = 0 if tops[0] < tops[1] or (tops[0] == tops[1] and len(done[0]) <= len(done[1])) else 1
        cost, far, audit, s = heapq.heappop(heaps[way])
        i = n - far if way else far
        if (i, s) in done[way]:
            continue
        done[way][i, s] = cost, audit
        if (i, s) in done[1 - way]:
            best = min(best, cost + done[1 - way][i, s][0])
        for j, t, more, label in edges(way, i, s):
            if (j, t) not in done[way]:
                heapq.heappush(heaps[way], (cost + more, n - j if way else j, label + audit if way else audit + label, t))
    found = None
    for (i, s), (cost, audit) in done[0].items():
        for j, t, more, label in [(i, s, 0, ""), *edges(0, i, s)]:
            rest = done[1].get((j, t))
            if rest and (found is None or cost + more + rest[0] <= found[0]):
                way = cost + more + rest[0], audit + label + rest[1]
                found = way if found is None else min(found, way)
    return found


@lru_cache(maxsize=20_000)
def _short(layers: tuple[Layer, ...], start: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    return cheapest(layers, start, goals)


def block_ways(rows: Sequence[dict], starts: Sequence[int], last: bool) -> list[dict]:
    """The cheapest way through a block for each state in and out; into the goals only if it ends the conversation."""
    layers: list[Layer] = []
    for r in rows:
        if not r["gone"]:
            layers.append(row_edges(r["initial"], r["truncated"], 0))
        if r["gone"] or r["m"] > 1:
            layers.append(row_edges("", False, r["m"] - (not r["gone"])))
    out = []
    for s in starts:
        for goals in [GOALS] if last else [(t,) for t in NEXT]:
            way = _short(tuple(layers), s, goals) if len(layers) <= 32 else cheapest(layers, s, goals)
            if way:
                out.append({"start": s, "goal": goals[0], "cost": way[0], "audit": way[1]})
    return out


def is_legal(left: str, right: str) -> bool:
    return left + right in ("su", "ua", "au")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block its ways, its illegal neighbours, and its first and last initial."""
    for batch in batches:
        ways, illegal = [], []
        for rows, first, last in zip(*(batch.column(c).to_pylist() for c in ("rows", "first", "last")), strict=True):
            ways.append(block_ways(rows, [NONE] if first else list(NEXT), last))
            pairs = sum(not is_legal(a["initial"], b["initial"]) for a, b in zip(rows, rows[1:]))
            illegal.append({"n": pairs + sum(r["m"] - 1 for r in rows), "from": rows[0]["initial"], "to": rows[-1]["initial"]})
        kinds = pa.list_(pa.struct([("start", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
        sides = pa.struct([("n", pa.int64()), ("from", pa.string()), ("to", pa.string())])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), pa.array(ways, kinds), pa.array(illegal, sides)],
            ["conv", "block", "ways", "sides"])


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs, audits, illegal = [], [], []
        for blocks in batch.column("blocks").to_pylist():
            layers = [tuple((w["start"], w["goal"], w["cost"], w["audit"]) for w in b["ways"]) for b in blocks]
            cost, audit = layers[0][0][2:] if len(layers) == 1 else cheapest(layers, NONE, GOALS, inserts=False)
            costs.append(cost)
            audits.append(audit)
            sides = [b["sides"] for b in blocks]
            illegal.append(sum(s["n"] for s in sides) + sum(not is_legal(a["to"], b["from"]) for a, b in zip(sides, sides[1:])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["conv", "illegal", "cost", "audit"])


class _Digest:
    """Follows one conversation's audit while its rows stream by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.lines = audit, 0, NONE, 0
        self.sha = hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.sha.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
        self.lines += 1

    def _given(self) -> str:
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(self._given(), "")
            self.at += 1

    def row(self, role: str, text: str, copies: int) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += copies  # further copies are deleted, and nothing is inserted before a deleted row
        if edit == "K":
            self.state = KEEPS[role[0]][self.state]
            self._write(role, text)
        elif edit == "R":
            self._write(self._given(), text)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by conversation, each led by its audit: one digest for each conversation."""
    led: tuple[object, _Digest] | None = None
    for batch in batches:
        out = []
        for conv, audit, role, text, m in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text", "m")),
                                              strict=True):
            if audit is not None:
                if led:
                    led[1].inserted()
                    out.append((led[0], led[1].sha.hexdigest()))
                led = conv, _Digest(audit)
            else:
                led[1].row(role, text, m)
        yield _pairs(out, batch.schema.field("conv").type)
    if led:
        led[1].inserted()
        yield _pairs([(led[0], led[1].sha.hexdigest())], batch.schema.field("conv").type)


def _pairs(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())],
                                      ["conv", "repaired_sha256"])


def _same(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join in which null equals null."""
    right = other.withColumnsRenamed({c: f"{c}__right" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"{c}__right"))
    return df.join(right, condition, how).drop(*[f"{c}__right" for c in on])


def damage_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` after the damage that crc32 of ``conv:turn`` modulo 20 names; nulls count as one space.

    0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 gives it twice, 4
    makes the user its speaker.
    """
    spaced = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn)).cast("binary")) % 20
    plain = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), spaced(role).alias("role"),
                        spaced(text).alias("text"), kind.alias("kind")).where("kind <> 0")
    return plain.select(
        "conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _range_key() -> list[Column]:
    """Short columns in the order of role and text: what the range sort samples does not grow with the texts."""
    wide = F.length("role") > 64
    return [F.substring("role", 1, 64).alias("r"), wide.cast("int").alias("w"),
            F.when(wide, F.lit("")).otherwise(F.substring("text", 1, 64)).alias("t")]


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation of ``rows``: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    A conversation's rows follow ``turn`` (nulls first), then role and text by their bytes; a null role or text is one
    space, a null conversation is one of its own. The first fault of a row counts: ``blank``; ``duplicate`` (role and
    text came before); ``truncated`` (the last character that is not a space ends no sentence). ``gaps`` are missing turns
    between the least and the largest, ``illegal`` neighbours whose role initials are not su, ua or au. ``audit`` holds
    the edits in order (Keep, Rerole, Delete, Insert) of least ``cost`` that leave nothing or an optional system row and
    pairs of user and assistant; ties go to the least string. Blank and duplicate rows are always deleted. The digest is
    of the lines ``role:text`` that are left. Other columns are ignored; no rows, no conversations.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = new_shared_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    spaced = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    folded = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                         spaced(role).alias("role"), spaced(text).alias("text")).groupBy("conv", "turn", "role", "text").agg(
        F.count(F.lit(1)).alias("m"))
    keyed = folded.select("*", *_range_key())
    ordered = stored(keyed.repartitionByRange(parts, "conv", "turn", "r", "w", "t").sortWithinPartitions(
        "conv", "turn", "role", "text").select("conv", "turn", "role", "text", "m", F.monotonically_increasing_id().alias("at")), "turns")

    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    initial = F.substring("role", 1, 1)
    narrow = ordered.select(
        "conv", "turn", "at", "m", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("-")).alias("initial"),
        (end == "").alias("blank"), (~end.isin("", ".", "!", "?")).alias("cut"))
    again = narrow.where("not blank").groupBy("conv", "h1", "h2").agg(F.min("at").alias("seen"), F.count(F.lit(1)).alias("n"))
    told = _same(narrow, again.where("n > 1").drop("n"), ["conv", "h1", "h2"], "left").select(
        "conv", "turn", "at", "m", "initial", "blank", "cut",
        (F.coalesce(F.col("at") > F.col("seen"), F.lit(False)) & ~F.col("blank")).alias("repeated"))
    told = stored(told.withColumn("gone", F.col("blank") | F.col("repeated")), "faults")

    turns = told.where("turn is not null").groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    amount = lambda c, n: F.sum(F.when(c, n).otherwise(F.lit(0).cast("long")))
    facts = told.groupBy("conv").agg(
        amount(F.col("blank"), F.col("m")).alias("blank"),
        amount(~F.col("blank"), F.col("m") - F.when(F.col("repeated"), 0).otherwise(1)).alias("duplicate"),
        amount(~F.col("gone") & F.col("cut"), F.lit(1).cast("long")).alias("truncated"),
        F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    facts = stored(_same(facts, turns, ["conv"], "left").na.fill(0, ["gaps"]), "facts")

    row = F.struct("at", "m", "initial", F.col("cut").alias("truncated"), "gone")
    blocks = told.groupBy("conv", F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    blocks = _same(blocks, facts.select("conv", "first_at", "last_at"), ["conv"]).select(
        "conv", "block", "rows", (F.element_at("rows", 1)["at"] == F.col("first_at")).alias("first"),
        (F.element_at("rows", -1)["at"] == F.col("last_at")).alias("last"))
    kind = dict(ordered.dtypes)["conv"]
    ways = stored(blocks.mapInArrow(
        _search, f"conv {kind}, block long, ways array<struct<start:int,goal:int,cost:long,audit:string>>, "
                 "sides struct<n:long,from:string,to:string>"), "ways")
    audits = ways.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "ways", "sides"))).alias("blocks")).mapInArrow(
        _join_blocks, f"conv {kind}, illegal long, cost long, audit string")
    audits = stored(audits, "audits")

    led = audits.select("conv", F.lit(-1).cast("long").alias("at"), "audit", F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("m"))
    lines = ordered.select("conv", "at", F.lit(None).cast("string").alias("audit"), "role", "text", "m")
    digests = led.unionByName(lines).repartition(parts, "conv").sortWithinPartitions("conv", "at").mapInArrow(
        _digests, f"conv {kind}, repaired_sha256 string")
    out = _same(_same(facts.drop("first_at", "last_at"), audits, ["conv"]), digests, ["conv"])
    return out.select(F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
