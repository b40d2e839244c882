"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items, one scan of the texts.

The automaton's alphabet is the benchmark's words, so a text is scanned once as a word sequence and every hit
maps back to the original text by the words' offsets. No shuffle: every text is judged where it was read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelane.llm.words import chunks, code_points, hash_words, words
from tidelane.session import new_shared_path

WINDOW = 13
#: Bytes of benchmark text in one automaton.
MAX_BLOCK_BYTES = 1 << 20
_built: dict[str, tuple[np.ndarray, object, int]] = {}


def windows(items: list[tuple[object, str]], size: int) -> dict[tuple[int, ...], set[str]]:
    """Word windows (as hashes) with the items they come from; a shorter item is one window."""
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        hashes = hash_words(text or "")
        for i in range(max(1, len(hashes) - size + 1) if hashes else 0):
            owners = found.setdefault(tuple(hashes[i : i + size]), set())
            if item is not None:
                owners.add(str(item))
    return found


def automaton(key: str, patterns: dict[tuple[int, ...], set[str]]) -> tuple[np.ndarray, object, int]:
    """Sorted word hashes, the automaton over their numbers, and the shortest window; built once per worker."""
    if key not in _built:
        vocabulary = np.array(sorted({h for p in patterns for h in p}), np.uint64)
        number = {int(h): i + 1 for i, h in enumerate(vocabulary)}
        machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for p, owners in patterns.items():
            machine.add_word(tuple(number[h] for h in p), (len(p), owners))
        if patterns:
            machine.make_automaton()
        _built.clear()
        _built[key] = vocabulary, machine, min(map(len, patterns), default=1)
    return _built[key]


def scan(numbers: np.ndarray, machine: object, shortest: int) -> tuple[np.ndarray, set[str]]:
    """Which words of one text are hit, and by which items. Words outside the vocabulary are 0 and end every match."""
    hit, items = np.zeros(len(numbers) + 1, np.int64), set()
    known = np.concatenate([[False], numbers > 0, [False]])
    turns = np.flatnonzero(known[1:] != known[:-1])
    for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
        if b - a >= shortest:
            for last, (length, owners) in machine.iter(tuple(numbers[a:b].tolist())):
                hit[a + last - length + 1] += 1
                hit[a + last + 1] -= 1
                items |= owners
    return np.cumsum(hit[:-1]) > 0, items


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def mark_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                   item_text: str = "text", size: int = WINDOW, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words, hit_runs, hit_items, hit_spans``; every column of ``docs`` stays.

    ``hit_runs`` holds ``[first, end)`` word runs inside any occurrence of a window, ``hit_spans`` the same as
    ``start:end`` code points of the original text, ``hit_items`` the items as strings, sorted. A null text or
    item has no words. An item that repeats counts once; one without an id marks words but is not listed.
    Columns of these four names in ``docs`` are replaced.

    The windows travel to the executors, so the benchmark's size is measured first: above ``max_block_bytes`` of
    text, which a worker holds as some 140 MB of automaton, it is split by hash into blocks of about that size. Each has a
    scan of its own that writes only the hits, by a hash of the text, and a last pass joins them to the rows.
    """
    spark = docs.sparkSession
    benchmark = benchmark.select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("item_text"))
    held = benchmark.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0)).alias("n")).first()["n"]
    blocks = 1 + held // max_block_bytes
    out = docs.withColumns({
        "n_words": F.lit(0).cast("long"), "hit_runs": F.array().cast("array<array<int>>"),
        "hit_items": F.array().cast("array<string>"), "hit_spans": F.array().cast("array<string>"),
    })

    def machine(own: DataFrame):
        return spark.sparkContext.broadcast(windows([(r["item"], r["item_text"]) for r in own.collect()], size))

    if blocks == 1:
        return out.mapInArrow(_marker(machine(benchmark), text), out.schema)
    name = {"t1": F.xxhash64(F.col(text)), "t2": F.xxhash64(F.lit(1), F.col(text))}
    texts = docs.select(F.col(text).cast("string").alias("text")).where("text is not null").withColumns(
        {"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})
    paths = []
    for b in range(blocks):
        own = benchmark.where(F.pmod(F.xxhash64("item_text"), F.lit(blocks)) == b)
        paths.append(new_shared_path(spark, "hits"))
        texts.mapInArrow(_hits(machine(own)), _HITS).distinct().write.parquet(paths[-1])
    found = spark.read.parquet(*paths).groupBy("t1", "t2").agg(
        F.flatten(F.collect_list("hit_runs")).alias("__runs"), F.array_distinct(F.flatten(F.collect_list("hit_items"))).alias("__items"))
    found = found.select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "__runs", "__items")
    joined = out.join(found, (name["t1"] == F.col("__t1")) & (name["t2"] == F.col("__t2")), "left").withColumns(
        {"hit_runs": F.coalesce("__runs", "hit_runs"), "hit_items": F.coalesce("__items", "hit_items")})
    marked = joined.select(out.columns)
    return marked.mapInArrow(_marker(None, text), out.schema)


_HITS = "t1 long, t2 long, hit_runs array<array<int>>, hit_items array<string>"


def _numbers(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The automaton's numbers of words, 0 for those it does not know."""
    if not len(vocabulary):
        return np.zeros(len(hashes), np.int64)
    at = np.searchsorted(vocabulary, hashes)
    known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes
    return np.where(known, at + 1, 0)


def _hits(sent):
    """Runs and items of the texts that one block of the benchmark hits."""
    key = uuid.uuid4().hex

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, machine, shortest = automaton(key, sent.value)
        for batch in batches:
            rows, found_runs, found_items = [], [], []
            for chunk in chunks(batch.column("text")):
                w = words(chunk)
                numbers = _numbers(vocabulary, w.hash)
                for i in range(chunk.hi - chunk.lo):
                    flags, items = scan(numbers[w.first[i] : w.first[i + 1]], machine, shortest)
                    if flags.any():
                        rows.append(chunk.lo + i)
                        found_runs.append(runs(flags))
                        found_items.append(sorted(items))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("t1").take(take), batch.column("t2").take(take),
                 pa.array(found_runs, pa.list_(pa.list_(pa.int32()))), pa.array(found_items, pa.list_(pa.string()))],
                ["t1", "t2", "hit_runs", "hit_items"])

    return hits


def _marker(sent, text: str):
    """The four columns, from the one automaton or, without it, from the hits that are there already."""
    key = uuid.uuid4().hex

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, machine, shortest = automaton(key, sent.value) if sent else (None, None, 0)
        for batch in batches:
            counts, hit_runs, hit_items, spans = [], [], [], []
            before = None if sent else [batch.column(c).to_pylist() for c in ("hit_runs", "hit_items")]
            for chunk in chunks(batch.column(text)):
                w = words(chunk)
                numbers = _numbers(vocabulary, w.hash) if sent else None
                points = None
                for i in range(chunk.hi - chunk.lo):
                    a, b = w.first[i], w.first[i + 1]
                    if sent:
                        flags, items = scan(numbers[a:b], machine, shortest)
                    else:
                        flags, items = np.zeros(b - a, bool), set(before[1][chunk.lo + i])
                        for x, y in before[0][chunk.lo + i]:
                            flags[x:y] = True
                    found = runs(flags)
                    if found and points is None:
                        points = code_points(chunk.data)
                    base = points[chunk.offsets[i]] if found else 0
                    counts.append(int(b - a))
                    hit_runs.append(found)
                    hit_items.append(sorted(items))
                    spans.append([f"{points[w.start[a + x]] - base}:{points[w.end[a + y - 1]] - base}" for x, y in found])
            new = {
                "n_words": pa.array(counts, pa.int64()), "hit_runs": pa.array(hit_runs, pa.list_(pa.list_(pa.int32()))),
                "hit_items": pa.array(hit_items, pa.list_(pa.string())), "hit_spans": pa.array(spans, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in batch.schema.names], batch.schema.names)

    return mark


def contamination(marked: DataFrame) -> DataFrame:
    """``n_hit, n_items, items_sha256, contaminated`` beside the columns of :func:`mark_benchmark`.

    A document is contaminated if words are hit and they are at least one in twenty.
    """
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda a, r: a + (r[1] - r[0]).cast("long"))
    return marked.withColumns({
        "n_hit": n_hit,
        "n_items": F.size("hit_items").cast("long"),
        "items_sha256": F.sha2(F.array_join("hit_items", ","), 256),
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
