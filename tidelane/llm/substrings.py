"""Removal of repeated substrings: every byte covered by a ``SIZE``-byte string that starts in two places.

Suffixes are sorted blockwise, one bucket at a time, and long ties are resolved by ranks of cover samples computed
beforehand. Three things keep that in proportion to the repeated text instead of to all suffixes:

* A suffix belongs to the bucket of its anchor, the 64-byte gram of least hash in its first ``SIZE`` bytes (the
  leftmost of equals), and of its distance to it. Equal strings have equal anchors at equal distances, so
  repeats never cross buckets, and buckets whose anchor occurs once are never sorted.
* The suffixes of one anchor occurrence form a run. If the run's whole span occurs elsewhere at the same
  anchor, all its strings repeat, which counting equal spans finds. Only other runs go on to be sorted.
* In a bucket all suffixes lie alike to the anchor, so the difference cover needs one residue: samples at every
  ``PERIOD``-th byte from the anchor. Sample ranks are built by doubling from sorted blocks; a suffix of a bucket is
  ordered by the rank of its next sample and, in ties, by the less than ``PERIOD`` bytes that this leaves.

The sort compares bytes. Hashes decide anchors and, in 128 bits, equal spans and equal texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelane.llm.words import Text, chunks, mix, powers, prefix_sums
from tidelane.session import new_shared_path

SIZE = 400
GRAM = 64
PERIOD = 25
#: Rows of anchor occurrences that are sorted together, and strings held at once.
BLOCK_ROWS = 4096
BLOCK_STRINGS = 1 << 20
#: Anchors with more different spans than this are counted string by string in Spark instead of in one task: a bucket of
#: so many spans, sorted, takes a worker some 250 MB, and the count gives the same result.
HOT_SPANS = 20_000
#: Texts that a task remembers to fold repeats before they are shuffled.
SEEN = 1 << 18
PLACE_BITS = 24
PIECE = 1 << 23


def anchor_runs(text: Text, size: int = SIZE) -> tuple[np.ndarray, ...]:
    """For every run of strings with one anchor: text, anchor, first and last start (in that text), anchor hash, span hash."""
    data, offsets = text.data, text.offsets
    found = [_runs(data, offsets, lo, min(lo + PIECE + size - 1, len(data)), size) for lo in range(0, max(len(data), 1), PIECE)]
    owner, anchor, first, last, gram, span = (np.concatenate(c) for c in zip(*found, strict=True))
    begin = offsets[:-1][owner]
    return owner, anchor - begin, first - begin, last - begin, gram, span


def _runs(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, size: int) -> tuple[np.ndarray, ...]:
    piece = data[lo:hi]
    n, wide = len(piece), size - GRAM + 1
    empty = np.zeros(0, np.int64)
    if n < size:
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    sums, back = prefix_sums(piece), powers(n + 1, True)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * back[: n - GRAM + 1])
    places = np.uint64(PLACE_BITS)
    packed = (grams >> places << places) | np.arange(len(grams), dtype=np.uint64)
    blocks = -(-len(packed) // wide)
    padded = np.full(blocks * wide, ~np.uint64(0))
    padded[: len(packed)] = packed
    padded = padded.reshape(blocks, wide)
    after = np.minimum.accumulate(padded, axis=1).ravel()
    before = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - size + 1
    least = np.minimum(before[:starts], after[wide - 1 : wide - 1 + starts])
    anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    start = np.arange(starts)
    owner = np.searchsorted(offsets, start + lo, side="right") - 1
    valid = start + lo + size <= offsets[owner + 1]
    valid &= start < PIECE
    new = np.ones(starts, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    ends = np.ones(starts, bool)
    ends[:-1] = new[1:] | ~valid[1:]
    last = np.flatnonzero(ends & valid)
    span = mix((sums[last + size] - sums[first]) * back[first])
    return owner[first], anchor[first] + lo, first + lo, last + lo, grams[anchor[first]], span


def _anchors(size: int):
    names = ["h", "t1", "t2", "a", "dl", "dr", "s"]

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t1", "t2")]
            for chunk in chunks(batch.column("text")):
                owner, anchor, first, last, gram, span = anchor_runs(chunk, size)
                yield pa.RecordBatch.from_arrays([
                    pa.array(gram.view(np.int64)), *[pa.array(k[chunk.lo + owner]) for k in keys], pa.array(anchor),
                    pa.array((anchor - first).astype(np.int32)), pa.array((last - anchor).astype(np.int32)),
                    pa.array(span.view(np.int64)),
                ], names)

    return anchors


def _contexts(size: int):
    """The span of every open anchor occurrence of a text: the bytes from its run's first start to its last end."""
    names = ["h", "t1", "t2", "a", "dl", "dr", "c", "span"]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for t1, t2, text, runs in zip(*(batch.column(c) for c in ("t1", "t2", "text", "runs")), strict=True):
                data = None
                for r in runs.as_py():
                    if r["open"]:
                        data = text.as_py().encode() if data is None else data
                        span = data[r["a"] - r["dl"] : r["a"] + r["dr"] + size]
                        rows.append((r["h"], t1.as_py(), t2.as_py(), r["a"], r["dl"], r["dr"], r["c"], span))
                        held += len(span)
                if held > 4 << 20:
                    yield _batch(rows, names)
                    rows, held = [], 0
            yield _batch(rows, names)

    def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), pa.binary()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return contexts


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text the task has not sent on yet (of those it remembers), so that a hot text is shuffled once a task."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        keep = []
        for i, name in enumerate(zip(batch.column("t1").to_pylist(), batch.column("t2").to_pylist(), strict=True)):
            if name not in seen:
                keep.append(i)
                if len(seen) < SEEN:
                    seen.add(name)
        yield batch.take(pa.array(keep, pa.int64()))


def _words(table: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian numbers, most significant first, padded with zeros."""
    wide = np.zeros((len(table), -(-table.shape[1] // 8) * 8), np.uint8)
    wide[:, : table.shape[1]] = table
    return list(np.ascontiguousarray(wide).view(">u8").astype(np.uint64).T)


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks of rows by ``keys``, most significant first; equal rows have equal ranks."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def repeated_starts(bucket: np.ndarray, left: np.ndarray, right: np.ndarray, spans: list[bytes],
                    size: int = SIZE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and distances from the anchor of the strings that two rows share, a range of distances at a time.

    ``bucket`` numbers the anchors; a row's strings start ``left`` bytes before its anchor to ``right`` after it.
    """
    data = np.frombuffer(b"".join(spans) + bytes(PERIOD), np.uint8)
    length = np.array([len(s) for s in spans])
    anchor = np.cumsum(length) - length + left
    low = -(left // PERIOD)
    number = (right + size) // PERIOD - low
    row = np.repeat(np.arange(len(spans)), number)
    begin = np.cumsum(number) - number
    place = anchor[row] + PERIOD * (low[row] + np.arange(len(row)) - begin[row])
    one = _ranks(_words(data[place[:, None] + np.arange(PERIOD)]))

    def joined(rank: np.ndarray, step: int) -> np.ndarray:
        """Ranks of a sample's blocks followed by those of the sample ``step`` on; -1 where the row ends before."""
        out = np.full(len(rank), -1)
        inside = np.flatnonzero(row[: len(row) - step] == row[step:]) if len(row) > step else np.zeros(0, int)
        inside = inside[(rank[inside] >= 0) & (rank[inside + step] >= 0)]
        out[inside] = np.unique(rank[inside] * (len(rank) + 1) + rank[inside + step], return_inverse=True)[1]
        return out

    blocks, known = size // PERIOD, {1: one}
    reach = 1
    while reach * 2 <= blocks - 1:
        known[reach * 2] = joined(known[reach], reach)
        reach *= 2
    short = joined(known[reach], blocks - 1 - reach) if reach < blocks - 1 else known[reach]
    whole = joined(known[reach], blocks - reach)
    width = max(1, BLOCK_STRINGS // len(spans))
    for x0 in range(-int(left.max()), int(right.max()) + 1, width):
        x1 = min(x0 + width, int(right.max()) + 1)
        a, b = np.maximum(x0, -left), np.minimum(x1, right + 1)
        count = np.maximum(b - a, 0)
        own = np.repeat(np.arange(len(spans)), count)
        x = a[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        if not len(x):
            continue
        k = -((-x) // PERIOD)
        rest = PERIOD * k - x
        sample = begin[own] + k - low[own]
        rank = np.where(rest == 0, whole[sample], short[sample])
        key = (bucket[own] * (2 * size) + x + size) * (len(row) + 1) + rank
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        tied = np.zeros(len(order), bool)
        tied[1:] |= same
        tied[:-1] |= same
        pick = order[tied]
        if not len(pick):
            continue
        at, over = anchor[own[pick]] + x[pick], rest[pick]
        spread = np.arange(PERIOD)
        # before the first sample, then behind the last block: together PERIOD bytes, or none if a sample starts it
        where = at[:, None] + np.where(spread < over[:, None], spread, spread + size - PERIOD)
        table = data[where]
        table[over == 0] = 0
        ranks = _ranks([key[pick].astype(np.uint64), *_words(table)])
        twice = np.bincount(ranks)[ranks] > 1
        yield own[pick[twice]], x[pick[twice]]


def _sort(size: int):
    """Repeated strings of open anchors, whose rows arrive bucket by bucket."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        h, t1, t2, a, dl, dr, c, spans = zip(*rows, strict=True)
        bucket = np.unique(np.array(h), return_inverse=True)[1]
        out = [np.zeros(0, np.int64)] * 4
        for own, x in repeated_starts(bucket, np.array(dl), np.array(dr), list(spans), size):
            single = np.array(c)[own] == 1
            own, x = own[single], x[single]
            order = np.lexsort((x, own))
            own, x = own[order], x[order]
            if len(own):
                cut = np.flatnonzero((own[1:] != own[:-1]) | (x[1:] != x[:-1] + 1))
                first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(own) - 1]])
                place = np.array(a)[own[first]]
                new = np.array(t1)[own[first]], np.array(t2)[own[first]], place + x[first], place + x[last] + size
                out = [np.concatenate([p, q]) for p, q in zip(out, new, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(o.astype(np.int64)) for o in out], ["t1", "t2", "lo", "hi"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        whole = 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if held and held[-1][0] != r[0]:
                    whole = len(held)
                    if whole >= BLOCK_ROWS:
                        yield block(held)
                        held = []
                held.append(r)
        if held:
            yield block(held)

    return sort


def _strings(size: int):
    """Every string of a hot anchor's spans as a 128-bit digest."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t1, t2, a, dl, c, span in zip(*(batch.column(k).to_pylist() for k in ("t1", "t2", "a", "dl", "c", "span")),
                                              strict=True):
                n = len(span) - size + 1
                digests = b"".join(hashlib.blake2b(span[i : i + size], digest_size=16).digest() for i in range(n))
                d = np.frombuffer(digests, np.int64).reshape(n, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(d[:, 0])), pa.array(np.ascontiguousarray(d[:, 1])), pa.array(np.full(n, t1)),
                     pa.array(np.full(n, t2)), pa.array(a - dl + np.arange(n)), pa.array(np.full(n, c))],
                    ["d1", "d2", "t1", "t2", "lo", "c"])

    return strings


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for t1, t2, text, spans in zip(*(batch.column(c) for c in ("t1", "t2", "text", "spans")), strict=True):
            data, merged = text.as_py().encode(), []
            for lo, hi in sorted((s["lo"], s["hi"]) for s in spans.as_py()):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(hi, merged[-1][1])
                else:
                    merged.append([lo, hi])
            kept, at, digest = [], 0, hashlib.sha256()
            for lo, hi in merged:
                digest.update(data[at:lo])
                kept.append(data[at:lo])
                at = hi
            digest.update(data[at:])
            out.append((t1.as_py(), t2.as_py(), sum(hi - lo for lo, hi in merged), len(merged), digest.hexdigest(),
                        b"".join([*kept, data[at:]])))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        columns = list(zip(*out, strict=True)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                                         ["t1", "t2", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SIZE, hot: int = HOT_SPANS,
                   keep_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``key, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept``.

    Texts are bytes in UTF-8 (null: empty); a string never crosses texts. ``size`` must be a multiple of ``PERIOD``,
    over ``GRAM``. ``n_spans``: maximal removed runs. ``kept`` is null where nothing is removed, else the bytes that
    remain, which may begin or end within a character. Repeated rows repeat each other. Other columns are ignored.
    Anchors with over ``hot`` different spans are counted instead of sorted (see ``HOT_SPANS``); the result is the same.
    """
    if size % PERIOD or size <= GRAM or size < 4 * PERIOD:
        raise ValueError(f"size must be a multiple of {PERIOD} over {GRAM}")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = docs.select(F.col(key).alias("doc_id"), plain.alias("text")).withColumns(
        {"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = new_shared_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    anchors = stored(source.where(F.octet_length("text") >= size).select("text", "t1", "t2").mapInArrow(
        _anchors(size), "h long, t1 long, t2 long, a long, dl int, dr int, s long"), "anchors")
    # Counts by anchor are written before they are joined: a join that is not also an aggregate can be split at a hot one.
    often = stored(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "often")
    repeated = stored(anchors.join(often, "h"), "repeated")
    same = repeated.groupBy("h", "dl", "dr", "s").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("t1", "t2", "a")).alias("one"))
    same = stored(same, "spans")
    kinds = same.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("least"))
    kinds = stored(kinds.where("m > 1 and least = 1").select("h", "m"), "kinds")
    open_ = same.join(kinds, "h").select(
        F.col("one.t1").alias("t1"), F.col("one.t2").alias("t2"), "h", F.col("one.a").alias("a"), "dl", "dr", "c", "m")
    whole = repeated.join(same.where("c > 1").select("h", "dl", "dr", "s"), ["h", "dl", "dr", "s"]).select(
        "t1", "t2", (F.col("a") - F.col("dl")).alias("lo"), (F.col("a") + F.col("dr") + size).alias("hi")).distinct()

    # Texts with a repeated anchor, once each, with their open runs: only these are read again.
    run = F.struct("h", "a", "dl", "dr", "c", "m", F.lit(True).alias("open"))
    runs = open_.groupBy("t1", "t2").agg(F.collect_list(run).alias("runs"))
    listed = repeated.select("t1", "t2").distinct().join(runs, ["t1", "t2"], "left").select(
        "t1", "t2", F.coalesce("runs", F.array().cast(
            "array<struct<h:bigint,a:bigint,dl:int,dr:int,c:bigint,m:bigint,open:boolean>>")).alias("runs"))
    once = source.where(F.octet_length("text") >= size).select("t1", "t2", "text").mapInArrow(_once, "t1 long, t2 long, text string")
    # A sorted join at every size: its rows are in place for folding what several tasks sent.
    texts = stored(once.join(listed.hint("merge"), ["t1", "t2"]).dropDuplicates(["t1", "t2"]), "texts")

    def contexts(which) -> DataFrame:
        chosen = texts.withColumn("runs", F.filter("runs", which)).where(F.size("runs") > 0)
        return chosen.select("t1", "t2", "text", "runs").mapInArrow(
            _contexts(size), "h long, t1 long, t2 long, a long, dl int, dr int, c long, span binary")

    sorted_ = contexts(lambda r: r["m"] <= hot).repartition(parts, "h").sortWithinPartitions("h").mapInArrow(
        _sort(size), "t1 long, t2 long, lo long, hi long")
    spans = whole.unionByName(sorted_)
    if open_.where(F.col("m") > hot).limit(1).count():
        strings = stored(contexts(lambda r: r["m"] > hot).mapInArrow(
            _strings(size), "d1 long, d2 long, t1 long, t2 long, lo long, c long").distinct(), "strings")
        twice = strings.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2")
        spans = spans.unionByName(strings.where("c = 1").join(twice, ["d1", "d2"]).select(
            "t1", "t2", "lo", (F.col("lo") + size).alias("hi")))
    per_text = spans.groupBy("t1", "t2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    cut = texts.select("t1", "t2", "text").join(per_text, ["t1", "t2"]).mapInArrow(
        _cut, "t1 long, t2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    cut = cut if keep_bytes else cut.drop("kept")
    rows = source.select("doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"),
                         F.sha2(F.col("text").cast("binary"), 256).alias("all_sha256"))
    return rows.join(cut, ["t1", "t2"], "left").select(
        F.col("doc_id").alias(key), "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"), *(["kept"] if keep_bytes else []),
    )
