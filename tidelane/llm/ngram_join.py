"""Self-join of documents on the Jaccard similarity of their word n-grams, with Bayesian candidate pruning.

Documents with the same set of n-grams are one class, compared once. Two classes are candidates if they agree in a
MinHash band; at 32 bands of 4 a pair of similarity 0.8 is missed with probability 5e-8. Candidates compare their
MinHash values a few at a time; a pair is dropped as soon as the posterior probability that its similarity reaches the
threshold falls below ``TOLERANCE``; the rest are verified on the whole sets.

No pair is ever a row. Buckets with the same members are kept once; a bucket's members meet in a task, large buckets
as pairs of blocks of bounded size; a pair counts in the first bucket its two share. A task gives each member's number of
links and the least member it is linked to through others, and these few edges are joined to groups. A member of a
bucket of m different classes is sent, with its n-grams, to m / ``BLOCK_ROWS`` tasks, since every pair of them may be a link
that has to be counted: the work of one bucket grows with the square of its classes, in tasks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelane.llm.words import chunks, mix, shingles, words
from tidelane.session import new_shared_path

N = 5
THRESHOLD = (4, 5)
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-7
#: Members and n-grams of a block; two blocks meet in a task.
BLOCK_ROWS = 512
BLOCK_GRAMS = 1 << 20

_random = np.random.default_rng(20240229)
_A = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def min_hashes(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (texts, HASHES) of texts that each have a gram; ``first`` has where each text's grams begin."""
    low = (grams >> np.uint64(17)).astype(np.uint32)
    out = np.empty((len(first), HASHES), np.uint32)
    for j in range(HASHES):
        out[:, j] = np.minimum.reduceat(low * _A[j] + _B[j], first)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """A 64-bit bucket for each band (texts, BANDS)."""
    key = np.zeros((len(values), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, r::ROWS].astype(np.uint64))
    return key


def distinct_grams(grams: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's grams sorted and once, and where they begin (one more than texts)."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(first) - 1))])


def least_matches(threshold: float, tolerance: float = TOLERANCE, step: int = STEP) -> list[int]:
    """Fewest agreeing values after each step that keep a pair.

    With a uniform prior the posterior after m of n agree is Beta(m + 1, n - m + 1), whose upper tail at the
    threshold is the lower tail of a binomial with n + 1 trials.
    """
    out = []
    for n in range(step, HASHES + 1, step):
        tail, m = 0.0, 0
        while True:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def _set_sums(grams: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two sums of hashes over each text's set of grams: with its size they name the set."""
    full = np.flatnonzero(np.diff(first))
    sums = [np.zeros(len(first) - 1, np.uint64) for _ in range(2)]
    if len(full):
        for i, salt in enumerate((0x1234567, 0x89ABCDEF)):
            sums[i][full] = np.add.reduceat(mix(grams + np.uint64(salt)), first[:-1][full])
    return [x.view(np.int64) for x in sums]


#: Rows whose sets a task remembers to fold repeats before they are shuffled.
SEEN = 1 << 18


def _named(n: int):
    """``doc_id, text`` with the sums and size of the text's set; rows without either go, repeats in a task mostly too."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            ids = batch.column("doc_id")
            for chunk in chunks(batch.column("text")):
                grams, first = distinct_grams(*shingles(words(chunk), n))
                count, (f1, f2) = np.diff(first), _set_sums(grams, first)
                own = ids.slice(chunk.lo, chunk.hi - chunk.lo)
                keep = []
                for i, name in enumerate(zip(own.to_pylist(), f1.tolist(), f2.tolist(), count.tolist(), strict=True)):
                    if name[0] is not None and name[3] and name not in seen:
                        keep.append(i)
                        if len(seen) < SEEN:
                            seen.add(name)
                take = pa.array(keep, pa.int64())
                columns = [own, pa.array(f1), pa.array(f2), pa.array(count.astype(np.int64)),
                           batch.column("text").slice(chunk.lo, chunk.hi - chunk.lo)]
                yield pa.RecordBatch.from_arrays([c.take(take) for c in columns], ["doc_id", "f1", "f2", "n", "text"])

    return named


def _sketch(n: int, key: str, text: str):
    names = ["doc_id", "t", "n", "f1", "f2", "bands"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names_of = batch.column(key), batch.column("t")
            for chunk in chunks(batch.column(text)):
                grams, first = distinct_grams(*shingles(words(chunk), n))
                count = np.diff(first)
                full = np.flatnonzero(count)
                sums = _set_sums(grams, first)
                bands = np.zeros((len(full), BANDS), np.uint64)
                if len(full):
                    bands = band_keys(min_hashes(grams, first[:-1][full]))
                begin = np.concatenate([[0], np.cumsum(np.where(count > 0, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(chunk.lo, chunk.hi - chunk.lo), names_of.slice(chunk.lo, chunk.hi - chunk.lo),
                    pa.array(count.astype(np.int64)), *[pa.array(s) for s in sums],
                    pa.ListArray.from_arrays(pa.array(begin), pa.array(bands.ravel().view(np.int64))),
                ], names)

    return sketch


_UNIT = "unit long, half int, rep binary, grams binary, sig binary, kept binary, band int"


def _members(n: int):
    """Rows of a document for every unit it belongs to: its grams, MinHash values, and the kept bucket of each band."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, buckets = batch.column("rep").to_pylist(), batch.column("buckets").to_pylist()
            for chunk in chunks(batch.column("text"), 256 << 10):
                grams, first = distinct_grams(*shingles(words(chunk), n))
                values = min_hashes(grams, first[:-1])
                rows = []
                for i in range(chunk.hi - chunk.lo):
                    rep = reps[chunk.lo + i]
                    kept = np.zeros(BANDS, np.int64)
                    for b in buckets[chunk.lo + i]:
                        kept[b["band"]] = b["bucket"]
                    own = grams[first[i] : first[i + 1]].tobytes(), values[i].tobytes(), kept.tobytes()
                    for b in buckets[chunk.lo + i]:
                        blocks = b["blocks"]
                        mine = int(mix(np.frombuffer(rep, np.uint64)).sum() % np.uint64(blocks))
                        for other in range(blocks):
                            lo, hi = min(mine, other), max(mine, other)
                            unit = np.array([b["bucket"]], np.int64).view(np.uint64) + np.uint64(lo * blocks + hi)
                            rows.append((int(mix(unit).view(np.int64)[0]) if blocks > 1 else b["bucket"],
                                         -1 if lo == hi else int(mine == hi), rep, *own, b["band"]))
                if rows:
                    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32())
                    for at in range(0, len(rows), 2000):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows[at : at + 2000], strict=True), kinds, strict=True)],
                            ["unit", "half", "rep", "grams", "sig", "kept", "band"],
                        )

    return members


def _unit_links(rows: list[tuple], threshold: tuple[int, int], least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of links of a unit's members, and for each the first member it is connected to."""
    halves = np.array([r[1] for r in rows])
    size = np.array([len(r[3]) // 8 for r in rows])
    sig = np.frombuffer(b"".join(r[4] for r in rows), np.uint32).reshape(len(rows), HASHES)
    kept = np.frombuffer(b"".join(r[5] for r in rows), np.int64).reshape(len(rows), BANDS)
    band, (part, whole) = rows[0][6], threshold
    if halves[0] < 0:
        x, y = np.triu_indices(len(rows), 1)
    else:
        a, b = np.flatnonzero(halves == 0), np.flatnonzero(halves == 1)
        x, y = (i.ravel() for i in np.meshgrid(a, b, indexing="ij"))
    small, large = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
    alive = small * whole >= part * large
    x, y = x[alive], y[alive]
    for earlier in range(band):
        if len(x):
            here = kept[x, earlier]
            alive = (here == 0) | (here != kept[y, earlier])
            x, y = x[alive], y[alive]
    matches = np.zeros(len(x), np.int64)
    for i, need in enumerate(least):
        own = slice(i * STEP, (i + 1) * STEP)
        for at in range(0, len(x), 1 << 16):
            cut = slice(at, at + (1 << 16))
            matches[cut] += (sig[x[cut], own] == sig[y[cut], own]).sum(1)
        alive = matches >= need
        x, y, matches = x[alive], y[alive], matches[alive]
    if len(x):
        both = _common(rows, x, y)
        linked = whole * both >= part * (size[x] + size[y] - both)
        x, y = x[linked], y[linked]
    count = np.bincount(x, minlength=len(rows)) + np.bincount(y, minlength=len(rows))
    root = np.arange(len(rows))
    while len(x):
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if (root == before).all():
            break
    return count, root


def _common(rows: list[tuple], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets: merged one by one, or as bit sets where there are many pairs."""
    sets = {i: np.frombuffer(rows[i][3], np.uint64) for i in np.unique(np.concatenate([x, y])).tolist()}
    if len(x) > 2 * len(sets):
        place = {i: k for k, i in enumerate(sets)}
        values, inverse, n = np.unique(np.concatenate(list(sets.values())), return_inverse=True, return_counts=True)
        shared = np.flatnonzero(n > 1)
        width = -(-len(shared) // 64) or 1
        if len(sets) * width * 8 <= 128 << 20:
            column = np.full(len(values), -1)
            column[shared] = np.arange(len(shared))
            column = column[inverse]
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets.values()])
            bits = np.zeros((len(sets), width * 64), bool) if len(sets) * width * 64 <= 64 << 20 else None
            if bits is not None:
                bits[owner[column >= 0], column[column >= 0]] = True
                packed = np.packbits(bits, axis=1).view(np.uint64)
                a, b = (np.array([place[i] for i in p.tolist()]) for p in (x, y))
                out = np.zeros(len(x), np.int64)
                some = max(1, (4 << 20) // (8 * width))
                for at in range(0, len(x), some):
                    cut = slice(at, at + some)
                    out[cut] = np.bitwise_count(packed[a[cut]] & packed[b[cut]]).sum(1)
                return out
    return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in
                     zip(x.tolist(), y.tolist(), strict=True)], np.int64)


def _link(threshold: tuple[int, int]):
    least = least_matches(threshold[0] / threshold[1])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, int, bytes]] = []
        held: list[tuple] = []

        def finish() -> None:
            if len(held) > 1:
                count, root = _unit_links(held, threshold, least)
                for i in np.flatnonzero(count).tolist():
                    out.append((held[i][2], int(count[i]), held[root[i]][2]))
            held.clear()

        def give() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True) if out else ([], [], []),
                                                      (pa.binary(), pa.int64(), pa.binary()), strict=True)],
                ["rep", "links", "root"])
            out.clear()
            return batch

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("unit", "half", "rep", "grams", "sig", "kept", "band")]
            for row in zip(*columns, strict=True):
                if held and held[0][0] != row[0]:
                    finish()
                held.append(row)
            if len(out) > 10_000:
                yield give()
        finish()
        yield give()

    return link


def group_nodes(edges: DataFrame) -> DataFrame:
    """Groups of ``(a, b)`` edges: ``node, group`` with the least node of each connected component.

    Least labels pass along the edges and then jump to their own label's label; each round is written to the
    shared folder, and the rounds end when no label changes.
    """
    spark = edges.sparkSession
    path = new_shared_path(spark, "edges")
    both = edges.where("a <> b").select("a", "b")
    both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().write.parquet(path)
    both = spark.read.parquet(path)
    path = new_shared_path(spark, "labels")
    both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("group")).write.parquet(path)
    while True:
        labels = spark.read.parquet(path)
        near = both.join(labels.select(F.col("node").alias("b"), F.col("group").alias("g")), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("g").alias("g"))
        passed = labels.join(near, "node").select("node", F.col("group").alias("old"), F.least("group", "g").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("group").alias("far"))
        path = new_shared_path(spark, "labels")
        passed.join(jump, "to").select("node", F.least("to", "far").alias("group"), "old").write.parquet(path)
        if not spark.read.parquet(path).where(F.col("group") != F.col("old")).limit(1).count():
            return spark.read.parquet(path).select("node", "group")


def _name(*columns: str) -> Column:
    """The values (long) as bytes that are ordered as they are: classes have equal names only if they are one."""
    return F.concat(*[F.unhex(F.lpad(F.hex(F.col(c).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")) for c in columns])


def row_name(text: str) -> Column:
    """What tells rows of one key apart: a hash of the text."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def join_similar(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = N,
                 threshold: tuple[int, int] = THRESHOLD, mark_first: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``key, class_id, rep_id, n_copies, n_links``.

    ``rep_id``: the least key among documents with the same set of word n-grams, ``n_copies`` how many those are.
    ``n_links``: how many other such classes have a Jaccard similarity of at least ``threshold`` (a fraction) with it.
    ``class_id``: the least key of all documents connected by copies and links. A text of fewer than ``n`` words is
    one n-gram. A text without words, or a row without a key, is in no class: ``class_id`` and ``rep_id`` are its key,
    with one copy and no link. ``key`` must be an integer; rows that share it count as copies of one document if their
    texts are equal. Other columns are ignored.

    ``mark_first`` adds ``row_name`` (:func:`row_name`, which with the key names a row) and ``is_first``: whether the row
    is the one to keep of its connected documents, that of the least key and then name. A repeated row is marked like
    the row it repeats; a row in no class is its own first.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                         row_name(text).alias("t"))
    path = new_shared_path(spark, "sketches")
    source.mapInArrow(_sketch(n, "doc_id", "text"), "doc_id long, t long, n long, f1 long, f2 long, bands array<long>").write.parquet(path)
    sketch = spark.read.parquet(path)
    path = new_shared_path(spark, "classes")
    sketch.where("n > 0 and doc_id is not null").groupBy("f1", "f2", "n").agg(
        F.min(F.struct("doc_id", "t")).alias("least"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands")
    ).select("f1", "f2", "n", "n_copies", "bands", F.col("least.doc_id").alias("least"), F.col("least.t").alias("least_t")).withColumn("rep", _name("least", "f1", "f2", "n")).write.parquet(path)
    classes = spark.read.parquet(path)

    found = classes.select("rep", "n", F.posexplode("bands").alias("band", "bucket"))
    buckets = found.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams"),
        F.bit_xor(F.xxhash64("rep")).alias("x1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x2"),
    ).where("m > 1").groupBy("m", "grams", "x1", "x2").agg(F.min("bucket").alias("bucket"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    path = new_shared_path(spark, "buckets")
    buckets.select("bucket", blocks.alias("blocks")).write.parquet(path)
    listed = found.join(spark.read.parquet(path), "bucket").groupBy("rep").agg(
        F.collect_list(F.struct("bucket", "band", "blocks")).alias("buckets"))
    path = new_shared_path(spark, "candidates")
    listed.write.parquet(path)

    # Always a sorted join: the texts are shuffled once at every size, so that a small run shows what a large one needs.
    # A class has one row there, whatever rows repeat: they are folded before the shuffle and again behind it.
    own = ["doc_id", "f1", "f2", "n"]
    texts = source.select("doc_id", "text").mapInArrow(_named(n), "doc_id long, f1 long, f2 long, n long, text string")
    listed = spark.read.parquet(path).join(classes.select("rep", F.col("least").alias("doc_id"), "f1", "f2", "n"), "rep")
    once = texts.join(listed.hint("merge"), own).dropDuplicates(own).select("rep", "text", "buckets")
    units = once.mapInArrow(_members(n), _UNIT)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = units.repartition(parts, "unit").sortWithinPartitions("unit", "rep").mapInArrow(
        _link(threshold), "rep binary, links long, root binary")
    path = new_shared_path(spark, "links")
    links.write.parquet(path)
    links = spark.read.parquet(path)
    groups = group_nodes(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    least = lambda name: F.conv(F.hex(F.substring(name, 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    counted = links.groupBy("rep").agg(F.sum("links").alias("n_links"))
    named = classes.drop("bands").join(counted, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left").select(
        "f1", "f2", "n", least(F.coalesce("group", "rep")).alias("class_id"), F.col("least").alias("rep_id"), "n_copies",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "least_t",
        (F.coalesce("group", "rep") == F.col("rep")).alias("leads"),
    )
    columns = ["doc_id", "class_id", "rep_id", "n_copies", "n_links", *(["row_name", "is_first"] if mark_first else [])]
    none = F.lit(0).cast("long")
    alone = sketch.where("n = 0 or doc_id is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("rep_id"), (none + 1).alias("n_copies"),
        none.alias("n_links"), F.col("t").alias("row_name"), F.lit(True).alias("is_first"))
    first = F.col("leads") & (F.col("doc_id") == F.col("rep_id")) & (F.col("t") == F.col("least_t"))
    joined = sketch.where("n > 0 and doc_id is not null").select("doc_id", "t", "f1", "f2", "n").join(named, ["f1", "f2", "n"])
    joined = joined.withColumn("is_first", first).withColumnRenamed("t", "row_name")
    return joined.select(columns).unionByName(alone.select(columns)).withColumnRenamed("doc_id", key)
