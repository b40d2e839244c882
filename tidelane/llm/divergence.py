"""Source divergence audit: how differently the sources of a language use its frequent terms.

Identical texts of a language are folded first, in the task that reads them and then in one exchange, with the number
of times each source has them, and each is cut into terms once, whatever its copies. Its counts and its presence, times
those numbers, are added up by (language, source, term) in a second exchange by language and term, behind which the
document frequencies are known too: only kept terms leave it. From there on all work is on their counts.

Two sources are compared through the terms that both have. A term that a source does not have has there the
probability of a count of zero, the same for all such terms, so the sum over all kept terms follows from sums over the
terms of each source and a correction for the shared ones; no row is made for a term and a source without it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelane.llm.words import LOWER, chunks
from tidelane.session import new_shared_path

MIN_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
PRIOR = 5
#: Bytes of text whose counts are added up before they leave Python.
CHUNK = 4 << 20

#: What a byte becomes before texts are cut at blanks: letters and all bytes above ASCII stay.
_TERM = LOWER.copy()
_TERM[[b for b in range(128) if not chr(b).isalpha()]] = 32


def term_table(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """For each text and different term of it: the text's number, the term's number in the list of terms (second), and how often."""
    owners, codes, counts, lists, base = [], [], [], [], 0
    for chunk in chunks(texts, CHUNK):
        data = pa.py_buffer(_TERM[chunk.data].tobytes())
        plain = pa.LargeStringArray.from_buffers(chunk.hi - chunk.lo, pa.py_buffer(chunk.offsets.tobytes()), data)
        cut = pc.split_pattern(plain, " ")
        coded = pc.list_flatten(cut).dictionary_encode()
        code, owner = coded.indices.to_numpy().astype(np.int64), pc.list_parent_indices(cut).to_numpy()
        size = max(len(coded.dictionary), 1)
        key, count = np.unique((owner + chunk.lo) * size + code, return_counts=True)
        full = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[key % size] if len(key) else np.zeros(0, bool)
        key, count = key[full], count[full]
        owners.append(key // size)
        codes.append(key % size + base)
        counts.append(count)
        lists.append(coded.dictionary)
        base += len(coded.dictionary)
    join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    return join(owners), pa.chunked_array(lists, pa.large_string()), join(codes), join(counts)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    for batch in batches:
        owner, terms, code, count = term_table(batch.column("text"))
        held = batch.column("sources")
        first, last = held.offsets.to_numpy()[:-1] - held.offsets[0].as_py(), held.offsets.to_numpy()[1:] - held.offsets[0].as_py()
        lists = held.flatten()
        times = lists.field("m").to_numpy(zero_copy_only=False)
        # one entry for each term of a text and source that has the text
        wide = (last - first)[owner]
        row = np.repeat(np.arange(len(owner)), wide)
        at = first[owner][row] + np.arange(len(row)) - np.repeat(np.cumsum(wide) - wide, wide)
        table = pa.table({
            "lang": batch.column("lang").dictionary_encode().take(pa.array(owner[row])),
            "source": lists.field("source").dictionary_encode().take(pa.array(at)),
            "code": pa.array(code[row]), "n": pa.array(count[row] * times[at]), "docs": pa.array(times[at]),
        })
        table = table.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ("docs", "sum")])
        columns = [table.column("lang").cast(pa.string()), table.column("source").cast(pa.string()),
                   terms.take(table.column("code")).cast(pa.string()), table.column("n_sum"), table.column("docs_sum")]
        yield from pa.table(dict(zip(names, columns, strict=True))).combine_chunks().to_batches()


def _fold_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch once, with their number ``m``: however hot a text is, a batch sends it on once a source."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["lang", "text", "source"]).aggregate([([], "count_all")])
        yield from table.rename_columns(["lang", "text", "source", "m"]).combine_chunks().to_batches()


def count_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, n_lang``: occurrences in the source and in the language of the terms that at least
    ``min_docs`` documents of the language have. Null values count as ''.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(plain(lang).alias("lang"), plain(text).alias("text"), plain(source).alias("source"))
    copies = rows.where(F.col("text").rlike(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]")).mapInArrow(
        _fold_copies, "lang string, text string, source string, m long")
    # Both groupings below need no exchange of their own: rows of a text, or of a term, are in one partition by then.
    folded = copies.repartition(parts, "lang", "text").groupBy("lang", "text").agg(
        F.collect_list(F.struct("source", "m")).alias("sources"))
    counted = folded.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    summed = counted.repartition(parts, "lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    summed = summed.withColumns({"n_lang": F.sum("n").over(whole), "docs_lang": F.sum("docs").over(whole)})
    return summed.where(F.col("docs_lang") >= min_docs).select("lang", "source", "term", "n", "n_lang")


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * kept)) in whole numbers of 38 digits; null without kept terms."""
    big = lambda c: c.cast("decimal(38,0)")
    over = big(n + PRIOR) * F.lit(SCALE).cast("decimal(10,0)")
    under = F.nullif(big(total + PRIOR * kept), F.lit(0).cast("decimal(38,0)"))
    return (F.call_function("div", over, under) + 1).cast("long")


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                      min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each source of a language, how far the other sources are from it
    (part ``pair``, all of them) and its ``top`` over-used terms (part ``term``).

    A language keeps the terms found in at least ``min_docs`` of its documents. A group gives each kept term the share
    ``1 + floor(10^9 (count + 5) / (N + 5 V))``; a pair's value is the sum of absolute differences over all kept terms
    (0 if none is kept), a term's is its share minus the language's, where that is positive and the group has the term.
    Ranks follow value from above, then the item's bytes. Null text, language or source count as ''; repeated rows are
    documents of their own; a group without terms takes part in pairs. Other columns are ignored; an empty table gives
    no rows. Counts and shares are exact up to 38 digits.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = new_shared_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    used = stored(count_terms(docs, text, lang, source, min_docs), "terms")
    sizes = used.groupBy("lang", "term").agg(F.max("n_lang").alias("n_lang")).groupBy("lang").agg(
        F.sum("n_lang").alias("total_lang"), F.count(F.lit(1)).alias("kept"))
    held = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    groups = docs.select(plain(lang).alias("lang"), plain(source).alias("source")).distinct().join(
        held, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "own", "total_lang", "kept"])
    groups = stored(groups.withColumn("zero", _share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))), "groups")
    shares = stored(used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _share(F.col("n_lang"), F.col("total_lang"), F.col("kept")).alias("q"), "zero"), "shares")

    # Sources of a language meet in ``parts`` pieces, so that one language is no single task.
    piece = F.pmod(F.xxhash64("source"), F.lit(parts)).cast("int")
    others = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_b"), F.col("own").alias("own_b"),
                           F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("piece"))

    def beside(df: DataFrame) -> DataFrame:
        return df.withColumn("piece", piece).join(others, ["lang", "piece"]).where(F.col("source") != F.col("item"))

    # What a's terms would differ if b had none of them; sources have few different counts.
    alone = beside(shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("c"))).groupBy(
        "lang", "source", "item").agg(F.sum(F.col("c") * F.abs(F.col("p") - F.col("zero_b"))).alias("alone"))
    b = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("p_b"), F.col("zero").alias("zero_b"))
    both = shares.select("lang", "term", "source", "p", "zero").join(b, ["lang", "term"]).where(F.col("source") < F.col("item"))
    mend = (F.abs(F.col("p") - F.col("p_b")) - F.abs(F.col("p") - F.col("zero_b")) - F.abs(F.col("p_b") - F.col("zero"))
            + F.abs(F.col("zero") - F.col("zero_b")))
    both = stored(both.groupBy("lang", "source", "item").agg(F.sum(mend).alias("mend")), "shared")
    turned = lambda df: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    alone = stored(alone.withColumnRenamed("alone", "value"), "alone")
    least = (F.col("kept") - F.col("own") - F.col("own_b")) * F.abs(F.col("zero") - F.col("zero_b"))
    pairs = beside(groups).select("lang", "source", "item", F.coalesce(least, F.lit(0)).alias("value"))
    mends = both.withColumnRenamed("mend", "value")
    sums = pairs.unionByName(alone).unionByName(turned(alone)).unionByName(mends).unionByName(turned(mends))
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    over = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(
        over.withColumn("part", F.lit("term")).select(columns))
