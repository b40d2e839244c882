"""License scans by diagonal voting, in DataFrame functions only.

Every rolling word 2-gram and 4-gram of every text is hashed and joined to the positions at which license
templates hold the same gram. A pair votes for the diagonal (place in text - place in template); votes are summed
by diagonal, neighbouring diagonals of a long template are merged (an inserted or missing word moves the
diagonal), and a span is reported if enough of the template's words are verified in it. The join compares the
words themselves beside the hash, so every vote is a verified run of words.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases counted place by place (fixed values), then longer templates found approximately.
PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2.0",
    "apache-2.0-notice": "you may not use this file except in compliance with the license you may obtain a copy of "
    "the license at",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files to deal in the software without restriction",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "warranty": "the software is provided as is without warranty of any kind express or implied",
    # Whole notices, as they stand in files.
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.",
    "bsd-3-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
    "contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission.",
    "apache-2.0-text": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
    "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.",
    "gpl-3-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
    "General Public License for more details.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "disclaimer-text": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE.",
}
LONG = 4
MERGE = 3
SHARE = 0.75


def text_words(text: str | Column) -> Column:
    """The words of a text after A-Z became a-z; null has none."""
    low = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                      string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, SPLIT), lambda w: w != "")


def template_grams(spark, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """One row per template gram: its words, their hash and place. Its size is that of the template lists."""
    rows = []
    for exact, texts in ((True, phrases), (False, templates)):
        for label, text in texts.items():
            words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
            k = 2 if exact else LONG
            if len(words) < k:
                raise ValueError(f"a template needs {k} words or more: {label}")
            rows += [(label, exact, len(words), k, i, *(words[i : i + k] + ["", ""])[:4])
                     for i in range(len(words) - k + 1)]
    return spark.createDataFrame(
        rows, "label string, exact boolean, n int, k int, at int, t0 string, t1 string, t2 string, t3 string"
    ).withColumn("gram", F.when(F.col("k") == 2, F.xxhash64("t0", "t1")).otherwise(F.xxhash64("t0", "t1", "t2", "t3")))


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id", phrases: dict[str, str] = PHRASES,
                  templates: dict[str, str] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """One row per verified span: ``key, text_hash, label, exact, first_word, last_word, score``.

    Words count from 0. A phrase span is exactly its words in a row (score 1). A template span holds at least
    ``share`` of the template's words in verified runs of four, on diagonals at most ``MERGE`` apart. ``text_hash``
    (xxhash64 of the text, null as empty) tells rows of equal key apart; repeated rows give one set of spans.
    Other columns are ignored; a null or empty text has no span.
    """
    spark = docs.sparkSession
    grams = F.broadcast(template_grams(spark, phrases, templates))
    words = docs.select(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
                        text_words(text).alias("w")).where(F.size("w") >= 2)
    follow = F.arrays_zip(
        F.col("w").alias("w0"), F.expr("slice(w, 2, size(w))").alias("w1"),
        F.expr("slice(w, 3, size(w))").alias("w2"), F.expr("slice(w, 4, size(w))").alias("w3"),
    )
    rolled = (
        words.select("key", "text_hash", F.posexplode(follow).alias("pos", "g"))
        .select("key", "text_hash", "pos", "g.w0", "g.w1", "g.w2", "g.w3")
        .where(F.col("w1").isNotNull())
        .select("*", F.explode(F.array(F.xxhash64("w0", "w1"), F.xxhash64("w0", "w1", "w2", "w3"))).alias("gram"))
    )
    same = (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & (
        (F.col("k") == 2) | ((F.col("w2") == F.col("t2")) & (F.col("w3") == F.col("t3")))
    )
    votes = rolled.join(grams, "gram").where(same).select(
        "key", "text_hash", "label", "exact", "n", "k", "at", "pos", (F.col("pos") - F.col("at")).alias("diagonal")
    )
    diagonals = votes.groupBy("key", "text_hash", "label", "exact", "n", "k", "diagonal").agg(
        F.array_sort(F.collect_set("at")).alias("ats")
    )
    return _spans(diagonals, share)


def _spans(diagonals: DataFrame, share: float) -> DataFrame:
    """Spans from the diagonals of one text and template: whole ones of a phrase, each by itself; those of a long template
    merged in order and cut where they lie more than ``MERGE`` apart, by a running count of the cuts.
    """
    own, k = ["key", "text_hash", "label", "exact", "n", "k"], F.col("k")
    order = Window.partitionBy("key", "text_hash", "label").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > MERGE, F.lit(True))
    numbered = diagonals.where(~F.col("exact") | (F.size("ats") == F.col("n") - k + 1)).withColumn(
        "cut", (F.col("exact") | apart).cast("int")).withColumn(
        "part", F.sum("cut").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = numbered.groupBy(*own, "part").agg(
        F.min("diagonal").alias("lo"), F.max("diagonal").alias("hi"), F.array_distinct(F.flatten(F.collect_set("ats"))).alias("ats"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + k - 1)))))
    return (
        merged.withColumn("score", covered / F.col("n"))
        .where(F.col("score") >= share)
        .select(
            "key", "text_hash", "label", "exact", (F.col("lo") + F.array_min("ats")).cast("long").alias("first_word"),
            (F.col("hi") + F.array_max("ats") + k - 1).cast("long").alias("last_word"), "score",
        )
    )


def license_report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``key, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` describe the phrase places (first and last start,
    null if none); ``labels`` adds those of the long templates. ``score`` is that of the best span, else 0.
    """
    spans = scan_licenses(docs, text, key)
    exact = F.col("exact")
    found = spans.groupBy(F.col("key").alias("span_key"), F.col("text_hash").alias("span_hash")).agg(
        F.count_if(exact).alias("n_base"),
        F.min(F.when(exact, F.col("first_word"))).alias("first_word"),
        F.max(F.when(exact, F.col("first_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(exact, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    rows = docs.select(F.col(key).alias("row_key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row_hash"),
                       F.size(text_words(text)).cast("long").alias("n_words"))
    joined = rows.join(
        found, F.col("row_key").eqNullSafe(F.col("span_key")) & (F.col("row_hash") == F.col("span_hash")), "left"
    )
    return joined.select(
        F.col("row_key").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
