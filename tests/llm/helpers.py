"""Plain Python versions of the contracts, and small tables with every awkward case."""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SF = "/root/testdata/sf0.001"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(f"{SF}/{name}.parquet")


LONG = " ".join(f"word{i % 977} the" for i in range(30_000))

#: Null, empty, letterless, repeated rows, equal texts, a very long text, astral letters.
AWKWARD = [
    (1, None), (2, ""), (3, "12 34 -- !"), (4, "One two three four five six seven."),
    (4, "One two three four five six seven."), (5, "one TWO three, four five six seven"), (6, LONG),
    (7, "é漢字😀 ß x\n\n\ttab"), (None, "no id here at all, none"), (8, "a"), (9, "All rights reserved. CC BY cc-by"),
]
CLASH = "score double, spans int, n_words string, key int, label string, h int, unit int, rep int, __row int, t1 int"


def awkward(spark: SparkSession, rows=AWKWARD) -> DataFrame:
    """The awkward texts with extra columns whose names operators use inside."""
    extra = (0.5, 1, "x", 2, "l", 3, 4, 5, 6, 7)
    return spark.createDataFrame(
        [(i, t, "en", *extra) for i, t in rows], f"doc_id long, text string, lang string, {CLASH}"
    )


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"doc_id long, text string, lang string, {CLASH}")
