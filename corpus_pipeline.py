"""A training-corpus pipeline over ``documents``: five stages, each one operator of ``tidelane.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. Between stages the rows are
written as Parquet to the shared folder and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelane.llm import decontaminate, langid, ngram_join, pieces, secrets
from tidelane.llm.queries import PIECE_MODEL
from tidelane.session import new_shared_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and the new name of each column."""
    names = {c: f"column{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter go. A missing ``lang`` becomes the predicted one."""
    plain, n = _plain(docs)
    told = langid.identify_languages(plain, n["text"], n["lang"], n["doc_id"]).where(F.col("lang_pred") != "und")
    told = told.withColumn(n["lang"], F.coalesce(n["lang"], "lang_pred"))
    return told.select(*n.values()).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies: the one of least ``doc_id``, of several texts under that
    id the one whose hash is least.

    A row is judged by its own text, whatever other texts share its id. Rows that repeat it, id and text, go too.
    Rows without an id are in no group and stay.
    """
    marked = ngram_join.join_similar(docs, mark_first=True)
    other = marked.where(~F.col("is_first")).select("doc_id", F.col("row_name").alias("__name"))
    path = new_shared_path(spark, "others")
    other.distinct().write.parquet(path)
    named = docs.where(F.col("doc_id").isNotNull()).withColumn("__name", ngram_join.row_name("text"))
    # The exchange that folds repeated rows also places them for the join, so texts are shuffled once at every size.
    once = named.dropDuplicates(["doc_id", "__name"])
    kept = once.join(spark.read.parquet(path).hint("merge"), ["doc_id", "__name"], "left_anti")
    return kept.select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window."""
    plain, n = _plain(docs)
    marked = decontaminate.mark_benchmark(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n["text"])
    kept = decontaminate.contamination(marked).where(~F.col("contaminated"))
    return kept.select(*n.values()).toDF(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a sign; ``n_chars`` follows a changed text."""
    plain, n = _plain(docs)
    clean = secrets.redact(secrets.scan_secrets(plain, n["text"]), n["text"])
    changed = F.when(F.size("spans") > 0, F.length(n["text"]).cast("long")).otherwise(F.col(n["n_chars"]))
    return clean.withColumn(n["n_chars"], changed).select(*n.values()).toDF(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their pieces: ``n_tokens``, ``ids`` and whether decoding gives the text back."""
    return pieces.encode_pieces(docs, PIECE_MODEL)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("uncontaminated", uncontaminated),
    ("without_secrets", without_secrets),
    ("tokens", tokens),
]

#: Networks, similarity joins and transducers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
