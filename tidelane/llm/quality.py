"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good, bad or abstains. How often a rule is right is not known; expectation-maximisation
estimates it from how the rules agree, and a text's posterior probability of being good decides, instead of an
all-must-pass filter. Texts meet the estimate only as counts by vote pattern, of which there are at most
``3 ** len(RULES)``, so each step is one small aggregate whatever the number of texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidelane.session import new_shared_path

SPACE = r"[ \t\n\x0B\f\r]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
STEPS = 12
#: Odds before any vote, held fixed, and the weight of the start values as a share of the texts.
BALANCE = 0.5
ANCHOR = 0.05
KEEP_FROM = 0.5


def text_measures(docs: DataFrame, text: str = "text", k: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_ends,
    n_distinct_words``.

    Columns of these names are replaced. Null counts as empty. ``n_ends``: words that end with ``.!?``. ``n_repeat_words`` counts the words in runs of ``k``
    words found twice or more in the text (first included): runs are compared by 64-bit hash, sorted by it, and
    the places whose hash has an equal neighbour are folded in order of place, each adding the words not yet
    covered. Texts without a repeated run stop at the distinct count.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.size("__w")
    hashes = F.transform(
        F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.col("__w")[i + j] for j in range(k)])
    )
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^ \t\x0B\f\r]"))
    out = (
        docs.withColumn("__w", F.filter(F.split(t, SPACE), lambda x: x != ""))
        .withColumn("__h", F.when(n >= k, hashes).otherwise(F.array().cast("array<bigint>")))
        .withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"),
                                  F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    )
    at = lambda j: F.get("__s", j)["h"]
    places = F.array_sort(F.transform(
        F.filter(F.transform("__s", lambda s, j: F.struct(s["i"].alias("i"), (
            F.coalesce(s["h"] == at(j - 1), F.lit(False)) | F.coalesce(s["h"] == at(j + 1), F.lit(False))
        ).alias("twice"))), lambda x: x["twice"]),
        lambda x: x["i"],
    ))
    covered = F.aggregate(
        "__p", F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(k), i - a["last"])).alias("n"), i.alias("last")),
    )["n"]
    out = out.withColumn("__p", places).withColumn("__lines", lines)
    return out.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.coalesce(F.when(F.col("__s").isNotNull(), covered), F.lit(0)).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_ends": F.size(F.filter("__w", lambda w: w.rlike(r"[.!?]$"))).cast("long"),
        "n_distinct_words": F.size(F.array_distinct("__w")).cast("long"),
    }).drop("__w", "__h", "__s", "__p", "__lines")


RULES = ("length", "sentences", "variety", "word_length", "symbols", "lines", "repeats")
#: Vote probabilities that the estimate starts from, by class and vote: good texts seldom get a bad vote.
START = {1: {1: 0.7, 0: 0.28, -1: 0.02}, -1: {1: 0.4, 0: 0.2, -1: 0.4}}


def votes() -> dict[str, Column]:
    """1 good, -1 bad, 0 abstains, over the measures of one text. A fault's absence is no vote for good."""
    n, c = F.col("n_words"), F.col
    words, lines = F.greatest(n, F.lit(1)), F.greatest(c("n_lines"), F.lit(1))

    def vote(bad: Column, good: Column | None = None) -> Column:
        kind = F.when(bad, -1)
        return (kind if good is None else kind.when(good, 1)).otherwise(0).cast("int")

    mean, ends = c("word_chars") / words, c("n_ends") / words
    variety = c("n_distinct_words") / words
    return {
        "length": vote(n < 10, n >= 50),
        "sentences": vote((n >= 30) & (ends < 0.005), ends.between(0.02, 0.5)),
        "variety": vote((n >= 30) & (variety < 0.12), variety > 0.3),
        "word_length": vote((mean < 2) | (mean > 14)),
        "symbols": vote(c("n_symbols") / words > 0.1),
        "lines": vote(c("n_dup_lines") / lines > 0.3),
        "repeats": vote(c("n_repeat_words") / words > 0.2),
    }


def estimate(patterns: DataFrame, rules: tuple[str, ...] = RULES, steps: int = STEPS) -> dict:
    """Each rule's vote probabilities by class, from ``(rule votes..., n)`` rows.

    A step is one aggregate over the patterns that returns one row of sums. The start values stay in as a prior
    weighing ``ANCHOR`` of the texts, which fixes what "good" means: without it the two classes drift to whatever
    splits the votes best. No rows: the start values.
    """
    table = dict.fromkeys(rules, START)
    sides = [(r, v, c) for r in rules for v in (1, 0, -1) for c in (1, -1)]
    for _ in range(steps):
        good = posterior(table)
        share = {1: F.col("n") * good, -1: F.col("n") * (1 - good)}
        sums = [F.sum("n").alias("all"), *[F.sum(share[c]).alias(f"class|{c}") for c in share]]
        sums += [F.sum(F.when(F.col(r) == v, share[c])).alias(f"{r}|{v}|{c}") for r, v, c in sides]
        row = patterns.agg(*sums).first().asDict()
        if not row["all"]:
            break
        weight = ANCHOR * row["all"] + 1
        before, table = table, {r: {1: {}, -1: {}} for r in rules}
        for r, v, c in sides:
            table[r][c][v] = ((row[f"{r}|{v}|{c}"] or 0.0) + weight * START[c][v]) / (row[f"class|{c}"] + weight)
        if max(abs(table[r][c][v] - before[r][c][v]) for r, v, c in sides) < 1e-3:
            break
    return table


def posterior(table: dict) -> Column:
    """Probability of good given the votes: naive Bayes over the rules that did not abstain."""
    odds = F.lit(math.log(BALANCE / (1 - BALANCE)))
    for rule, p in table.items():
        odds = odds + F.when(F.col(rule) == 1, math.log(p[1][1] / p[-1][1])).when(
            F.col(rule) == -1, math.log(p[1][-1] / p[-1][-1])).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge_quality(docs: DataFrame, text: str = "text", key: str = "doc_id", keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per row of ``docs``: ``key``, the measures, ``base_failed``, the votes, ``quality`` and ``kept``.

    ``base_failed``: fewer than 10 words, or over 20 % of the words in repeated runs of five. ``kept`` is false for
    those; else the posterior ``quality`` must reach ``keep_from``. The measures are written to the shared folder
    once and read twice, for the estimate and for the verdict.
    """
    spark = docs.sparkSession
    measured = text_measures(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")), "__text").drop("__text")
    path = new_shared_path(spark, "quality")
    measured.withColumns(votes()).write.parquet(path)
    voted = spark.read.parquet(path)
    counts = new_shared_path(spark, "patterns")
    voted.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(counts)
    table = estimate(spark.read.parquet(counts))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        voted.withColumnRenamed("__key", key)
        .withColumn("base_failed", failed)
        .withColumn("quality", posterior(table))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_from))
    )
