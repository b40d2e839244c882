"""Operators that compare documents with each other, and the pipeline, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from helpers import AWKWARD, awkward, empty, table, words
from pyspark.sql import functions as F

from tidelane.llm import ngram_join, queries, secrets, substrings

# 3 n-gram Jaccard join


def grams(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def join_brute(rows):
    classes, parent, links = defaultdict(list), {}, Counter()
    for d, t in rows:
        if d is not None and (s := grams(t)):
            classes[s].append(d)

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [(s, min(ids)) for s, ids in classes.items()]
    for i, (s, a) in enumerate(sets):
        for r, b in sets[:i]:
            both = len(s & r)
            if 5 * both >= 4 * (len(s) + len(r) - both):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    out = []
    for d, t in rows:
        s = grams(t)
        rep = min(classes[s]) if d is not None and s else d
        out.append((d, find(rep) if d is not None and s else d, rep, len(classes[s]) if d is not None and s else 1, links[rep] if s else 0))
    return sorted(out, key=str)


def near_copies(n=60):
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
        rows.append((100 + i, " ".join(w)))
    return rows


def joined(df):
    return sorted(((r.doc_id, r.class_id, r.rep_id, r.n_copies, r.n_links) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [512, 8])
def test_join_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    rows = [*AWKWARD, *near_copies()]
    assert joined(ngram_join.join_similar(awkward(spark, rows))) == join_brute(rows)


def test_join_of_repeated_rows_and_two_texts_of_one_id(spark):
    """A representative's repeated rows count as one, and each text of an id has its own links only."""
    a, b = (" ".join(f"{c}{i}" for i in range(100)) for c in "ab")
    rows = [(-3, a), (-3, a), (-3, a), (-3, b), (2, a + " more"), (2, a + " more"), (4, b + " other"), (4, b + " other"), (9, "else, wholly else")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(-3, -3, -3, 3, 1)] * 3 + [(-3, -3, -3, 1, 1)] + [(2, -3, 2, 2, 1)] * 2 + [(4, -3, 4, 2, 1)] * 2 + [(9, 9, 9, 1, 0)]
    assert joined(ngram_join.join_similar(docs)) == sorted(want, key=str)


def test_join_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    assert joined(queries.op3_ngram_jaccard(spark, "/root/testdata/sf0.001")) == join_brute(rows)


def test_join_empty(spark):
    assert ngram_join.join_similar(empty(spark)).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    """The least numbers of matches rise with the values compared and stay below what a true pair shows."""
    least = ngram_join.least_matches(0.8)
    assert least == sorted(least) and least[-1] < 0.65 * ngram_join.HASHES and least[-1] > 0.4 * ngram_join.HASHES


def test_groups_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.group for r in ngram_join.group_nodes(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# 9 repeated substrings


def repeats_brute(rows, size):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[p : p + size] for _, b in texts for p in range(len(b) - size + 1))
    out = []
    for d, b in texts:
        cut = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if seen[b[p : p + size]] > 1:
                cut[p : p + size] = b"\1" * size
        runs = sum(c and (i == 0 or not cut[i - 1]) for i, c in enumerate(cut))
        kept = bytes(c for c, f in zip(b, cut, strict=True) if not f)
        out.append((d, len(b), sum(cut), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeated_texts():
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, other = letters(300), letters(130)
    rows = [(i, letters(rng.randrange(0, 200)) + passage[rng.randrange(60) :][: rng.randrange(90, 300)] + letters(rng.randrange(200)))
            for i in range(40)]
    rows += [(50 + i, other + letters(i) + other) for i in range(5)]
    rows += [(60, "ab" * 400), (61, "x" * 500), (62, None), (63, ""), (64, "x" * 101), (65, letters(700)), (65, letters(0)), (66, "y" * 99)]
    rows += [(70, rows[0][1]), (0, rows[0][1]), (None, passage), (None, None)]
    return rows


@pytest.mark.parametrize("hot,piece", [(20_000, 1 << 23), (1, 1 << 23), (20_000, 200)])
def test_repeats_against_all_strings(spark, monkeypatch, hot, piece):
    monkeypatch.setattr(substrings, "PIECE", piece)
    rows = repeated_texts()
    df = substrings.remove_repeats(awkward(spark, rows), size=100, hot=hot)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)
    assert got == repeats_brute(rows, 100)


def test_repeats_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    got = queries.op9_repeated_substrings(spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == repeats_brute(rows, 400)


def test_repeats_empty_and_kept_bytes(spark):
    assert substrings.remove_repeats(empty(spark)).count() == 0
    df = spark.createDataFrame([(1, "a" * 400 + "tail"), (2, "head" + "a" * 400)], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept) for r in substrings.remove_repeats(df, keep_bytes=True).collect()} == {1: b"tail", 2: b"head"}


# pipeline


def pipeline_brute(spark, rows):
    import re

    alive = [r for r in rows if r["text"] and any(c.isalpha() for c in r["text"])]
    classes = {d: c for d, c, *_ in join_brute([(r["doc_id"], r["text"]) for r in alive])}
    alive = [r for r in alive if classes[r["doc_id"]] == r["doc_id"]]
    alive = list({(r["doc_id"], r["text"]): r for r in alive}.values())
    bench = [words(r.text) for r in table(spark, "benchmark").collect()]
    wins = {tuple(w[i : i + 13]) for w in bench for i in range(max(1, len(w) - 12) if w else 0)}
    sizes, clean = {len(w) for w in wins}, []
    for r in alive:
        w = words(r["text"])
        hit = {i + j for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in wins for j in range(n)}
        if not (hit and 20 * len(hit) >= len(w)):
            clean.append(r)
    return {r["doc_id"]: len(re.findall(r"AKIA[A-Z0-9]{12,}", r["text"])) for r in clean}


def test_pipeline_against_brute_force(spark):
    rows = [r.asDict() for r in table(spark, "documents").collect()]
    want = pipeline_brute(spark, rows)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(want)
    for r in got.values():
        assert r.round_trip and r.n_chars == len(r.text) and not secrets.ACCESS.search(r.text)


def test_pipeline_stages_with_awkward_rows(spark):
    docs = awkward(spark).withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        for source in (docs, docs.limit(0)):
            out = stage(spark, source, "/root/testdata/sf0.001")
            kept[name] = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) if source is docs else kept[name]
            assert out.columns[: len(docs.columns)] == docs.columns or name == "tokens"
    everyone = sorted((d is None, d or 0) for d, _ in AWKWARD)
    assert kept["without_secrets"] == kept["tokens"] == kept["uncontaminated"] == everyone
    assert kept["language"] == [x for x in everyone if x[1] not in (1, 2, 3)]
    gone = [x for x in everyone if x[1] not in (5,)]
    gone.remove((False, 4))
    assert kept["near_duplicates"] == gone


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    import oracle

    sf = "/root/testdata/sf0.001"
    assert oracle.compare(queries.QUERIES[name](spark, sf), oracle.connect(sf), queries.ORACLES[name]) is None


def test_every_query_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
