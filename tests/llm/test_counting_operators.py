"""Token counts, conversation repair and source divergence against the library, brute force and SQL."""

import hashlib
import random
import zlib

import oracle
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import AWKWARD, LONG, awkward, empty, table
from tokenizers import Tokenizer

from tidelane.llm import conversations, divergence, queries, token_counts

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# 11 token counts


def library_counts(texts):
    return [len(e.ids) for e in Tokenizer.from_file(VOCABULARY).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_counts_equal_the_library(spark):
    rows = [*AWKWARD, (10, "漢字。" * 30_000), (11, "x" * 70_000), (12, "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>")]
    got = token_counts.count_tokens(awkward(spark, rows), VOCABULARY, limit=6, keep=["doc_id", "text"]).collect()
    want = [(d, t, len((t or "").encode()), n, n > 6) for (d, t), n in zip(rows, library_counts([t for _, t in rows]))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    clash = token_counts.count_tokens(awkward(spark), VOCABULARY)
    assert clash.columns == [*awkward(spark).columns, "n_bytes", "n_tokens", "over_limit"] and clash.count() == len(AWKWARD)
    assert token_counts.count_tokens(empty(spark), VOCABULARY).count() == 0


@pytest.mark.parametrize("piece,batch", [(1, 1), (3, 500), (1 << 16, 1 << 20)])
def test_pieces_and_batches_change_no_count(piece, batch):
    rng = random.Random(4)
    some = ["a", "B", "é", "é", " ", "\t", "　", "1", "٣", "'s", "'", "S", "<|endoftext|>", "<", "|", ">", "!", "..", "。",
            "漢", "が", "が", "İ", "ß", "́", "½", "Σ", "_", "-", "가", "ᆨ", " ", "\x1c", "\x85", "😀", "\x00"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(1, 50))) for _ in range(4000)] + [None, ""]
    count, splittable = token_counts.load_counter(VOCABULARY)
    assert splittable
    assert token_counts.count_column(pa.array(texts), count, piece, batch).tolist() == library_counts(texts)


def test_token_counts_of_other_vocabularies(spark):
    import sentencepiece

    texts = [t or "" for _, t in AWKWARD]
    path = public_tokenizers.path("piece_bpe_32k.model")
    want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    got = token_counts.count_tokens(awkward(spark), path, keep=["doc_id"]).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(want)
    count, splittable = token_counts.load_counter(public_tokenizers.path("byte_bpe_50k.json"))
    assert not splittable and token_counts.count_column(pa.array(["a  b"]), count, None, 10)[0] == len(
        Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode("a  b").ids)
    with pytest.raises(ValueError):
        token_counts.load_counter("words.txt")


# 12 conversation repair


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 1:
            x = ""
        if kind == 2:
            x = "".join(ch for ch in x if ch not in ".!?")
        if kind == 4:
            r = "user"
        out += [(c, t, r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repair_brute(rows):
    """One conversation, row by row: the best audit for every state of the roles."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, r, x in rows:
        body = x.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (r, x) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((r, x))

    def best(ways):
        ways = [w for w in ways if w]
        return min(ways, key=lambda w: w[:2]) if ways else None

    def go(way, cost, edit, *line):
        return way and (way[0] + cost, way[1] + edit, way[2] + list(line))

    def inserted(s):
        s[2] = best([s[2], *(go(s[i], 3, "I", "user:") for i in (0, 1, 3))])
        s[3] = best([s[3], go(s[2], 3, "I", "assistant:")])
        return s

    s = inserted([(0, "", []), None, None, None])
    for (_, r, x), f in zip(rows, faults):
        new, t, line = [go(w, 4, "D") for w in s], 3 if f == "t" else 0, f"{r}:{x}"
        if f not in ("b", "d"):
            if r[:1] == "s":
                new[1] = best([new[1], go(s[0], t, "K", line)])
            for i in (0, 1, 3):
                new[2] = best([new[2], go(s[i], t + 3, "R", f"user:{x}"), go(s[i], t, "K", line) if r[:1] == "u" else None])
            new[3] = best([new[3], go(s[2], t + 3, "R", f"assistant:{x}"), go(s[2], t, "K", line) if r[:1] == "a" else None])
        s = inserted(new)
    cost, audit, lines = best([s[0], s[3]])
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def talk(n_conv, seed, longest=14):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "User", "usher", "agent", " user"]
    texts = ["Hi.", "no end", "", None, " \t\n", "What?\n ", "é!", ".", "a\x85", "Hi.", "long " * 50]
    out = []
    for c in [None, *range(n_conv)]:
        for _ in range(rng.randrange(longest)):
            turn = rng.choice([None, *range(-2, 9)])
            out.append((c, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"Text {rng.random()}."))
    return out


COLUMNS = "conv_id long, turn long, role string, text string, at long, m int, conv int, block int, audit string, gone int"


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "x", 5) for r in rows], COLUMNS)
    return {r[0]: tuple(r)[1:] for r in conversations.repair_conversations(df).collect()}


def brute(rows):
    held = {}
    for c, *r in rows:
        held.setdefault(c, []).append((r[0], " " if r[1] is None else r[1], " " if r[2] is None else r[2]))
    return {c: repair_brute(r) for c, r in held.items()}


@pytest.mark.parametrize("bits", [0, 2, 9])
def test_repair_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = talk(120, bits)
    assert repaired(spark, rows) == brute(rows)


def test_long_and_repeated_conversations(spark):
    rng = random.Random(7)
    rows = [(1, i // 2, rng.choice(["user", "assistant", "system"]), f"Line {rng.randrange(400)}{rng.choice(['.', ''])}") for i in range(2500)]
    rows += [(2, 5, "user", "Again and again.")] * 3000 + [(2, 6, "assistant", "Yes.")] * 2 + [(3, None, None, None)] * 50
    assert repaired(spark, rows) == brute(rows)
    assert repaired(spark, []) == {}


def test_damage_and_query_equal_brute_force_and_sql(spark, tmp_path):
    rows = talk(150, 11, 9)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in conversations.damage_conversations(df).select("conv", "turn", "role", "text").collect()]
    assert sorted(got, key=str) == sorted(damage(rows), key=str)
    df.coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    name = "op12_conversation_repair"
    con = oracle.duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    out = queries.QUERIES[name](spark, str(tmp_path))
    assert oracle.compare(out, con, queries.ORACLES[name]) is None
    assert out.count() == len({r[0] for r in rows})


# 13 source divergence


def test_divergence_equals_sql(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "abcdeé漢Z" for b in ("x", "Y", "ß", "́")]
    rows = []
    for i in range(900):
        words = [vocabulary[min(int(rng.expovariate(0.15)), 31)] for _ in range(rng.randrange(12))]
        text = rng.choice(["copied Text, twice a1b", " ".join(words), "-".join(words), None, "", "12 34"])
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        rows.append((i, text, lang, rng.choice(["hot"] * 5 + ["s1", "s2", None, "", "é"]), *(1,) * 5))
    rows += [(5, "only here", "rare", "r1", *(1,) * 5), (6, None, "rare", "r2", *(1,) * 5), (7, LONG, "en", "longest", *(1,) * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, term int, n int, m int, p int, item int")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = oracle.duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    name = "op13_source_divergence"
    out = queries.QUERIES[name](spark, str(tmp_path))
    assert oracle.compare(out, con, queries.ORACLES[name]) is None
    assert {r["value"] for r in out.where("lang = 'rare'").collect()} == {0}
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_large_counts_stay_exact(spark):
    n, total, kept = 3 * 10**15 + 1, 7 * 10**16 + 3, 10**9
    row = spark.createDataFrame([(n, total, kept), (0, 0, 0)], "n long, total long, kept long")
    got = row.select(divergence._share(row["n"], row["total"], row["kept"])).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (n + 5) // (total + 5 * kept), None]


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_source_divergence"])
def test_queries_equal_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert oracle.compare(queries.QUERIES[name](spark, sf), oracle.connect(sf), queries.ORACLES[name]) is None


def test_token_query_covers_the_table(spark):
    docs = table(spark, "documents")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in queries.op11_token_counts(spark, "/root/testdata/sf0.001").collect()}
    rows = docs.select("doc_id", "text").collect()
    want = library_counts([r["text"] for r in rows])
    assert got == {r["doc_id"]: (len((r["text"] or "").encode()), n) for r, n in zip(rows, want)}
