"""The registered queries of this subpackage, each over the whole of its tables, and their SQL."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelane.llm import (
    conversations, decontaminate, divergence, langid, licenses, main_text, ngram_join, pieces, quality, secrets, substrings, token_counts, warc,
)
from tidelane.session import new_shared_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page_id = lambda c: F.regexp_extract(c, r"^<urn:page:(.*)>$", 1).try_cast("long")
    return warc.read_archives(spark, path).where("kind = 'record'").select(
        page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_id(F.col("refers_to")).alias("refers_to"),
    )


@query
def op2_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


@query
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_similar(table(spark, sf_dir, "documents"))


@query
def op4_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind, *_ in secrets.BASE],
        F.sha2(secrets.span_text("base_spans"), 256).alias("base_sha256"), secrets.span_text("spans").alias("spans"),
    )


@query
def op5_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


@query
def op6_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op7_benchmark_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination(marked).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


@query
def op8_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify_languages(docs, keep=["doc_id"]).select(
        "doc_id", F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query
def op9_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


#: Path of the public vocabulary file, outside the repository.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Name of the public vocabulary whose tokens are counted.
COUNT_VOCABULARY = "word_bpe_49k.json"


@query
def op10_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), PIECE_MODEL, keep=["doc_id"])


SPLIT = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
    r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

ORACLES["op7_benchmark_automaton"] = f"""
with b as (select item_id, {SPLIT} as ws from benchmark),
bw as (select distinct item_id, n, array_to_string(list_slice(ws, i + 1, i + n), ' ') as gram
       from (select item_id, ws, least(len(ws), 13) as n, unnest(range(0, greatest(1, len(ws) - 12))) as i
             from b where len(ws) > 0)),
d as (select row_number() over () as rid, doc_id, {SPLIT} as ws from documents),
dw as (select rid, n, i, array_to_string(list_slice(ws, i + 1, i + n), ' ') as gram
       from (select rid, ws, n, unnest(range(0, len(ws) - n + 1)) as i
             from d, (select distinct n from bw) where len(ws) >= n)),
hits as (select distinct rid, n, i, item_id from dw join bw using (n, gram)),
hit as (select rid, count(distinct p) as n_hit
        from (select rid, unnest(range(i, i + n)) as p from hits) group by rid),
its as (select rid, count(*) as n_items, string_agg(s, ',' order by s) as joined
        from (select distinct rid, cast(item_id as varchar) as s from hits where item_id is not null) group by rid)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(joined, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join hit using (rid) left join its using (rid)"""


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(COUNT_VOCABULARY)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, keep=["doc_id"])


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    damaged = conversations.damage_conversations(rows)
    repaired = conversations.repair_conversations(damaged, conv="conv")
    every = rows.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = every.join(repaired, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv").na.fill(0, counts)
    nothing = hashlib.sha256().hexdigest()
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = r"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
w as (select rid, lang, source, unnest(ws) as term from d),
kept as (select lang, term, count(*) as n from w group by lang, term having count(distinct rid) >= 30),
v as (select lang, count(*)::hugeint as v, sum(n)::hugeint as n from kept group by lang),
own as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
tot as (select lang, source, sum(n)::hugeint as n from own group by all),
g as (select distinct lang, source from d),
p as (select g.lang, g.source, k.term, coalesce(own.n, 0) as n,
        1 + (1000000000::hugeint * (coalesce(own.n, 0) + 5)) // (coalesce(tot.n, 0) + 5 * v.v) as p,
        1 + (1000000000::hugeint * (k.n + 5)) // (v.n + 5 * v.v) as q
    from g join kept k using (lang) join v using (lang) left join tot using (lang, source)
    left join own on own.lang = g.lang and own.source = g.source and own.term = k.term),
pairs as (select a.lang, a.source, b.source as item, coalesce(s.value, 0) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value
        from p x join p y on x.lang = y.lang and x.term = y.term group by all) s
    on s.lang = a.lang and s.source = a.source and s.item = b.source),
everything as (select lang, source, 'pair' as part, item, value from pairs
    union all select lang, source, 'term', term, p - q from p where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as r from everything)
select lang, source, part, item, cast(value as bigint) as value, cast(r as integer) as "rank"
from ranked where part = 'pair' or r <= 50"""

ORACLES["op12_conversation_repair"] = r"""
with recursive d as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(
            coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint)),
            lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
                lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 20 as kind
    from conversations),
f as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(range(case when kind = 3 then 2 else 1 end)) as copy from d where kind <> 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body from f),
r as (select conv_id, turn, role, text, i, case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else '-' end as c,
        case when body = '' then 'b' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd'
            when right(body, 1) not in ('.', '!', '?') then 't' else '' end as fault,
        row_number() over (partition by conv_id order by i desc) = 1 as last from o),
g as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) as n,
        count(*) filter (where fault = 'b') as blank, count(*) filter (where fault = 'd') as duplicate,
        count(*) filter (where fault = 't') as truncated from r group by conv_id),
il as (select conv_id, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal from
        (select conv_id, lag(c) over (partition by conv_id order by i) || c as pair from r) group by conv_id),
w as (
    select conv_id, 0::bigint as i, {'c': 0::bigint, 'a': ''} as s0, {'c': 1000000000000, 'a': ''} as s1,
        {'c': 3::bigint, 'a': 'I'} as s2, {'c': 6::bigint, 'a': 'II'} as s3 from g
    union all
    select conv_id, i, s0, s1, s2, list_min([s3, {'c': s2.c + 3, 'a': s2.a || 'I'}]) as s3 from (
        select conv_id, i, n0 as s0, n1 as s1, list_min([n2, {'c': n0.c + 3, 'a': n0.a || 'I'},
            {'c': n1.c + 3, 'a': n1.a || 'I'}, {'c': n3.c + 3, 'a': n3.a || 'I'}]) as s2, n3 as s3 from (
            select w.conv_id, r.i, {'c': s0.c + 4, 'a': s0.a || 'D'} as n0,
                list_min([{'c': s1.c + 4, 'a': s1.a || 'D'}, {'c': s0.c + t + case when c = 's' then 0 else far end, 'a': s0.a || 'K'}]) as n1,
                list_min([{'c': s2.c + 4, 'a': s2.a || 'D'},
                    {'c': s0.c + t + case when c = 'u' then 0 else far end, 'a': s0.a || 'K'},
                    {'c': s1.c + t + case when c = 'u' then 0 else far end, 'a': s1.a || 'K'},
                    {'c': s3.c + t + case when c = 'u' then 0 else far end, 'a': s3.a || 'K'},
                    {'c': s0.c + t + 3, 'a': s0.a || 'R'}, {'c': s1.c + t + 3, 'a': s1.a || 'R'},
                    {'c': s3.c + t + 3, 'a': s3.a || 'R'}]) as n2,
                list_min([{'c': s3.c + 4, 'a': s3.a || 'D'}, {'c': s2.c + t + case when c = 'a' then 0 else far end, 'a': s2.a || 'K'},
                    {'c': s2.c + t + 3, 'a': s2.a || 'R'}]) as n3
            from w join (select *, case when fault in ('b', 'd') then 1000000000000 when fault = 't' then 3 else 0 end as t,
                1000000000000 as far from r) r on r.conv_id is not distinct from w.conv_id and r.i = w.i + 1))),
best as (select w.conv_id, list_min([s0, s3]) as s from w join g on g.conv_id is not distinct from w.conv_id and w.i = g.n),
e as (select conv_id, s.a as audit, k, s.a[k] as edit from best, lateral (select unnest(range(1, length(s.a) + 1)) as k)),
p as (select *, count(*) filter (where edit <> 'I') over (partition by conv_id order by k) as i from e),
q as (select p.conv_id, k, edit, r.role, r.text, r.c, row_number() over (partition by p.conv_id order by k) as j
    from p left join r on r.conv_id is not distinct from p.conv_id and r.i = p.i and edit <> 'I' where edit <> 'D'),
z as (select *, bool_or(j = 1 and edit = 'K' and c = 's') over (partition by conv_id) as sys from q),
y as (select conv_id, k, case when edit = 'K' then role when (j + case when sys then 1 else 0 end) % 2 = 1 then 'user'
        else 'assistant' end || ':' || case when edit = 'I' then '' else text end as line from z),
h as (select conv_id, string_agg(line, chr(10) order by k) as body from y group by conv_id)
select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
    coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
    coalesce(illegal, 0)::bigint as illegal, coalesce(s.c, 0)::bigint as cost, coalesce(s.a, '') as audit,
    sha256(coalesce(body, '')) as repaired_sha256
from (select distinct conv_id from conversations) a left join g on g.conv_id is not distinct from a.conv_id
left join il on il.conv_id is not distinct from a.conv_id left join best on best.conv_id is not distinct from a.conv_id
left join h on h.conv_id is not distinct from a.conv_id"""
