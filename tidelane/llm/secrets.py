"""Secret scans with multipart credential linking.

Strong patterns are reported as they are. Weak parts - a user or client name, a bare random-looking token, a short
password field, a host or URL - are reported only if a complementary part lies in the same scope: an interval join
links access identifiers, secrets and endpoints at most ``SCOPE`` code points apart in one text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidelane.llm.words import chunks
from tidelane.session import new_shared_path

SCOPE = 200

#: Base kinds (fixed values): pattern, group that is measured, least length of it.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))
BASE_ROLE = {"assign": "secret", "access": "identifier", "hex": "secret"}

#: Weak parts: kind, role, pattern.
WEAK = (
    ("weak_id", "identifier", re.compile(
        r"""\b(?:client_?id|user(?:name)?|login|account(?:_?id)?|access_key_id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
        re.ASCII | re.IGNORECASE)),
    ("weak_secret", "secret", re.compile(
        r"""\b(?:pwd|pass|client_key|private_key)["']?\x20*[:=]\x20*["']?[^\s"',;]{4,}""", re.ASCII | re.IGNORECASE)),
    ("weak_endpoint", "endpoint", re.compile(
        r"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]{4,}|\b(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}""",
        re.ASCII | re.IGNORECASE)),
)
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "weak_token", "weak_endpoint")

#: Texts without any of these, a long hexadecimal run or a long token hold no candidate (lower case).
HINTS = (b"passw", b"secret", b"token", b"api_key", b"apikey", b"akia", b"://", b"client", b"user", b"login",
         b"account", b"access_key", b"pwd", b"pass", b"private_key", b"host", b"endpoint", b"server")

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_PART = pa.struct([("kind", pa.string()), ("role", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_hex, _token, _digit = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_digit[48:58] = True
_hex[48:58] = _hex[97:103] = True
_token[48:58] = _token[65:91] = _token[97:123] = True
_token[[43, 45, 47, 95]] = True


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Strong spans of one text, by start, then kind as listed."""
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, pattern, group, least) in enumerate(BASE)
        for m in pattern.finditer(text) if len(m.group(group)) >= least
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


class Cover:
    """Whether a span meets any of a set of spans, found by halving: starts in order, and the greatest end so far."""

    def __init__(self, spans: list[tuple[int, int]]):
        ordered = sorted(spans)
        self.starts = [s for s, _ in ordered]
        self.ends = list(accumulate((e for _, e in ordered), max))

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def parts(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """Everything that can be one part of a credential: the strong spans and the weak ones outside them."""
    weak = [(kind, role, *m.span()) for kind, role, pattern in WEAK for m in pattern.finditer(text)]
    strong = Cover([(s, e) for _, s, e in base])
    taken = Cover([(s, e) for _, s, e in base] + [(s, e) for *_, s, e in weak])
    for m in TOKEN.finditer(text):
        token = m.group()
        if not taken.meets(*m.span()) and re.search(r"[0-9]", token) and re.search(r"[A-Za-z]", token) and len(set(token)) >= 10:
            weak.append(("weak_token", "secret", *m.span()))
    return [(k, BASE_ROLE[k], s, e) for k, s, e in base] + [w for w in weak if not strong.meets(w[2], w[3])]


def _long_runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs of at least ``least`` bytes; a run ends with its text."""
    new = np.zeros(len(mask) + 1, bool)
    new[offsets] = True
    before, after = np.zeros(len(mask), bool), np.zeros(len(mask), bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    start = np.flatnonzero(mask & (~before | new[:-1]))
    end = np.flatnonzero(mask & (~after | new[1:])) + 1
    keep = end - start >= least
    return start[keep], end[keep]


def _worth_reading(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the texts in a chunk that can hold a candidate, by literal search and run lengths on bytes."""
    low = _lower[data].tobytes()
    at = []
    for hint in HINTS:
        i = low.find(hint)
        while i >= 0:
            at.append(i)
            i = low.find(hint, i + 1)
    digits = np.concatenate([[0], np.cumsum(_digit[data])])
    start, end = _long_runs(_token[data], offsets, 20)
    at += start[digits[end] > digits[start]].tolist()
    start, end = _long_runs(_hex[data], offsets, 32)
    inside = np.concatenate([np.array(at, np.int64), start])
    return np.unique(np.searchsorted(offsets, inside, side="right") - 1)


def _candidates(text: str, keep: list[str]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, part = [[] for _ in range(len(batch))], [[] for _ in range(len(batch))]
            column = batch.column(text)
            for chunk in chunks(column):
                for i in _worth_reading(chunk.data, chunk.offsets).tolist():
                    row = chunk.lo + i
                    whole = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes().decode("utf-8", "replace")
                    base[row] = base_spans(whole)
                    found = parts(whole, base[row])
                    if len({role for _, role, _, _ in found}) > 1 and len(found) > len(base[row]):
                        part[row] = found
            own = np.random.default_rng().integers(0, 1 << 62)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [
                    pa.array(np.full(len(batch), own)), pa.array(np.arange(len(batch), dtype=np.int32)),
                    pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in base], pa.list_(_SPAN)),
                    pa.array([[dict(zip(("kind", "role", "start", "end"), p, strict=True)) for p in x] for x in part],
                             pa.list_(_PART)),
                ],
                [*keep, "__batch", "__row", "base_spans", "__parts"],
            )

    return find


def link_parts(candidates: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with a complementary part at most ``scope`` code points away: ``__batch, __row, kind, start, end``.

    The interval join runs on cells of ``scope`` code points: a part lies in the cell of its start and looks into
    every cell that its own interval, widened by the scope and the other's possible length, touches. Identifiers
    and endpoints complement secrets, and the other way round.
    """
    part = candidates.where(F.size("__parts") > 0).select("__batch", "__row", F.explode("__parts").alias("p")).select(
        "__batch", "__row", "p.*"
    )
    cell = lambda c: F.floor(c / scope).cast("int")
    reach = F.sequence(cell(F.greatest(F.col("start") - scope, F.lit(0))), cell(F.col("end") + scope))
    seeks = part.where(F.col("kind").startswith("weak_")).withColumn("cell", F.explode(reach))
    span = F.sequence(cell(F.col("start")), cell(F.col("end")))
    offered = part.select("__batch", "__row", F.col("role").alias("o_role"), F.col("start").alias("o_start"),
                          F.col("end").alias("o_end"), F.explode(span).alias("cell"))
    near = (F.col("o_start") <= F.col("end") + scope) & (F.col("start") <= F.col("o_end") + scope)
    other = (F.col("role") == "secret") != (F.col("o_role") == "secret")
    a, b = seeks.alias("a"), offered.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("__batch", "__row", "cell")]
    return a.join(b, same[0] & same[1] & same[2] & near & other, "left_semi").select(
        "__batch", "__row", "kind", "start", "end"
    ).distinct()


def scan_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None, scope: int = SCOPE) -> DataFrame:
    """The columns ``keep`` (default all) of every row of ``docs`` with ``base_spans`` and ``spans``.

    Both are arrays of ``(kind, start, end)`` in code points, end exclusive, by start, then kind as in ``KINDS``;
    ``spans`` adds linked weak parts to the base ones. A null or empty text has none. Repeated rows are judged each by
    itself. Columns of ``docs`` with these names, or with ``__batch, __row, __parts``, are replaced. Candidates are
    written to the shared folder once, which also fixes the row numbers that the join uses.
    """
    spark = docs.sparkSession
    own = {"base_spans", "spans", "__batch", "__row", "__parts"}
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in own]
    source = docs.select(*dict.fromkeys([*keep, text]))
    new = StructType.fromDDL(
        "__batch long, __row int, base_spans array<struct<kind:string,start:int,end:int>>, "
        "__parts array<struct<kind:string,role:string,start:int,end:int>>"
    )
    schema = StructType([*source.select(*keep).schema, *new])
    path = new_shared_path(spark, "secrets")
    source.mapInArrow(_candidates(text, keep), schema).write.parquet(path)
    found = spark.read.parquet(path)
    linked = link_parts(found, scope).groupBy("__batch", "__row").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("__linked")
    )
    rank = lambda k: F.array_position(F.array(*[F.lit(x) for x in KINDS]), k)
    every = F.concat("base_spans", F.coalesce("__linked", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(
        s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))))
    spans = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.join(linked, ["__batch", "__row"], "left").withColumn("spans", spans).drop(
        "__batch", "__row", "__parts", "__linked"
    )


def span_text(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _cut_out(text: str, spans: list[dict], sign: str) -> str:
    kept, at = [], 0
    for s in spans:
        if s["end"] > at:
            if s["start"] >= at:
                kept += [text[at : s["start"]], sign]
            at = s["end"]
    return "".join([*kept, text[at:]])


def redact(scanned: DataFrame, text: str = "text", sign: str = "[secret]") -> DataFrame:
    """``text`` with every span replaced by ``sign``; overlapping spans are one. Rows and columns stay."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, spans = batch.schema.get_field_index(text), batch.column("spans")
            found = pc.list_value_length(spans).to_numpy(zero_copy_only=False) > 0
            if not found.any():
                yield batch
                continue
            column = batch.column(at).to_pylist()
            for i in np.flatnonzero(found).tolist():
                column[i] = _cut_out(column[i], spans[i].as_py(), sign)
            yield batch.set_column(at, batch.schema.field(at), pa.array(column, batch.schema.field(at).type))

    return scanned.mapInArrow(cut, scanned.schema)
