"""WARC archives: a writer with one gzip member for each record, and a reader that salvages damaged archives.

The reader checks every record (gzip checksum, version line, length, terminator, payload digest). Where a check
fails it searches for the next gzip member or version line at which all checks pass, goes on from there, and logs
the bytes between as a quarantined gap. Inside a member, damaged or not, it searches in the same way.

Files are written and read by Spark alone (text writer, ``binaryFile`` reader), so any file system Spark reaches
will do. A file is one row of the reader; the writer starts a new one at ``ARCHIVE_BYTES``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidelane.session import new_shared_path

ARCHIVE_BYTES = 4 << 20
FEED = 64 << 10
CANDIDATE = re.compile(rb"\x1f\x8b\x08|WARC/\d")
LINE = re.compile(rb"WARC/\d")
VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")
NEXT = re.compile(rb"\nWARC/\d+\.\d+\r?\n")
PADDING = re.compile(rb"[\r\n\x00]*")
SCHEMA = (
    "archive string, offset long, length long, kind string, reason string, record_type string, record_id string, "
    "refers_to string, target_uri string, payload_bytes long, payload_digest string, payload binary"
)


class Record(NamedTuple):
    offset: int
    length: int
    fields: dict[str, str]
    payload: bytes
    digest: str


class Gap(NamedTuple):
    offset: int
    length: int
    reason: str


class Damaged(Exception):
    """A check of a record failed."""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, record_id: str, uri: str, date: str, payload: bytes, digest: str, length: int,
                 refers_to: str | None = None) -> bytes:
    """One record. A revisit carries no payload, but the digest and length of the one it refers to."""
    uri = re.sub(r"[\r\n]+", " ", uri)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if kind == "response" else b"")
    fields = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {length}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        fields += [f"WARC-Refers-To: {refers_to}",
                   "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    return b"WARC/1.0\r\n" + "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The plain bytes of the gzip member at ``at``, its end, and what is wrong with it: then the bytes up to there."""
    begin, unzip, out, view = at, zlib.decompressobj(31), [], memoryview(data)
    while not unzip.eof:
        if at >= len(data):
            return b"".join(out), at, "truncated member"
        piece = view[at : at + FEED]  # fed in pieces so that nothing behind the member is copied
        try:
            out.append(unzip.decompress(piece))
        except zlib.error:
            return *_decode(data, begin), "bad member"
        at += len(piece)
    return b"".join(out), at - len(unzip.unused_data), ""


def _decode(data: bytes, at: int, want: int | None = None) -> tuple[bytes, int]:
    """The first ``want`` plain bytes or more of a damaged member (default: all before the damage), and where they end:
    the piece in which that is goes byte by byte.
    """
    unzip, out, size = zlib.decompressobj(31), [], 0
    while at < len(data) and not unzip.eof:
        held, stop = unzip.copy(), min(at + FEED, len(data))
        try:
            new = unzip.decompress(data[at:stop])
        except zlib.error:
            new = None
        if new is not None and (want is None or size + len(new) < want):
            out.append(new)
            size, at = size + len(new), stop
            continue
        for i in range(at, stop):
            try:
                out.append(held.decompress(data[i : i + 1]))
            except zlib.error:
                return b"".join(out), i
            size += len(out[-1])
            if want is not None and size >= want:
                return b"".join(out), i + 1
        unzip, at = held, stop
    return b"".join(out), at


def _search(plain: bytes) -> Iterator[tuple[int, tuple | str]]:
    """What a member holds, in order, with its end: records as ``_record`` gives them, or the reason of a gap."""
    at, reason = 0, ""
    while at < len(plain):
        if not reason and (padded := PADDING.match(plain, at).end()) > at:
            at = padded
            continue
        try:
            *record, end = _record(plain, at)
        except Damaged as e:
            reason = reason or str(e)
            following = LINE.search(plain, at + 1)
            at = following.start() if following else len(plain)
            continue
        if reason:
            yield at, reason
            reason = ""
        yield end, tuple(record)
        at = end
    if reason:
        yield at, reason


def _record(data: bytes, at: int) -> tuple[dict[str, str], bytes, str, int]:
    version = VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    close = data.find(b"\r\n\r\n", version.end() - 2, version.end() + FEED)
    if close < 0:  # a header of any length, up to the next version line
        following = NEXT.search(data, version.end())
        close = data.find(b"\r\n\r\n", version.end() - 2, following.start() if following else len(data))
    if close < 0:
        raise Damaged("unfinished header")
    fields: dict[str, str] = {}
    for line in data[version.end() : close].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if line and not colon:
            raise Damaged("bad header line")
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("no length")
    begin, end = close + 4, close + 4 + int(length)
    if end > len(data):
        raise Damaged("truncated record")
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("no terminator")
    payload = data[begin:end]
    if fields.get("content-type", "").startswith("application/http"):
        head, found, rest = payload.partition(b"\r\n\r\n")
        if not found:
            raise Damaged("unfinished HTTP header")
        payload = rest
    digest, said = base32_sha1(payload), fields.get("warc-payload-digest", "")
    if fields.get("warc-type") != "revisit" and said.startswith("sha1:") and said[5:] != digest:
        raise Damaged("payload digest differs")
    return fields, payload, digest, end + 4


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records and gaps of one archive, in order; together with padding they cover every byte.

    What a gzip member holds has the member's offset and length, gaps between its records too. Of a member that is
    damaged itself the records before the damage are given, with the bytes they came from; the rest is a gap.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        padded = PADDING.match(data, at).end()
        if gap is None and padded > at:
            at = padded
            continue
        broken = ""
        if data[at : at + 2] == b"\x1f\x8b":
            plain, end, broken = _member(data, at)
            held = list(_search(plain))
            last = max((stop for stop, x in held if isinstance(x, tuple)), default=0)
            if broken:
                end = _decode(data, at, last)[1] if last else at + 1
                held = [x for x in held if x[0] <= last]
            good, why = last > 0 or not broken and not held, broken or (held[0][1] if held else "")
        else:
            try:
                *record, end = _record(data, at)
                held, good = [(end, tuple(record))], True
            except Damaged as e:
                end, good, why = at + 1, False, str(e)
                broken = why
        if good:
            if gap is not None and at > gap:
                yield Gap(gap, at - gap, reason)
            gap = None
            for _, x in held:
                yield Record(at, end - at, *x) if isinstance(x, tuple) else Gap(at, end - at, x)
            at = end
            if broken:
                gap, reason = end, broken
        elif gap is None:
            gap, reason = at, why
        if gap is not None:
            following = CANDIDATE.search(data, end)
            at = following.start() if following else len(data)
    if gap is not None and len(data) > gap:
        yield Gap(gap, len(data) - gap, reason)


def _pack(archive_bytes: int, date: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                payload, digest = row["payload"] or b"", base64.b32encode(bytes.fromhex(row["digest"])).decode()
                record = record_bytes("revisit" if row["refers_to"] is not None else "response", row["record_id"],
                                      row["uri"], date, payload, digest, len(payload), row["refers_to"])
                zip_ = zlib.compressobj(6, zlib.DEFLATED, 31)
                held.append(zip_.compress(record) + zip_.flush())
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

    return pack


def write_archives(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", page: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES, date: str = "2000-01-01T00:00:00Z") -> None:
    """One record for each row of ``pages``, payload ``page`` in UTF-8 (null: empty).

    Of rows with equal payloads those with the largest ``key`` are responses, the others revisit it. A null key is
    a response and never referred to. Only payloads that occur more than once are kept as (digest, largest key); they are
    written first, so that the join is a broadcast where their file is small and a sorted one, which adaptive
    execution splits at a hot payload, where it is not.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(page), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(key).alias("order"), F.col(uri).cast("string").alias("uri"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"))
    repeated = new_shared_path(spark, "payloads")
    rows.where(F.col("order").isNotNull()).groupBy("digest").agg(
        F.max("order").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "last").write.parquet(repeated)
    named = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    records = rows.join(spark.read.parquet(repeated), "digest", "left").select(
        F.coalesce(named(F.col("order")), F.lit("<urn:page:>")).alias("record_id"), F.coalesce("uri", F.lit("")).alias("uri"),
        F.when(F.col("order") < F.col("last"), named(F.col("last"))).alias("refers_to"), "payload", "digest",
    )
    records.mapInArrow(_pack(archive_bytes, date), "archive binary").select(
        F.col("archive").cast("string").alias("value")
    ).write.option("maxRecordsPerFile", 1).text(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("kind", pa.string()),
        ("reason", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
        ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            rows, size = [], 0
            for x in salvage(content.as_py() or b""):
                if isinstance(x, Gap):
                    rows.append({"archive": path.as_py(), "offset": x.offset, "length": x.length, "kind": "gap",
                                 "reason": x.reason})
                else:
                    f, revisit = x.fields, x.fields.get("warc-type") == "revisit"
                    said = f.get("warc-payload-length", "")
                    rows.append({
                        "archive": path.as_py(), "offset": x.offset, "length": x.length, "kind": "record",
                        "record_type": f.get("warc-type"), "record_id": f.get("warc-record-id"),
                        "refers_to": f.get("warc-refers-to"), "target_uri": f.get("warc-target-uri"),
                        "payload_bytes": (int(said) if said.isdigit() else None) if revisit else len(x.payload),
                        "payload_digest": f.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else x.digest,
                        "payload": None if revisit else x.payload,
                    })
                size += len(getattr(x, "payload", b""))
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record and every gap of the archives at ``path``, one row each (columns of ``SCHEMA``).

    ``kind`` is ``record`` or ``gap``; a gap has ``offset, length, reason`` of the first failed check. A revisit's
    digest and length are those it declares. Plain archives and such with one or more records in a gzip member
    are read alike. An archive is one row, so it must fit a task's memory (2 GB is Spark's own bound).
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read, StructType.fromDDL(SCHEMA))
