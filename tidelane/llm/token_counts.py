"""Token counts of whole texts by a public vocabulary: batches in Arrow functions that give lengths only.

Texts are cut at blanks, which no token can reach across, and each different unit of a few megabytes of text is encoded
once; units longer than ``PIECE_BYTES`` are cut again at other safe places. Units are gathered into batches of about
``BATCH_BYTES``, so the ids held at once are bounded by bytes, not by rows or by the length of a text, and the lengths
are added up by text. No shuffle: a text is counted where it was read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

LIMIT = 2048
#: Bytes of one call of the library, of a piece, and of texts looked at together.
BATCH_BYTES = 1 << 20
PIECE_BYTES = 1 << 16
CHUNK_BYTES = 1 << 22
#: A worker remembers the counts of this many short units.
KNOWN_UNITS = 200_000
KNOWN_BYTES = 48

#: The normaliser and word pattern of the public vocabulary for which ``SAFE`` holds.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

#: Before an ASCII blank or digit, and between a letter or digit and a mark. Words are letters only, marks only or one
#: digit, blanks belong to none, and none of the characters behind such a place combines with the one before it.
#: ``' < | >`` are left out: they begin endings or stand in the special strings.
SAFE = re.compile(
    "(?=[\t\n\x0b\x0c\r 0-9])"
    "|(?<=[A-Za-z0-9ぁ-ゖァ-ヺ一-鿿가-힣])"
    "(?=[!\"#$%&()*+,\\-./:;=?@\\[\\\\\\]^_`{}~、。，．！？])"
)
BLANKS = r"[\t\n\x0b\x0c\r ]+"
_loaded: dict[str, tuple[Callable[[list[str]], list[int]], bool]] = {}


def is_splittable(spec: dict) -> bool:
    """Whether a vocabulary file has the normaliser, words and special strings that ``SAFE`` was made for."""
    normal, words = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    split, rest = ([*words.get("pretokenizers", []), {}, {}])[:2]
    return (
        [n.get("type") for n in normal.get("normalizers", [])] == NORMALIZERS
        and normal["normalizers"][1].get("pattern") == {"Regex": r"\s+"} and normal["normalizers"][1].get("content") == " "
        and split.get("pattern") == {"Regex": WORD_PATTERN} and split.get("behavior") == "Removed" and bool(split.get("invert"))
        and rest.get("type") == "ByteLevel" and not rest.get("add_prefix_space") and not rest.get("use_regex")
        and len(words["pretokenizers"]) == 2
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or SAFE.search(t["content"], 1)
                    for t in spec.get("added_tokens", []))
    )


def load_counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to token counts, and whether long texts may be cut for it; loaded once per worker."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), False
        elif path.endswith(".json"):
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)  # the same ids without offsets
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            _loaded[path] = (lambda texts: [len(e) for e in encode(texts, add_special_tokens=False)]), is_splittable(spec)
        else:
            raise ValueError(f"{path}: a .json or a .model file is needed")
    return _loaded[path]


def split_text(text: str, size: int) -> Iterator[str]:
    """``text`` in pieces of ``size`` characters and what follows up to the next safe place."""
    at = 0
    while len(text) - at > size and (place := SAFE.search(text, at + size)):
        yield text[at : place.start()]
        at = place.start()
    yield text[at:]


def count_units(units: pa.Array, count: Callable[[list[str]], list[int]], piece: int | None, batch_bytes: int,
                known: dict[str, int]) -> np.ndarray:
    """Tokens of each of some different units: those not ``known`` go in batches of bytes, long ones in pieces."""
    out = np.zeros(len(units), np.int64)
    held, owners, weight = [], [], 0

    def flush() -> None:
        nonlocal held, owners, weight
        if held:
            np.add.at(out, owners, count(held))
        held, owners, weight = [], [], 0

    sizes = pc.binary_length(units).to_pylist()
    for i, unit in enumerate(units.to_pylist()):
        if (have := known.get(unit)) is not None:
            out[i] = have
            continue
        for part in split_text(unit, piece) if piece and sizes[i] > piece else (unit,):
            held.append(part)
            owners.append(i)
            weight += min(len(part) * 4, sizes[i])
            if weight >= batch_bytes:
                flush()
    flush()
    if piece:
        if len(known) > KNOWN_UNITS:
            known.clear()
        known.update((u, n) for u, n, size in zip(units.to_pylist(), out.tolist(), sizes, strict=True) if size <= KNOWN_BYTES)
    return out


def count_column(column: pa.Array, count: Callable[[list[str]], list[int]], piece: int | None, batch_bytes: int,
                 known: dict[str, int] | None = None) -> np.ndarray:
    """Tokens of each text of a column. With ``piece`` texts are cut at blanks, each different unit is encoded once,
    and units of more than ``piece`` bytes are cut again; without, texts go whole."""
    known = {} if known is None else known
    column = pc.fill_null(column, "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    out, lo = np.zeros(len(column), np.int64), 0
    while lo < len(column):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
        texts = column.slice(lo, hi - lo)
        if piece:
            lists = pc.split_pattern_regex(texts, pattern=BLANKS)
            units, owner = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
        else:
            units, owner = texts, np.arange(hi - lo)
        coded = units.dictionary_encode()
        tokens = count_units(coded.dictionary, count, piece, batch_bytes, known)
        np.add.at(out, lo + owner, tokens[coded.indices.to_numpy()])
        lo = hi
    return out


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT, keep: list[str] | None = None,
                 batch_bytes: int = BATCH_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_bytes``, ``n_tokens`` and ``over_limit``, one row per row.

    ``path`` is a vocabulary file that every executor can read: ``.json`` for tokenizers, ``.model`` for sentencepiece.
    Tokens are those of the library without begin, end or added tokens, truncation or padding; special strings inside
    texts are read as the library does by itself. A null or empty text has no bytes and no tokens. Columns of the three
    names in ``docs`` are replaced; other columns, repeated rows and the order of rows do not matter. Long texts are cut
    only for vocabularies whose words ``SAFE`` respects; for others, and where a text has no safe place, they go whole.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    new = [f"column{i}" for i in range(len(kept))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, new, strict=True)],
                        F.col(f"`{text}`").cast("string").alias("text"))
    schema = StructType([*plain.schema.fields[:-1]]).add("n_bytes", "long", False).add("n_tokens", "long", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, splittable = load_counter(path)
        known: dict[str, int] = {}
        for batch in batches:
            column = batch.column("text")
            tokens = count_column(column, count, piece_bytes if splittable else None, batch_bytes, known)
            n_bytes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n_bytes, pa.array(tokens)], [*new, "n_bytes", "n_tokens"])

    counted = plain.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
    return counted.toDF(*kept, *added)
