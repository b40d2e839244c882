"""Word and byte kernels over whole Arrow columns of text.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z. In UTF-8 every byte from 0x80 up
belongs to such a word, so words can be found on bytes. A column is cut into chunks of whole texts of about
``CHUNK`` bytes; a longer text is a chunk of its own. Nulls count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[:128] = False
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = True


class Text(NamedTuple):
    """Texts ``lo`` to ``hi`` of a column: their bytes and where each begins (one more offset than texts)."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Hash, first byte and end byte of every word; ``first`` has each text's first word (one more than texts)."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Text]:
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        hi = min(hi, len(column))
        own = offsets[lo : hi + 1].astype(np.int64)
        yield Text(lo, hi, data[own[0] : own[-1]], own - own[0])
        lo = hi


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the hash base, or of its inverse, modulo 2^64."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        size = 1 << max(n, CHUNK).bit_length()
        have = np.full(size, _INVERSE if inverse else BASE, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 4 * CHUNK:
            _powers[inverse] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of ``(byte + 1) * BASE^i``: a substring's hash is a difference of two, times a power of the inverse."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=out[1:])
    return out


def words(text: Text) -> Words:
    data, offsets = text.data, text.offsets
    n = len(data)
    inside = IS_WORD[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[:-1]
    before[edges[edges < n]] = False
    edges = offsets[1:]
    after[edges[edges > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = prefix_sums(LOWER[data])
    h = mix((sums[end] - sums[start]) * powers(n + 1, True)[start])
    return Words(h, start, end, np.searchsorted(start, offsets))


def hash_words(text: str) -> list[int]:
    """The word hashes of one text."""
    (only,) = chunks(pa.array([text], pa.string()))
    return words(only).hash.tolist()


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, text by text, and where each text's begin (one more than texts).

    A text of fewer words, but not none, has one: all its words.
    """
    n, count = len(w.hash), np.diff(w.first)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out[: max(n - j, 0)] += w.hash[j:] * np.uint64(2 * pow(0x9E3779B9, j + 1, 1 << 62) + 1)
    owner = np.repeat(np.arange(len(count)), count)
    keep = np.zeros(n, bool)
    keep[: max(n - k + 1, 0)] = owner[k - 1 :] == owner[: max(n - k + 1, 0)] if n >= k else False
    for i in np.flatnonzero((count > 0) & (count < k)):
        a, b = w.first[i], w.first[i + 1]
        value = int(count[i])
        for j, h in enumerate(w.hash[a:b].tolist()):
            value = (value + h * (2 * pow(0x85EBCA6B, j + 1, 1 << 62) + 1)) % (1 << 64)
        out[a], keep[a] = value, True
    first = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(count)))])
    return mix(out[keep]), first


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte (and before the end)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
