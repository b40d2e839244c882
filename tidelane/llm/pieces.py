"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model is compiled into a normaliser (a letter transducer: dummy prefix, white space to its sign), a piece
transducer (a trie whose final states emit a piece at its weight, and byte-fallback arcs for letters that no piece
holds), and, for BPE models, a filter over pairs of neighbouring pieces. Composed with an input they give a lattice
whose shortest path in the tropical semiring is the encoding.

Unigram models weigh a piece by its negative score. A BPE model's merges are no sum of weights; but a segmentation
is the BPE one exactly if every two neighbours, taken alone, would be merged to just those two. So its filter gives a
pair weight 0 or infinity, and the path left in the lattice is the BPE encoding.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

SIGN = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: Weight of an unknown letter above the worst piece of a unigram model (fixed value).
UNKNOWN_PENALTY = 10.0
#: Stands for a letter of no piece where pairs of pieces are merged.
UNKNOWN_LETTER = "\ufffe"
#: Bytes of inputs and results that a cache holds, and the longest input it keeps.
CACHE_BYTES = 128 << 20
CACHED_LETTERS = 64
#: What an entry takes besides its own bytes.
ENTRY_BYTES = 150


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}[key & 7] if key & 7 != 2 else number()
            yield key >> 3, data[at : at + size]
            at += size


class Cache(dict):
    """Results by input, computed when missing; emptied when it holds ``CACHE_BYTES``. Long inputs are not kept."""

    def __init__(self, make):
        super().__init__()
        self.make, self.held = make, 0

    def __missing__(self, key):
        value = self.make(key)
        letters = len(key) if isinstance(key, str) else 1
        if letters <= CACHED_LETTERS:
            if self.held >= CACHE_BYTES:
                self.clear()
                self.held = 0
            self[key] = value
            self.held += ENTRY_BYTES + 4 * letters + (len(value) if isinstance(value, bytes) else 0)
        return value


class PieceTransducer:
    """A compiled model file: ``encode`` and ``decode`` of whole texts."""

    def __init__(self, model: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback = UNIGRAM, False
        self.prefix, self.squeeze, self.escape = True, True, True
        for field, value in _fields(model):
            if field == 1:
                p = dict(_fields(value))
                self.pieces.append((p[1].decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, NORMAL)))
            elif field == 2:
                spec = dict(_fields(value))
                self.kind, self.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif field == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("a model with a compiled character map is not supported")
                self.prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if not self.escape:
            raise ValueError("a model must turn white space into its sign")
        if any(kind == USER for *_, kind in self.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.number = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.byte = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        #: A node: its piece or None, and its children by letter.
        self.trie: list = [None, {}]
        for piece, i in self.number.items():
            node = self.trie
            for letter in piece:
                node = node[1].setdefault(letter, [None, {}])
            node[0] = i
        self.longest = max(map(len, self.number), default=1)
        self.worst = min((score for _, score, kind in self.pieces if kind == NORMAL), default=0.0)
        self.bytes_of = [
            bytes([int(p[1:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode()
            if kind == UNKNOWN else p.replace(SIGN, " ").encode() for p, _, kind in self.pieces
        ]
        pairs = {(a, b) for p in self.number for a, b in zip(p, p[1:], strict=False)}
        self.unit = re.compile(self._units(pairs), re.DOTALL)
        self.names = [p for p, *_ in self.pieces] + [UNKNOWN_LETTER]
        self.pair_ok = Cache(self._pair_ok)
        find = self._filtered_path if self.kind == BPE else self.shortest_path
        self.unit_ids = Cache(lambda unit: np.array(find(unit), np.int32).tobytes())

    def _units(self, pairs: set[tuple[str, str]]) -> str:
        """A pattern for units that no piece crosses, so that each has its own lattice; the whole text if there are none.

        A text falls apart before a sign that follows another letter, around line ends and tabs of no piece, and
        between the letters that stop marks are connected to through neighbours in pieces and all others.
        """
        if any(b == SIGN != a for a, b in pairs):
            return ".+"
        letters = {c for p in self.number for c in p}
        apart = "".join(c for c in "\n\r\t" if c not in letters)
        marks, beside = {"."}, {c: set() for c in letters}
        for a, b in pairs:
            if a != SIGN:
                beside[a].add(b)
                beside[b].add(a)
        todo = ["."]
        while todo:
            new = beside.get(todo.pop(), set()) - marks
            marks |= new
            todo += new
        kind = re.escape("".join(sorted(marks)))
        inner = f"{SIGN}*[^{SIGN}{apart}{kind}]+|{SIGN}*[{kind}]+"
        return f"{inner}|{SIGN}+" + (f"|[{apart}]+" if apart else "")

    def normalise(self, text: str) -> str:
        """The normaliser's output: spaces squeezed if the model asks for it, a dummy prefix, signs for spaces."""
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return ((" " if self.prefix else "") + text).replace(" ", SIGN)

    def merges(self, letters: str) -> list[str]:
        """Greedy merging: the best-scored neighbours first, the leftmost of equals."""
        parts = list(letters)
        while len(parts) > 1:
            scored = [(-self.pieces[n][1], i) for i in range(len(parts) - 1)
                      if (n := self.number.get(parts[i] + parts[i + 1])) is not None]
            if not scored:
                break
            _, i = min(scored)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _pair_ok(self, pair: int) -> bool:
        """The BPE filter: two neighbours are let through if merging their letters gives just these two.

        A pair is one number; the left piece is counted from 1, so that 0 stands for the start.
        """
        left, right = divmod(pair, len(self.names))
        left, right = self.names[left - 1] if left else "", self.names[right]
        return self.merges(left + right) == ([left, right] if left else [right])

    def arcs(self, letters: str, at: int) -> Iterator[tuple[int, int | None]]:
        """End and piece of every arc that starts at a letter; None is the unknown letter."""
        node, end, single = self.trie, at, False
        while end < len(letters) and (node := node[1].get(letters[end])) is not None:
            end += 1
            if node[0] is not None:
                single |= end == at + 1
                yield end, node[0]
        if not single:
            yield at + 1, None

    def shortest_path(self, letters: str) -> list[int]:
        """Piece numbers along the cheapest path through the composed lattice of one unit.

        A state is a place; all arcs go right, so states are final from left to right. Of equal paths the first
        relaxed stays.
        """
        best: list[tuple[float, int, int | None] | None] = [(0.0, 0, None)] + [None] * len(letters)
        for at in range(len(letters)):
            if (here := best[at]) is None:
                continue
            for end, piece in self.arcs(letters, at):
                cost = here[0] + (UNKNOWN_PENALTY - self.worst if piece is None else -self.pieces[piece][1])
                if best[end] is None or cost < best[end][0]:
                    best[end] = cost, at, piece
        place, path = len(letters), []
        while place:
            _, at, piece = best[place]
            path.append((piece, letters[at:place]))
            place = at
        return self._emit(path)

    def _filtered_path(self, letters: str) -> list[int]:
        """The path of weight 0 through the lattice composed with the BPE filter.

        A prefix has one encoding, so at each place one piece can stand last: the state is that piece, and the first
        arc that the filter lets through is the only one.
        """
        roots, ok, n, unknown = self.trie[1], self.pair_ok, len(self.names), len(self.names) - 1
        size = len(letters)
        last: list[int] = [-1] * (size + 1)
        start = [0] * (size + 1)
        for at in range(size):
            before = (last[at] + 1) * n if at else 0
            children, end = roots, at
            for letter in letters[at : at + self.longest]:
                node = children.get(letter)
                if node is None:
                    break
                end += 1
                piece, children = node
                if piece is not None and last[end] < 0 and ok[before + piece]:
                    last[end], start[end] = piece, at
            if last[at + 1] < 0:
                last[at + 1], start[at + 1] = unknown, at
        place, path = size, []
        while place:
            at = start[place]
            path.append((last[place] if last[place] != unknown else None, letters[at:place]))
            place = at
        return self._emit(path)

    def _emit(self, path: list[tuple[int | None, str]]) -> list[int]:
        """Output of a path given from its end: pieces, and the bytes (or the unknown piece) of other letters."""
        out: list[int] = []
        for piece, own in reversed(path):
            if piece is not None:
                out.append(piece)
            elif self.byte_fallback:
                out += [self.byte[b] for b in own.encode()]
            else:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> np.ndarray:
        units = self.unit.findall(self.normalise(text))
        return np.frombuffer(b"".join(map(self.unit_ids.__getitem__, units)), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of piece numbers: the inverse transducer. Bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_loaded: dict[str, PieceTransducer] = {}


def _compiled(model: bytes) -> PieceTransducer:
    key = hashlib.sha256(model).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = PieceTransducer(model)
    return _loaded[key]


def _encoder(sent, text: str, keep: list[str]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _compiled(sent.value)
        for batch in batches:
            ids, same = [], []
            for t in batch.column(text):
                t = t.as_py() or ""
                ids.append(fst.encode(t))
                same.append(fst.decode(ids[-1].tolist()) == t)
            count = np.array([len(x) for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(count),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(same, pa.bool_())],
                [*keep, "n_tokens", "ids", "round_trip"],
            )

    return encode


def encode_pieces(docs: DataFrame, model_file: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) of every row with ``n_tokens``, ``ids`` and ``round_trip``.

    ``round_trip``: decoding the pieces gives the text back. A null or empty text has no pieces and decodes to the
    empty text. Columns with these names are replaced. The model file (a vocabulary, whose size the data does not
    change) is read by the driver and broadcast.
    """
    with open(model_file, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in ("n_tokens", "ids", "round_trip")]
    source = docs.select(*dict.fromkeys([*keep, text]))
    schema = StructType([*source.select(*keep).schema, *StructType.fromDDL("n_tokens long, ids array<int>, round_trip boolean")])
    return source.mapInArrow(_encoder(sent, text, keep), schema)


def decode_pieces(encoded: DataFrame, model_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text ``out`` of every row's piece numbers; null for null."""
    with open(model_file, "rb") as f:
        sent = encoded.sparkSession.sparkContext.broadcast(f.read())
    source = encoded.drop(out)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _compiled(sent.value)
        for batch in batches:
            texts = [None if x is None else fst.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return source.mapInArrow(decode, StructType([*source.schema, StructField(out, StringType())]))
