"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Training (backpropagation through time, on the driver) uses a bounded sample of labelled rows; prediction runs in
the tasks over every byte of every text. A text is cut into windows of ``WINDOW`` bytes that run through the
network side by side; each position gets a probability for each language, and a text's probabilities are the mean
over its positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tidelane.llm.words import chunks

WINDOW = 128
HIDDEN = 8
#: The training sample: rows for each language, characters of each.
PER_LANGUAGE = 250
SAMPLE_CHARS = 512
EPOCHS = 9
BATCH = 64
RATE = 0.02
PAD = 256
CHUNK = 192 << 10


class Network(NamedTuple):
    """``x``: (2, 257, 3H) what a byte adds to update, reset and candidate; ``u``: (2, H, 3H); ``b``: (2, 1, H);
    ``o``: (2H, C); ``c``: (C,). Axis 0 is the direction.
    """

    x: np.ndarray
    u: np.ndarray
    b: np.ndarray
    o: np.ndarray
    c: np.ndarray


def start_network(classes: int, hidden: int, rng: np.random.Generator) -> Network:
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return Network(draw(2, PAD + 1, 3 * hidden, scale=0.3), draw(2, hidden, 3 * hidden, scale=hidden**-0.5),
                   draw(2, 1, hidden, scale=0.1), draw(2 * hidden, classes, scale=0.5), np.zeros(classes, np.float32))


def run_states(net: Network, codes: np.ndarray, tape: list | None = None) -> np.ndarray:
    """Hidden states (2, T, B, H) of ``codes`` (T, B); direction 1 read the window from its end.

    z and r are logistic, written with tanh; the candidate is tanh(x + r * (h U + b)).
    """
    steps, width = codes.shape
    hidden = net.u.shape[1]
    states = np.empty((2, steps, width, hidden), np.float32)
    h = np.zeros((2, width, hidden), np.float32)
    for t in range(steps):
        back = steps - 1 - t
        x = np.stack([net.x[0].take(codes[t], 0), net.x[1].take(codes[back], 0)])
        a = np.matmul(h, net.u)
        gates = x[..., : 2 * hidden]
        gates += a[..., : 2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates[..., :hidden], gates[..., hidden:]
        inner = a[..., 2 * hidden :]
        inner += net.b
        n = r * inner
        n += x[..., 2 * hidden :]
        np.tanh(n, out=n)
        before = h
        h = before - n
        h *= z
        h += n
        if tape is not None:
            tape.append((before, z, r, n, inner))
        states[0, t], states[1, back] = h[0], h[1]
    return states


def position_probabilities(net: Network, states: np.ndarray) -> np.ndarray:
    """Probability of each language (C, T, B) at every position."""
    hidden = net.u.shape[1]
    logits = states[0] @ net.o[:hidden]
    logits += states[1] @ net.o[hidden:]
    logits += net.c
    logits = np.ascontiguousarray(np.moveaxis(logits, -1, 0))
    logits -= logits.max(0)
    np.exp(logits, out=logits)
    logits /= logits.sum(0)
    return logits


def gradients(net: Network, codes: np.ndarray, labels: np.ndarray) -> tuple[float, Network]:
    """Mean cross-entropy over the positions that hold a byte, and its gradient, by backpropagation through time."""
    steps, width = codes.shape
    hidden = net.u.shape[1]
    tape: list = []
    states = run_states(net, codes, tape)
    p = position_probabilities(net, states)
    real = (codes != PAD).astype(np.float32)
    weight = real / max(real.sum(), 1)
    loss = float(-(np.log(p[labels, :, np.arange(width)].T + 1e-9) * weight).sum())
    p[labels, :, np.arange(width)] -= 1
    d = np.moveaxis(p * weight, 0, -1)
    g = Network(*(np.zeros_like(w) for w in net))
    g.c[:] = d.sum((0, 1))
    for k in (0, 1):
        g.o[k * hidden : (k + 1) * hidden] = np.tensordot(states[k], d, ((0, 1), (0, 1)))
    out = np.stack([d @ net.o[:hidden].T, d @ net.o[hidden:].T])
    dh = np.zeros((2, width, hidden), np.float32)
    for t in reversed(range(steps)):
        back = steps - 1 - t
        before, z, r, n, inner = tape[t]
        dh[0] += out[0, t]
        dh[1] += out[1, back]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (before - n) * z * (1 - z)
        dr = dn * inner * r * (1 - r)
        da = np.concatenate([dz, dr, dn * r], -1)
        dx = np.concatenate([dz, dr, dn], -1)
        g.u[:] += np.matmul(before.transpose(0, 2, 1), da)
        g.b[:] += (dn * r).sum(1, keepdims=True)
        for k, row in ((0, codes[t]), (1, codes[back])):
            np.add.at(g.x[k], row, dx[k])
        dh = dh * z + np.matmul(da, net.u.transpose(0, 2, 1))
    return loss, g


def windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes (n, size) of the windows of all texts, padded with ``PAD``, and each window's text."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        for at in range(0, len(text), size):
            row = np.full(size, PAD, np.int64)
            piece = np.frombuffer(text[at : at + size], np.uint8)
            row[: len(piece)] = piece
            parts.append(row)
            owner.append(i)
    return np.array(parts, np.int64).reshape(-1, size), np.array(owner, np.int64)


def train(texts: list[bytes], labels: list[int], classes: int, hidden: int = HIDDEN, epochs: int = EPOCHS,
          seed: int = 7) -> Network:
    """A network fitted by Adam with clipped gradients; the same texts give the same network."""
    rng = np.random.default_rng(seed)
    net = start_network(classes, hidden, rng)
    codes, owner = windows(texts)
    target = np.array(labels, np.int64)[owner]
    m, v = ([np.zeros_like(w) for w in net] for _ in range(2))
    step, total = 0, epochs * -(-len(codes) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            _, g = gradients(net, np.ascontiguousarray(codes[pick].T), target[pick])
            norm = float(np.sqrt(sum((w * w).sum() for w in g)))
            step += 1
            rate = RATE * 0.5 * (1 + np.cos(np.pi * step / total)) + 1e-4
            for w, dw, a, b in zip(net, g, m, v, strict=True):
                dw = dw * min(1.0, 1.0 / (norm + 1e-9))
                a += 0.1 * (dw - a)
                b += 0.001 * (dw * dw - b)
                w -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Mean position probabilities (texts, C) of a chunk of texts; zero for an empty one."""
    length = np.diff(offsets)
    count = -(-length // size)
    owner = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][owner] + nth * size
    out = np.zeros((len(length), len(net.c)))
    for lo in range(0, len(owner), 2048):
        own, first = owner[lo : lo + 2048], begin[lo : lo + 2048]
        at = first + np.arange(size)[:, None]
        real = at < offsets[1:][own]
        codes = np.where(real, data[np.minimum(at, len(data) - 1)].astype(np.int64), PAD)
        p = position_probabilities(net, run_states(net, codes))
        sums = (p * real).sum(1)
        for c in range(len(net.c)):
            out[:, c] += np.bincount(own, sums[c], len(length))
    return out / np.maximum(length, 1)[:, None]


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = np.concatenate([[0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122))])
    found = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(c.isalpha() for c in text)
    return found


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        per_language: int = PER_LANGUAGE, chars: int = SAMPLE_CHARS) -> tuple[list[str], Network | None]:
    """Languages and a network from ``per_language`` labelled rows of each that are not held out, picked by key hash,
    and a slice of ``chars`` characters of each, from a hashed place. That bounds what is collected: the hash first
    thins a language to about four times the rows wanted, so that no task orders all rows of a frequent one.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~F.coalesce(held_out(F.col(key)), F.lit(False)))
    rows = labelled.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.xxhash64(key, lang).alias("h"))
    share = rows.groupBy("lang").agg((F.lit(4.0 * per_language) / F.count(F.lit(1))).alias("share"))
    spread = F.pmod(F.col("h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # One row for each language, as the driver holds their names anyway: broadcast, the thinning comes before any exchange.
    some = rows.join(F.broadcast(share), "lang").where(spread < F.col("share")).select("key", "lang", "h").distinct()
    first = Window.partitionBy("lang").orderBy("h", "key")
    picked = some.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
    place = F.pmod(F.col("h"), F.greatest(F.length("text") - chars, F.lit(1))).cast("int") + 1
    rows = labelled.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")).join(
        F.broadcast(picked), ["key", "lang"]
    ).select("key", "lang", F.substring(F.col("text"), place, F.lit(chars)).alias("slice")).distinct()
    sample = sorted((r["lang"], r["key"], r["slice"].encode()) for r in rows.collect() if r["slice"])
    names = sorted({lang for lang, *_ in sample})
    if not names:
        return [], None
    return names, train([t for *_, t in sample], [names.index(lang) for lang, *_ in sample], len(names))


def _predict(names: list[str], net: Network | None, text: str):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for chunk in chunks(batch.column(text), CHUNK):
                letters = has_letter(chunk.data, chunk.offsets)
                p = pooled(net, chunk.data, chunk.offsets) if net else np.zeros((len(letters), 1))
                best = p.argmax(1)
                for i, letter in enumerate(letters.tolist()):
                    known = letter and net is not None
                    langs.append(names[best[i]] if known else "und")
                    scores.append(min(1.0, float(p[i, best[i]])) if known else 0.0)
            kept = [(n, batch.column(n)) for n in batch.schema.names if n not in ("lang_pred", "score")]
            new = [("lang_pred", pa.array(langs, pa.string())), ("score", pa.array(scores, pa.float64()))]
            yield pa.RecordBatch.from_arrays([c for _, c in kept + new], [n for n, _ in kept + new])

    return predict


def identify_languages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                       keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) of every row with ``lang_pred`` and ``score`` (mean probability).

    The network learns from ``text`` and non-null ``lang`` of rows that are not held out; a prediction sees the text
    alone. ``und`` with score 0 is given to a null text, to one without a letter, and to all if nothing is
    labelled. Ties go to the language that sorts first. Columns of these two names are replaced.
    """
    names, net = fit(docs, text, lang, key)
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in ("lang_pred", "score")]
    source = docs.select(*dict.fromkeys([*keep, text]))
    schema = StructType([*source.schema, *StructType.fromDDL("lang_pred string, score double")])
    return source.mapInArrow(_predict(names, net, text), schema).select(*keep, "lang_pred", "score")
