"""Vectorised word splitting and hashing of Arrow text batches.

Texts are taken as UTF-8 bytes. A word is a maximal run of bytes other than
0x20 and 0x09-0x0D (all ASCII, so no multi-byte character is cut). Every word
gets a 64-bit polynomial hash of its bytes; equal words have equal hashes in
every batch and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 2 << 20  # texts are worked on in groups of about this many bytes
BLOCK = 1 << 19
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two xor-shift-multiply rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of equally long arrays of hashes, in order."""
    h = np.zeros(len(parts[0]), np.uint64)
    for i, p in enumerate(parts):
        h = h * np.uint64(BASE) + (p ^ np.uint64(i + 1))
    return mix64(h)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each window of ``width`` neighbouring hashes, by doubling."""
    done, at, n = None, 0, len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, length = hashes, 1
    while width:
        if width & 1:
            part = power[at : at + n]
            done = part.copy() if done is None else mix64(done * np.uint64(BASE) + part + np.uint64(length))
            at += length
        width >>= 1
        if width:
            power = mix64(power[:-length] * np.uint64(BASE) + power[length:] + np.uint64(length))
            length *= 2
    return done


@dataclass
class Words:
    """The words of some texts: byte positions in ``data``, the text each is
    in, its hash; ``first[i]:first[i+1]`` are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def take(self, rows: np.ndarray) -> Words:
        """The words of some of the texts, numbered anew."""
        parts = [self.data[self.offsets[r] : self.offsets[r + 1]] for r in rows]
        offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
        return split_words(np.concatenate(parts) if parts else np.zeros(0, np.uint8), offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def raw(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def _lowered() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of the texts data[offsets[i]:offsets[i+1]]. Hashing goes by
    blocks that end between words, so memory beyond the word table is bounded
    unless a single word is longer than a block."""
    if lower:
        data = _lowered()[data]
    table = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
    n = len(data)
    if n:
        gap = (data == 32) | ((data >= 9) & (data <= 13))
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        word = ~gap
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = word[:-1]
        start = np.flatnonzero(word & (~before | cut[:n]))
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = word[1:]
        end = np.flatnonzero(word & (~after | cut[1:])) + 1
    else:
        start = end = np.zeros(0, np.int64)
    hashes = np.empty(len(start), np.uint64)
    at, size = 0, 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(end, start[at] + BLOCK, "right")))
        a, b = int(start[at]), int(end[upto - 1])
        if b - a > size:
            size = max(b - a, BLOCK)
            up, down = _powers(BASE, size), _powers(INVERSE, size)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * up[: b - a], out=sums[1:])
        s, e = start[at:upto] - a, end[at:upto] - a
        hashes[at:upto] = mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = upto
    first = np.searchsorted(start, offsets).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, start, end, doc, hashes, first, offsets)


def text_groups(column: pa.Array, group_bytes: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of
    about group_bytes of text; a longer text makes a group of its own. Null
    texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + group_bytes, "right")) - 1)
        yield row, upto, data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row]
        row = upto


def word_groups(column: pa.Array, lower: bool = False, group_bytes: int = GROUP_BYTES) -> Iterator[tuple[int, int, Words]]:
    for a, b, data, offsets in text_groups(column, group_bytes):
        yield a, b, split_words(data, offsets, lower)


def doc_windows(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the windows that lie inside one text."""
    h = windows(w.hash, width)
    at = np.flatnonzero(w.doc[: len(h)] == w.doc[width - 1 :]) if len(h) else np.zeros(0, np.int64)
    return at, h[at]


def sums_by_doc(values: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(docs, weights=values, minlength=n)
