"""Recompression of word sequences: globally consistent names for substrings.

Level 0 names are word hashes. The first round names runs: k equal neighbours
become one symbol. Every further round names pairs: the symbols are parted
into left and right ones by a hash bit that is new in each round, and each
left symbol followed by a right one becomes one symbol. A name is the hash of
what it stands for, so equal token runs and pairs get equal names in every
task, and equal substrings get equal symbols in their interior; which symbols
near an end may differ is known from the symbols alone (``interior``).
"""

from __future__ import annotations

import numpy as np

from chunkwright.llm.words import BASE, GOLDEN, mix64

ROUNDS = 6


def _sides(names: np.ndarray, r: int) -> np.ndarray:
    """True: a right symbol in round r."""
    key = np.uint64((r + 1) * int(GOLDEN) % (1 << 64))
    return (mix64(names + key) >> np.uint64(63)).astype(bool)


def interior(names: np.ndarray, doc: np.ndarray, starts: np.ndarray, width: int, rounds: int = ROUNDS):
    """Names of the level ``rounds`` symbols, and for each window of ``width``
    words starting at ``starts`` the range [a, b) of symbols that every equal
    window shares, whatever stands around it.

    A run at a window's end may go on outside, so it does not count; in a pair
    round the first symbol may have been joined from outside if it is a right
    one, and the last if it is a left one."""
    # runs
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    index = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(names)))
    a = index[starts] + 1
    b = index[starts + width - 1]
    names, doc = names[head], doc[head]
    names = np.where(size > 1, mix64(names * np.uint64(BASE) + size.astype(np.uint64)), names)
    for r in range(rounds):
        if not len(names):
            break
        right = _sides(names, r)
        n = len(names)
        joined = np.zeros(n, bool)  # is the right half of a pair
        joined[1:] = ~right[:-1] & right[1:] & (doc[1:] == doc[:-1])
        index = np.cumsum(~joined) - 1
        index = np.append(index, index[-1] + 1)
        a = a + right[np.minimum(a, n - 1)]
        b = b - ~right[np.maximum(b - 1, 0)]
        a, b = index[np.minimum(a, n)], index[np.clip(b, 0, n)]
        head = np.flatnonzero(~joined)
        pair = np.append(joined[1:], False)[head]
        after = names[np.minimum(head + 1, n - 1)]
        names, doc = np.where(pair, mix64(names[head] * np.uint64(BASE) + mix64(after + GOLDEN)), names[head]), doc[head]
    return names, a, np.maximum(a, b)
