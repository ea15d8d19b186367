"""Operator 13: runs (maximal periodic stretches) of words in a text.

A run has a smallest period q, at least max(``MIN_LENGTH``, 2 q) words, and no
neighbouring word extends it. The words of a run of length L and period q
occur at least floor(L / q) >= 2 times inside it, so recursive frequency
splitting finds where runs can be: inside a segment (at first the text), a
word with fewer than two occurrences can be in no run and splits the segment;
a segment of fewer than ``MIN_LENGTH`` words is dropped; the rest is counted
again, to stability. Run and segment can't cross, since the word that ends a
segment is in no run.

Surviving segments are scanned by lag: a run of period q has at least 2 q
words, so it holds a multiple of q (from the segment's start) and the word q
after it. All such pairs of all lags (m log m for m words) are compared at
once, equal ones are extended to both sides by binary search over prefix
hashes, and a stretch found under several lags has the least as its period.
Every run found is then compared word by word; should a hash ever have been
wrong, the segment is scanned lag by lag without hashes.

Texts are worked on in groups of 2 MB (a longer text by itself), all segments
of a group together in numpy; Spark spreads the documents.

Edge cases: null or blank texts have no words and no runs; words are compared
by 64-bit hashes of their bytes; very long texts are whole; repeated rows and
ids give equal rows, each by itself; in the digest a null id plants nothing;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import WORD
from chunkwright.llm.words import BASE, INVERSE, Words, word_groups

MIN_LENGTH = 12
PAIRS = 1 << 20  # lag pairs compared at once


def survivors(word: np.ndarray, doc: np.ndarray, least: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(first, after the last) positions of the segments that frequency
    splitting leaves. word: number of each word, doc: its text."""
    at, segment = np.arange(len(word)), doc
    size = int(word.max()) + 1 if len(word) else 1
    while len(at):
        _, inverse, counts = np.unique(segment.astype(np.int64) * size + word[at], return_inverse=True, return_counts=True)
        stays = counts[inverse] >= 2
        kept = at[stays]
        if not len(kept):
            return kept, kept
        cut = np.append(True, (np.diff(kept) > 1) | (segment[stays][1:] != segment[stays][:-1]))
        number = np.cumsum(cut) - 1
        long = np.bincount(number) >= least
        if stays.all() and long.all():
            first = kept[cut]
            return first, np.append(kept[:-1][cut[1:]], kept[-1]) + 1
        at, segment = kept[long[number]], number[long[number]]
    return at, at


class Extender:
    """Longest equal stretches of a sequence and itself at a lag, from prefix
    hashes; all arguments are arrays."""

    def __init__(self, word: np.ndarray):
        n = len(word)
        self.power, down = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
        self.power[1:], down[1:] = BASE, INVERSE & (2**64 - 1)
        np.cumprod(self.power, out=self.power)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(word * self.power[:n], out=self.prefix[1:])

    def same(self, a: np.ndarray, lag: np.ndarray, length: np.ndarray) -> np.ndarray:
        p = self.prefix
        return (p[a + length] - p[a]) * self.power[lag] == p[a + lag + length] - p[a + lag]

    def forward(self, a: np.ndarray, lag: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from a on equal those lag later, at most ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(a, lag, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def back(self, a: np.ndarray, lag: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same for the words before a."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(a - mid, lag, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, 0..counts[row]-1) for every row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _lag_pairs(first: np.ndarray, last: np.ndarray):
    """Blocks of (first word, segment, lag): every multiple of every lag up to
    half a segment, where the word a lag later is in the segment too."""
    length = last - first
    segment, lag = _ranges(length // 2)
    lag = lag + 1
    pairs = (length[segment] - 1) // lag
    total = np.cumsum(pairs)
    a = 0
    while a < len(pairs):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right")))
        row, k = _ranges(pairs[a:b])
        yield first[segment[a:b][row]] + k * lag[a:b][row], segment[a:b][row], lag[a:b][row]
        a = b


def _distinct(runs: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) in order, with the least period of each stretch."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(1))] if len(runs) else runs


def plain_scan(word: np.ndarray, a: int, b: int, least: int) -> np.ndarray:
    """Runs of one segment, each lag compared in full."""
    out = []
    for q in range(1, (b - a) // 2 + 1):
        equal = np.concatenate(([False], word[a : b - q] == word[a + q : b], [False]))
        edge = np.flatnonzero(np.diff(equal.astype(np.int8)))
        for i, j in zip(edge[::2], edge[1::2]):
            if j - i + q >= max(least, 2 * q):
                out.append((a + i, j - i + q, q))
    return _distinct(np.array(out, np.int64).reshape(-1, 3))


def lag_scan(word: np.ndarray, first: np.ndarray, last: np.ndarray, least: int = MIN_LENGTH) -> np.ndarray:
    """Runs (start, length, period) inside the segments, by start, then
    length; word: 64-bit hashes."""
    found, extend = [np.zeros((0, 4), np.int64)], Extender(word)
    for a, segment, lag in _lag_pairs(first, last):
        hit = word[a] == word[a + lag]
        a, segment, lag = a[hit], segment[hit], lag[hit]
        ahead = extend.forward(a, lag, last[segment] - a - lag)
        behind = extend.back(a, lag, a - first[segment])
        length = ahead + behind + lag
        ok = length >= np.maximum(least, 2 * lag)
        found.append(np.unique(np.stack([(a - behind)[ok], length[ok], lag[ok], segment[ok]], 1), axis=0))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(1))]
    wrong = {int(s) for start, length, q, s in runs.tolist() if (word[start : start + length - q] != word[start + q : start + length]).any()}
    if wrong:  # a prefix hash misled
        parts = [runs[~np.isin(runs[:, 3], list(wrong)), :3], *[plain_scan(word, int(first[s]), int(last[s]), least) for s in wrong]]
        return _distinct(np.concatenate(parts))
    return runs[:, :3]


def text_runs(w: Words, least: int = MIN_LENGTH) -> np.ndarray:
    """Rows (text, start, length, period) of a group of texts, by text, start,
    then period; start counts words of the text."""
    if not len(w.hash):
        return np.zeros((0, 4), np.int64)
    word = np.unique(w.hash, return_inverse=True)[1]
    first, last = survivors(word, w.doc, least)
    if not len(first):
        return np.zeros((0, 4), np.int64)
    # the segments alone, close together
    row, k = _ranges(last - first)
    at = first[row] + k
    moved = np.append(0, np.cumsum(last - first))
    runs = lag_scan(w.hash[at], moved[:-1], moved[1:], least)
    start = at[runs[:, 0]]
    text = w.doc[start]
    out = np.stack([text, start - w.first[text], runs[:, 1], runs[:, 2]], 1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def collapsed(w: Words, runs: np.ndarray) -> list[bytes]:
    """The words of each text outside every run's repeats, joined by a space."""
    start = w.first[runs[:, 0]] + runs[:, 1]
    edge = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(edge, start + runs[:, 3], 1)
    np.add.at(edge, start + runs[:, 2], -1)
    keep = np.cumsum(edge[:-1]) == 0
    out, data, starts, ends = [], w.data.tobytes(), w.start.tolist(), w.end.tolist()
    kept = np.flatnonzero(keep)
    border = np.searchsorted(kept, w.first)
    kept = kept.tolist()
    for a, b in zip(border[:-1].tolist(), border[1:].tolist()):
        out.append(b" ".join([data[starts[i] : ends[i]] for i in kept[a:b]]))
    return out


def find_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = MIN_LENGTH) -> DataFrame:
    """One row per document: id, runs (start, length, period; by start, then
    period) and the text without the runs' repeats."""

    def run(batches):
        for batch in batches:
            for a, b, w in word_groups(batch.column(1)):
                runs = text_runs(w, least)
                border = np.searchsorted(runs[:, 0], np.arange(b - a + 1)).astype(np.int32)
                struct = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).slice(a, b - a), "runs": pa.ListArray.from_arrays(border, struct),
                    "collapsed": pa.array(collapsed(w, runs), pa.binary()).cast(pa.string()),
                })

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def planted(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and text; in a tenth of the documents, chosen by the id's checksum,
    the words from a place on repeat with a period, both from the checksum."""
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), 1)
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text).alias(text), F.crc32(F.col(id_col).cast("string")).alias("h"))
    repeated = F.expr("""
        transform(array(words), ws -> transform(array(named_struct('n', size(ws), 'a', int((h div 10) % greatest(size(ws), 1)))),
          c -> array_join(transform(ws, (x, i) -> CASE WHEN i < c.a THEN x ELSE
               ws[int(c.a + (i - c.a) % (1 + (c.n - c.a) div (3 + (h div 10) % 8)))] END), ' '))[0])[0]""")
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    rows = rows.withColumn("words", F.when(chosen, words))
    return rows.select(id_col, F.when(chosen & (F.size("words") > 0), repeated).otherwise(F.col(text)).alias(text))


def run_digest(docs: DataFrame) -> DataFrame:
    """One row per document: n_runs, the longest run's start, length, period
    and exponent_milli, runs_sha256, collapsed_sha256."""
    out = find_runs(planted(docs.withColumn("doc_id", F.col("doc_id").cast("long"))))
    top = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return out.select("*", top.alias("top")).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
