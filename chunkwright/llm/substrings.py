"""Operator 8: substring de-duplication by recompression.

Every text is recompressed (see ``recompress``) into high-level symbols with
globally consistent names. A Spark round marks the names that occur twice or
more anywhere (``repeats``); a window of words can only be repeated if all
symbols in its interior are. The windows that pass, and those without an
interior, are verified by their 96-bit hashes: a task settles what repeats
within its own batch and sends each other window once to the bucket that owns
its hash. Every word covered by a repeated window is removed.

Edge cases: a null or empty text has no words and nothing is removed; texts
below ``WIDTH`` words are never touched; repeated rows are copies of each
other, so all their windows repeat (copies are judged on the input, none is
spared); a text is handled whole, its memory follows its own length; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chunkwright.llm.common import fresh
from chunkwright.llm.recompress import interior
from chunkwright.llm.repeats import is_repeated, map_bits, repeat_bitmap
from chunkwright.llm.words import Words, doc_windows, mix64, windows, word_groups

WIDTH = 35
SYMBOLS_A_ROW = 128  # about; sizes the bit map only
ROWS_A_BUCKET = 4000


def _windows(w: Words, width: int):
    """Window starts, their two hashes, and the symbols inside each."""
    at, h1 = doc_windows(w, width)
    if not len(at):
        return at, h1, h1, np.zeros(0, np.uint64), at, at
    names, a, b = interior(w.hash, w.doc, at, width)
    h2 = windows(mix64(w.hash ^ np.uint64(0x5851F42D4C957F2D)), width)[at]
    return at, h1, h2, names, a, b


def _symbol_names(width: int):
    def hashes(batch):
        for _, _, w in word_groups(batch.column("text")):
            yield _windows(w, width)[3]

    return hashes


def _candidates(w: Words, width: int, bitmap: np.ndarray, bits: int):
    """Starts and hashes of the windows whose inner symbols all repeat."""
    at, h1, h2, names, a, b = _windows(w, width)
    missing = np.concatenate(([0], np.cumsum(~is_repeated(bitmap, names, bits))))
    ok = missing[b] == missing[a]
    return at[ok], h1[ok], (h2[ok] >> np.uint64(32)).astype(np.uint32)


def repeated_windows(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """rows (key long, text) -> (key, starts): for each key that has any, the
    starts of its repeated windows as packed 32-bit integers. Answers travel
    in one block for each pair of hash bucket and key slice, so their rows do
    not grow with documents times buckets."""
    spark = rows.sparkSession
    count = rows.count()
    bits = map_bits(count * SYMBOLS_A_ROW)
    shared = spark.sparkContext.broadcast(repeat_bitmap(rows, _symbol_names(width), bits))
    buckets = max(1, -(-count // ROWS_A_BUCKET))

    def settled(key, at):
        """Blocks (slice, key and start of each window) of the owning slices."""
        part = (mix64(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((at, key, part))
        cuts = np.searchsorted(part[order], np.arange(buckets + 1))
        numbers = np.flatnonzero(np.diff(cuts))
        picks = [order[cuts[s] : cuts[s + 1]] for s in numbers]
        return numbers.astype(np.int32), [np.uint32(len(o)).tobytes() + key[o].tobytes() + at[o].tobytes() for o in picks]

    def block(numbers, done: bool, blobs):
        return pa.RecordBatch.from_pydict({"part": pa.array(numbers, pa.int32()), "done": pa.array([done] * len(blobs), pa.bool_()), "cells": pa.array(blobs, pa.binary())})

    def send(batches):
        bitmap = shared.value
        for batch in batches:
            keys = batch.column("key").to_numpy()
            found = []
            for a, b, w in word_groups(batch.column("text")):
                at, h1, h2 = _candidates(w, width, bitmap, bits)
                doc = w.doc[at]
                found.append((h1, h2, keys[a + doc], (at - w.first[doc]).astype(np.uint32)))
            if not found or not sum(len(f[0]) for f in found):
                continue
            h1, h2, key, at = (np.concatenate(c) for c in zip(*found))
            order, same = _sorted_hashes(h1, h2)
            local = order[same[:-1] | same[1:]]  # repeated within the batch: settled here
            numbers, blobs = settled(key[local], at[local])
            yield block(numbers, True, blobs)
            # one of each hash goes to its bucket; a locally repeated one asks for no answer
            one, asks = order[~same[:-1]], ~same[1:][~same[:-1]]
            bucket = (h1[one] % np.uint64(buckets)).astype(np.int64)
            turn = np.lexsort((at[one], key[one], bucket))
            one, asks, bucket = one[turn], asks[turn], bucket[turn]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            numbers, blobs = np.flatnonzero(np.diff(cuts)), []
            for s in numbers:
                part = one[cuts[s] : cuts[s + 1]]
                blobs.append(b"".join((
                    np.uint32(len(part)).tobytes(), h1[part].tobytes(), key[part].tobytes(), h2[part].tobytes(), at[part].tobytes(), asks[cuts[s] : cuts[s + 1]].tobytes(),
                )))
            yield block(numbers.astype(np.int32), False, blobs)

    def answer(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            done = batch.filter(batch.column("done"))
            yield pa.RecordBatch.from_arrays([done.column("part"), done.column("cells")], ["part", "cells"])
            for s, done, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if not done:
                    held.setdefault(s, []).append(blob)
        for s in sorted(held):
            h1, key, h2, at, asks = (np.concatenate(c) for c in zip(*map(_unpacked, held.pop(s))))
            order, same = _sorted_hashes(h1, h2)
            hit = order[same[:-1] | same[1:]]
            hit = hit[asks[hit]]
            numbers, blobs = settled(key[hit], at[hit])
            yield pa.RecordBatch.from_pydict({"part": pa.array(numbers, pa.int32()), "cells": pa.array(blobs, pa.binary())})

    def by_key(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for s, blob in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(s, []).append(blob)
        for s in sorted(held):
            key, at = (np.concatenate(c) for c in zip(*((np.frombuffer(x, np.int64, n, 4), np.frombuffer(x, "<u4", n, 4 + 8 * n)) for x, n in _sized(held.pop(s)))))
            order = np.lexsort((at, key))
            key, at = key[order], at[order]
            cut = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
            yield pa.RecordBatch.from_pydict({"key": pa.array(key[cut[:-1]]), "starts": pa.array([at[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary())})

    sent = rows.mapInArrow(send, "part int, done boolean, cells binary").repartition(buckets, "part")
    return sent.mapInArrow(answer, "part int, cells binary").repartition(buckets, "part").mapInArrow(by_key, "key long, starts binary")


def _sorted_hashes(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by both hashes, and which entry equals the one before it
    (with False at both ends)."""
    order = np.lexsort((h2, h1))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    return order, same


def _sized(blobs):
    return [(x, int(np.frombuffer(x, np.uint32, 1)[0])) for x in blobs]


def _unpacked(blob: bytes):
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    take = lambda kind, size, start: np.frombuffer(blob, kind, n, start)
    return take(np.uint64, 8, 4), take(np.int64, 8, 4 + 8 * n), take(np.uint32, 4, 4 + 16 * n), take(np.uint32, 4, 4 + 20 * n), take(bool, 1, 4 + 24 * n)


def _kept(text: bytes, starts: bytes | None, width: int) -> tuple[int, list[bytes]]:
    words = text.split()  # bytes are split at 0x20 and 0x09-0x0D
    if not starts:
        return len(words), words
    at = np.frombuffer(starts, "<u4").astype(np.int64)
    cover = np.bincount(at, minlength=len(words) + width) - np.bincount(at + width, minlength=len(words) + width)[: len(words) + width]
    return len(words), list(compress(words, (np.cumsum(cover)[: len(words)] <= 0).tolist()))


def _joined(docs: DataFrame, id_col: str, text: str, width: int):
    key, starts = fresh(docs, "_key", "_starts")
    tagged = docs.withColumn(key, F.xxhash64(F.col(id_col), F.coalesce(F.col(text), F.lit(""))))
    found = repeated_windows(tagged.select(F.col(key).alias("key"), F.col(text).alias("text")), width)
    per = found.select(F.col("key").alias(key), F.col("starts").alias(starts))
    return tagged.join(per, key, "left").drop(key), starts


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """docs with two more columns: n_removed and kept_text, the words that
    stay joined by one space."""
    rows, starts = _joined(docs, id_col, text, width)
    names, at = docs.columns, docs.columns.index(text)

    def run(batches):
        for batch in batches:
            kept = [_kept((t or "").encode(), b, width) for t, b in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist())]
            columns = batch.columns[:-1] + [pa.array([n - len(k) for n, k in kept], pa.int64()), pa.array([b" ".join(k).decode() for _, k in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_removed", "kept_text"])

    fields = StructType([*docs.schema.fields, StructField("n_removed", LongType()), StructField("kept_text", StringType())])
    return rows.select(*names, starts).mapInArrow(run, fields)


def substring_digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    rows, starts = _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", "text", width)

    def run(batches):
        for batch in batches:
            kept = [_kept((t or "").encode(), b, width) for t, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_words": pa.array([n for n, _ in kept], pa.int64()), "n_removed": pa.array([n - len(k) for n, k in kept], pa.int64()),
                "kept_sha256": [hashlib.sha256(b" ".join(k)).hexdigest() for _, k in kept],
            })

    return rows.select("doc_id", "text", starts).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+34], ' ')) AS win FROM d, unnest(range(1, len(ws) - 33)) AS t(i)),
p AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY win) AS c FROM g) WHERE c >= 2),
c AS (SELECT DISTINCT doc_id, i + k AS pos FROM p, unnest(range(0, 35)) AS t(k)),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
k AS (SELECT w.doc_id, count(*) AS n_words, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY w.pos) FILTER (c.pos IS NULL) AS kept
      FROM w LEFT JOIN c ON w.doc_id = c.doc_id AND w.pos = c.pos GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
