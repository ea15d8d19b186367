"""Chunks of texts that are no single row (C6, C7 over ranges).

A text arrives as ranges: rows (rel_path, range_no, body, ahead, max_chars)
whose bodies in order make the text; ahead holds the max_chars + 1 characters
after the body (fewer only where the text ends). Where the chunks of a range
start depends on the range before it, so the work is done in three steps:

1. Every range maps each place where a first chunk could start in it to the
   place where the first chunk of the next range then starts, and to the
   number of chunks between. Both cutting rules are monotone (a later start
   never gives an earlier next start), so the map is a short list of steps.
2. The steps of a file, which hold no text, are composed in order from place
   0: that gives each range its true first place and its first chunk number.
3. Each range cuts its own chunks.

The text is moved once, to write the ranges in buckets of (rel_path,
range_no); steps and starts meet it there. A file may so be larger than a row
can hold, and its ranges are cut in as many tasks. ``text_ranges`` cuts a
table's texts, ``sources.tree.scan_ranges`` reads the ranges of files.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.session import stage_buckets

RANGE_KEY = ["rel_path", "range_no"]
RANGE_SCHEMA = "rel_path string, range_no bigint, body string, ahead string, max_chars bigint"
STEPS = pa.list_(pa.struct([("place", pa.int64()), ("leave", pa.int64()), ("chunks", pa.int64())]))


def text_ranges(files: DataFrame, chars: int, max_chars: str = "max_chars", extra: int = 1) -> DataFrame:
    """Ranges of `chars` characters of a table (rel_path, text, max_chars). An
    empty or NULL text has no range."""

    def run(batches):
        for batch in batches:
            for path, text, most in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                for first in range(0, len(text), chars):
                    end = first + chars
                    yield pa.RecordBatch.from_pydict({
                        "rel_path": [path], "range_no": pa.array([first // chars], pa.int64()), "body": [text[first:end]],
                        "ahead": [text[end : end + most + extra]], "max_chars": pa.array([most], pa.int64())})

    rows = files.where(F.length("text") > 0).select("rel_path", "text", F.col(max_chars).cast("bigint").alias("max_chars"))
    return rows.mapInArrow(run, RANGE_SCHEMA)


def next_starts(body: str, ahead: str, most: int, kind: str) -> np.ndarray:
    """For each place of the body, where the chunk that starts there ends (and
    the next one starts), counted from the body's start."""
    code = np.frombuffer((body + ahead).encode("utf-32-le", "surrogatepass"), "<u4")
    total, at = len(code), np.arange(len(body))
    last = np.minimum(at + most, total)
    if kind == "word":  # the separator opens the next chunk
        cut = np.isin(code, [ord(c) for c in P.CHUNK_SEPARATORS])
        seen = np.maximum.accumulate(np.where(cut, np.arange(total), -1)) if total else at
        found = seen[np.minimum(last, total - 1)] if total else at
        found = np.where(last < total, found, -1)
    else:  # the newline closes its chunk
        seen = np.maximum.accumulate(np.where(code == 10, np.arange(1, total + 1), 0)) if total else at
        found = seen[last - 1]
    return np.where(last >= total, total, np.where(found > at, found, at + most))


def range_steps(body: str, ahead: str, most: int, kind: str) -> list[tuple[int, int, int]]:
    """(place, leave, chunks): a first chunk at this place or later (up to the
    next step) leaves its last chunk's end at ``leave`` in the next range,
    after so many chunks. A place behind the body has no step: it is passed
    on, less the body's length."""
    n = len(body)
    follow = next_starts(body, ahead, most, kind)
    place = np.arange(min(most, n))
    now, chunks = place.copy(), np.zeros(len(place), np.int64)
    while (inside := now < n).any():  # once for each chunk of the range
        chunks[inside] += 1
        now[inside] = follow[now[inside]]
    leave = now - n
    new = np.append(True, (leave[1:] != leave[:-1]) | (chunks[1:] != chunks[:-1])) if len(place) else np.zeros(0, bool)
    return list(zip(place[new].tolist(), leave[new].tolist(), chunks[new].tolist()))


def _steps(ranges: DataFrame, kind: str) -> DataFrame:
    """(rel_path, range_no, size, steps) of every range."""

    def run(batches):
        for batch in batches:
            rows = list(zip(*[batch.column(i).to_pylist() for i in range(5)]))
            steps = [[{"place": p, "leave": q, "chunks": c} for p, q, c in range_steps(body, ahead, most, kind)] for _, _, body, ahead, most in rows]
            yield pa.RecordBatch.from_pydict({
                "rel_path": [r[0] for r in rows], "range_no": pa.array([r[1] for r in rows], pa.int64()),
                "size": pa.array([len(r[2]) for r in rows], pa.int64()), "steps": pa.array(steps, STEPS)})

    schema = "rel_path string, range_no bigint, size bigint, steps array<struct<place: bigint, leave: bigint, chunks: bigint>>"
    return ranges.select("rel_path", "range_no", "body", "ahead", "max_chars").mapInArrow(run, schema)


def range_starts(steps: DataFrame) -> DataFrame:
    """(rel_path, range_no, place, first_no, n_chunks): where each range's
    first chunk starts, its number, and the file's chunks in all. A file's
    steps (a few numbers a range) are composed in order."""

    def compose(key, table):
        rows = sorted(zip(*[table.column(c).to_pylist() for c in ("range_no", "size", "steps")]), key=lambda r: r[0])
        place, number, out = 0, 0, []
        for no, size, mine in rows:
            out.append((no, place, number))
            if place >= size:
                place -= size
                continue
            at = mine[bisect_right(mine, place, key=lambda s: s["place"]) - 1]
            place, number = at["leave"], number + at["chunks"]
        columns = [pa.array(c, pa.int64()) for c in zip(*out)]
        path = pa.array([key[0].as_py()] * len(out), pa.string())
        return pa.Table.from_arrays([path, *columns, pa.array([number] * len(out), pa.int64())], ["rel_path", "range_no", "place", "first_no", "n_chunks"])

    return steps.groupBy("rel_path").applyInArrow(compose, "rel_path string, range_no bigint, place bigint, first_no bigint, n_chunks bigint")


def _cut(located: DataFrame, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for path, body, ahead, most, place, number, total in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                if place >= len(body):
                    continue
                text, follow, out = body + ahead, next_starts(body, ahead, most, kind), []
                while place < len(body):
                    end = int(follow[place])
                    out.append(text[place:end])
                    place = end
                no = pa.array(range(number, number + len(out)), pa.int64())
                yield pa.RecordBatch.from_pydict({"rel_path": [path] * len(out), "chunk_no": no, "n_chunks": pa.array([total] * len(out), pa.int64()), "chunk_text": out})

    cols = ["rel_path", "body", "ahead", "max_chars", "place", "first_no", "n_chunks"]
    return located.select(*cols).mapInArrow(run, "rel_path string, chunk_no bigint, n_chunks bigint, chunk_text string")


def chunk_ranges(ranges: DataFrame, kind: str = "word") -> DataFrame:
    """(rel_path, chunk_no, n_chunks, chunk_text) of texts given as ranges,
    the same chunks as chunking.chunk_words (kind "word") or chunk_lines
    (kind "line") cut from the whole text."""
    kept = stage_buckets(ranges, RANGE_KEY, "ranges")
    starts = range_starts(_steps(kept, kind))
    return _cut(kept.join(starts, RANGE_KEY), kind)
