"""A bit map of hash cells hit twice or more, over all batches of a table.

Every task sends the sorted cells of its batches, cut into slices and coded as
differences (one to two bytes a cell), to the tasks that own the slices; those
keep two bit maps for each slice (hit, hit again) and never a list of cells.
The map has at most 2**MAX_BITS bits, which bounds what the driver collects
and broadcasts; with more hashes than that it lets more through, and what is
built on it stays exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MAX_BITS, SLICE_BITS = 30, 22


def map_bits(hashes: int) -> int:
    """Bits for about this many hashes: twice as many cells, within the bound."""
    return min(MAX_BITS, max(16, math.ceil(math.log2(2 * max(hashes, 1)))))


def cells_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def is_repeated(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    c = cells_of(hashes, bits)
    return (bitmap[c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _coded(cells: np.ndarray) -> bytes:
    gaps = np.diff(cells, prepend=np.uint64(0))
    return (b"\2" + gaps.astype("<u2").tobytes()) if gaps.max() < 65536 else (b"\4" + gaps.astype("<u4").tobytes())


def _decoded(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, "<u2" if blob[0] == 2 else "<u4", offset=1), dtype=np.int64)


def repeat_bitmap(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """hashes(batch) gives arrays of 64-bit hashes, one entry for each
    occurrence that counts. Returns the map as bytes."""
    inner = min(bits, SLICE_BITS)
    slices = 1 << (bits - inner)

    def send(batches):
        for batch in batches:
            for found in hashes(batch):
                cells = np.sort(cells_of(found, bits))
                if not len(cells):
                    continue
                again = np.zeros(len(cells), bool)
                again[1:] = cells[1:] == cells[:-1]
                numbers, kinds, blobs = [], [], []
                for kind, some in ((1, cells[~again]), (2, np.unique(cells[again]))):
                    cuts = np.searchsorted(some, np.arange(slices + 1, dtype=np.uint64) << np.uint64(inner))
                    for s in np.flatnonzero(np.diff(cuts)):
                        numbers.append(int(s))
                        kinds.append(kind)
                        blobs.append(_coded(some[cuts[s] : cuts[s + 1]] - np.uint64(int(s) << inner)))
                yield pa.RecordBatch.from_pydict({"slice": pa.array(numbers, pa.int32()), "kind": pa.array(kinds, pa.int32()), "cells": pa.array(blobs, pa.binary())})

    def gather(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, kind, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if s not in once:
                    once[s], twice[s] = np.zeros(1 << inner, bool), np.zeros(1 << inner, bool)
                at = _decoded(blob)
                if kind == 1:
                    twice[s][at] |= once[s][at]
                    once[s][at] = True
                else:
                    twice[s][at] = True
        for s in sorted(twice):
            packed = np.packbits(twice[s], bitorder="little").tobytes()
            yield pa.RecordBatch.from_pydict({"slice": pa.array([s], pa.int32()), "bits": pa.array([packed], pa.binary())})

    sent = rows.mapInArrow(send, "slice int, kind int, cells binary")
    parts = sent.repartition(min(slices, 4 * rows.sparkSession.sparkContext.defaultParallelism), "slice").mapInArrow(gather, "slice int, bits binary").toArrow()
    out = np.zeros((slices, (1 << inner) // 8), np.uint8)
    for s, packed in zip(parts.column("slice").to_pylist(), parts.column("bits").to_pylist()):
        out[s] = np.frombuffer(packed, np.uint8)
    return out.reshape(-1)
