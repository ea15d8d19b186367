"""Operator 10 [native]: sharding by a Feistel permutation.

Rows get global numbers in id order; a keyed Feistel network over the pair
(number div b, number mod b) permutes [0, a*b), and cycle walking (apply again
while the result is not below the row count) makes it a permutation of the
rows. Position p is slot p div shards of shard p mod shards, so counts differ
by one at most, and shard and slot of a row number can be computed alone
(law ``rows``).

a = ceil(sqrt(n)) and b = ceil(n / a), so fewer than a numbers lie outside the
range, few rows walk at all, and a walk takes at most that many steps.

Edge cases: a null text has no bytes (size 1) and CRC 0; null ids come first;
ties on the id are ordered by size, CRC and a text hash, and rows equal in all
of these are interchangeable; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import numbered, stage, text_or_empty

SHARDS = 16
KEYS = (523066233, 776759944, 1012561046, 1265207205, 1517871555, 1769934622)  # one for each round
MASK = (1 << 31) - 1
SHORT_WALK = 64


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _mixed(v: str, key: str) -> str:
    """A 31-bit mix of v; every product stays below 2**62."""
    last = _let(f"((w * 1812433253L + 1L) & {MASK}L)", "y", "(y ^ shiftright(y, 13))")
    body = _let(f"((t * 1103515245L + 12345L) & {MASK}L)", "u", _let("(u ^ shiftright(u, 15))", "w", last))
    return _let(f"(({v} & {MASK}L) ^ {key})", "t", body)


def permuted_sql(x: str, a: int, b: int, keys=KEYS) -> str:
    """One pass of the network over a number x in [0, a*b)."""
    rounds = ", ".join(f"named_struct('k', {k}L, 'side', {i % 2})" for i, k in enumerate(keys))
    return (
        f"aggregate(array({rounds}), named_struct('l', {x} div {b}L, 'r', {x} % {b}L), (s, q) -> "
        f"if(q.side = 0, named_struct('l', (s.l + {_mixed('s.r', 'q.k')}) % {a}L, 'r', s.r), "
        f"named_struct('l', s.l, 'r', (s.r + {_mixed('s.l', 'q.k')}) % {b}L)), s -> s.l * {b}L + s.r)"
    )


def grid(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def position(number: str, n: int, keys=KEYS) -> Column:
    """Where row ``number`` of n rows comes in the shuffled order."""
    a, b = grid(n)
    outside = a * b - n

    def walk(x: str, steps: int) -> str:
        return f"if({x} < {n}L, {x}, aggregate(sequence(1, {steps}), {x}, (v, i) -> if(v < {n}L, v, {permuted_sql('v', a, b, keys)})))"

    out = permuted_sql(number, a, b, keys)
    if outside:
        out = _let(out, "x1", walk("x1", min(outside, SHORT_WALK)))
    if outside > SHORT_WALK:
        out = _let(out, "x2", walk("x2", outside))
    return F.expr(out)


def feistel_shards(rows: DataFrame, order: list, shards: int = SHARDS, keys=KEYS) -> DataFrame:
    """rows with number, shard and slot. Only rows' columns are sorted."""
    ranked = stage(numbered(rows, order, "number"), "numbered")
    n = ranked.count()
    placed = ranked.withColumn("position", position("number", n, keys))
    return placed.withColumns({"shard": F.expr(f"cast(position % {shards} as int)"), "slot": F.expr(f"position div {shards}L")})


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot,
    grown_shard. The text itself is reduced to size and hashes before the sort."""
    t = text_or_empty(text)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(F.encode(t, "UTF-8")).cast("long").alias("text_crc32"), F.xxhash64(t).alias("tie"), F.monotonically_increasing_id().alias("row"),
    )
    # the input's row number only parts rows equal in all else, so that one repeated row fills no single partition
    out = feistel_shards(rows, ["doc_id", "size", "text_crc32", "tie", "row"], shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
