"""Operator 5 [native]: exact de-duplication with a two-pass Bloom filter.

Pass one counts how many rows hit each cell of a hash table of bits and keeps
the cells hit twice or more, as 64-bit words: a Bloom filter of possibly
repeated hashes. Pass two tests every row; only rows whose cells were all hit
twice are shuffled and grouped by the SHA-256 of their normalised text, all
others pass straight through. A false positive is only grouped for nothing.

The filter's size follows the row count (16 cells a row) up to ``max_bits``
(2**27 cells: at most 2**21 words, 16 MB of bits), which bounds the broadcast;
beyond that more rows take the shuffle and the result is the same.

Edge cases: null and empty texts are equal to each other; among rows equal in
length and id one stays (repeated rows count in group_size); a null id loses
against any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import SPACE, fresh, join_groups, stage, text_or_empty

MAX_BITS = 27


def normalised_sha(text: str = "text") -> Column:
    return F.sha2(F.regexp_replace(text_or_empty(text), f"[{SPACE}]+", ""), 256)


def _cells(key: str, bits: int) -> list[Column]:
    size = F.lit(1 << bits)
    return [F.pmod(F.xxhash64(F.lit(i), F.col(key)), size) for i in (1, 2)]


def repeat_filter(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """(word, bits): the 64-cell words of the filter that have a repeated cell."""
    hit = rows.select(F.explode(F.array(*_cells(key, bits))).alias("cell"))
    twice = hit.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("bits"))


def maybe_repeated(rows: DataFrame, key: str, filt: DataFrame, bits: int, flag: str) -> DataFrame:
    """rows with a boolean column: may the key occur more than once?"""
    names = rows.columns
    out, tests = rows, []
    for i, cell in enumerate(_cells(key, bits)):
        c, w, b = fresh(out, f"_cell{i}", f"_word{i}", f"_bits{i}")
        f = filt.select(F.col("word").alias(w), F.col("bits").alias(b))
        out = out.withColumn(c, cell)
        out = out.join(F.broadcast(f), F.shiftright(F.col(c), 6) == F.col(w), "left")
        tests.append(F.expr(f"coalesce(shiftright({b}, cast({c} & 63 as int)) & 1, 0) = 1"))
    return out.select(*names, (tests[0] & tests[1]).alias(flag))


def filter_bits(n: int, max_bits: int = MAX_BITS) -> int:
    return min(max_bits, max(10, math.ceil(math.log2(16 * max(n, 1)))))


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), normalised_sha(text).alias("text_sha256"),
        F.char_length(text_or_empty(text)).alias("n_chars"), F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(rows, "digests")
    n = rows.count()
    bits = filter_bits(n, max_bits)
    filt = stage(repeat_filter(rows, "text_sha256", bits), "filter")
    marked = maybe_repeated(rows, "text_sha256", filt, bits, "maybe")
    single = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    some = stage(marked.where("maybe").drop("maybe"), "candidates")
    # ~x falls as x rises and cannot overflow; a null id sorts below all others
    best = F.max(F.struct("n_chars", F.coalesce(F.bitwise_not("doc_id"), F.lit(-(1 << 63))).alias("low"), F.bitwise_not("row").alias("first"), "doc_id"))
    groups = some.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    groups = stage(groups.select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"), F.bitwise_not("best.first").alias("keep_row")), "groups")
    found = join_groups(some, groups, ["text_sha256"], "group_size", n)
    return single.unionByName(found.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """docs without the copies: whole rows, one of each group of equal texts.
    Rows the filter clears are passed on; the others meet by hash, reduced to
    the best row of each group before the shuffle."""
    sha, n_chars, flag, best = fresh(docs, "_sha", "_n_chars", "_maybe", "_best")
    keyed = docs.withColumn(sha, normalised_sha(text))
    rows = stage(keyed.select(sha), "digests")
    bits = filter_bits(rows.count(), max_bits)
    filt = stage(repeat_filter(rows, sha, bits), "filter")
    marked = maybe_repeated(keyed, sha, filt, bits, flag)
    low = F.coalesce(F.bitwise_not(F.col(id_col)), F.lit(-(1 << 63)))
    order = F.struct(F.char_length(text_or_empty(text)), low, F.xxhash64(*[F.col(c) for c in docs.columns]))
    one = marked.where(flag).groupBy(sha).agg(F.max_by(F.struct(*docs.columns), order).alias(best))
    return marked.where(~F.col(flag)).select(*docs.columns).unionByName(one.select(f"{best}.*"))


ORACLE = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS k FROM d)
SELECT doc_id, max(CASE WHEN k = 1 THEN doc_id END) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size, k = 1 AS kept, text_sha256 FROM r
"""
