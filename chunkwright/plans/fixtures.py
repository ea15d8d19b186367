"""Deterministic stand-in answers derived from the chunk table.

They replace the model in tests and registered queries: every answer is a
function of (doc_id, chunk_no, attempt, chunk_text, source), so Spark and a
second SQL engine build the same tries. The eight summary cases cover leading
prose, unknown keys, wrong types, truncation, no JSON, '{}', None-like values
and nested items. Answers are made of the whole chunk, and between them fill
every text and map section.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_hint(chunk_text="chunk_text"):
    """Letters, spaces and commas of the chunk, trimmed."""
    return F.trim(F.regexp_replace(F.col(chunk_text), r"[^A-Za-z ,]", ""))


def _tries(chunks: DataFrame, n: int) -> DataFrame:
    """Each chunk n times, with its words, found once, before the tries."""
    return chunks.withColumn("w", word_hint()).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("attempt")).withColumn(
        "attempt", F.col("attempt").cast("bigint")
    )


def summary_attempts(chunks: DataFrame, n: int = 5, with_errors: bool = False) -> DataFrame:
    """Tries 1..n per chunk. chunks: (rel_path, chunk_no, doc_id, source, chunk_text)."""
    t = _tries(chunks, n)
    d, c, a, s, w = (F.col(x) for x in ("doc_id", "chunk_no", "attempt", "source", "w"))
    n = F.length("chunk_text")
    case = (d + c + 3 * a) % 8

    def answer(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    resp = (
        F.when(case == 0, answer(
            'Here you go: {"Overall Summary": " ', w, ' ", "Data Inputs": "', s, '", "Module/Library Name": "m', c % 4, ", ", s,
            '", "Interfaces/APIs": "None", "Classes": {"K', c % 3, '": "', s, '", "Kx": "N/A"}, '
            '"Configuration/Environment Variables": {"E', c % 5, '": " ', n, ' chars "}} '))
        .when(case == 1, answer(
            '{"Overall Summary": "', w, '", "Data Inputs": "n/a", "Data Structures": "list of ', n, '", "Error Handling/Logging": "', w,
            '", "Functions/Methods": {"f', c % 2, '": "', s, " c", c, '"}}'))
        .when(case == 2, F.lit('{"Overall Summary": "u", "Bogus": "x"}'))
        .when(case == 3, F.lit('{"Overall Summary": ["l"]} hope this helps'))
        .when(case == 4, F.lit('{"Overall Summary": "trunc'))
        .when(case == 5, F.lit("Sorry, I cannot do that."))
        .when(case == 6, F.lit("{}"))
        .otherwise(answer(
            '{"Variables": {"v": "1"}, "ETL Processes": "", "Data Outputs": "', s, ", ", s, '", "Interfaces/APIs": "call ', c, ", ", w,
            '", "Classes": {"K0": {"Description": "', s, '"}}, "Configuration/Environment Variables": "see ', s, '"}'))
    )
    out = t.withColumn("response", resp)
    err = F.when((d + a) % 17 == 0, F.lit("timeout")) if with_errors else F.lit(None).cast("string")
    return out.withColumn("error", err).select("rel_path", "chunk_no", "doc_id", "attempt", "response", "error")


def comment_attempts(chunks: DataFrame, n: int = 3) -> DataFrame:
    """Comment-mode tries: a documented stand-in for the chunk, some call
    errors and some missing answers."""
    t = _tries(chunks, n)
    d, c, a, s, w = (F.col(x) for x in ("doc_id", "chunk_no", "attempt", "source", "w"))
    resp = F.concat(
        F.lit('"""'), w, F.lit('"""\n'), F.lit("def part_"), c.cast("string"), F.lit("():\n    return '"), s, F.lit("'\n")
    )
    error = F.when((d + c + a) % 5 == 0, F.lit("rate limit"))
    missing = error.isNull() & ((d + 2 * c + a) % 23 == 0)
    return t.select(
        "rel_path", "chunk_no", "doc_id", "attempt",
        F.when(error.isNull() & ~missing, resp).alias("response"),
        error.alias("error"),
    )
