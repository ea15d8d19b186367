"""Samples, token ratio, chunk budget and the three chunkers (section C).

Generators use the *_outer form followed by a null filter: for a plain
explode Spark infers `size(array) > 0` and pushes it below the projection,
which would evaluate the chunking regex (and the token count inside the
chunk size) a second time per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.functions.text import (
    chars_per_token,
    chunk_chars,
    head_sample,
    line_chunk_pattern,
    pretokens,
    token_count,
    word_chunk_pattern,
)
from chunkwright.functions.tokens import token_windows


def with_budget(
    files: DataFrame,
    budget_tokens: int,
    sample_chars: int,
    fixed_chars: int | None = None,
    tokenizer=None,
) -> DataFrame:
    """Add n_tokens, chars_per_token and max_chars (characters per chunk).

    The ratio is measured on the head sample of each file. `tokenizer` may be
    a pandas UDF returning a token count per text (H1); by default the
    pre-token count is used, which runs lower than a byte-pair count.
    """
    if fixed_chars is not None:
        return files.withColumn("max_chars", F.lit(int(fixed_chars)).cast("bigint"))
    sample = head_sample("text", sample_chars)
    n_tok = tokenizer(sample).cast("bigint") if tokenizer is not None else token_count(sample)
    return (
        files.withColumn("n_tokens", n_tok)
        .withColumn("chars_per_token", chars_per_token(sample, F.col("n_tokens")))
        .withColumn("max_chars", chunk_chars(budget_tokens, F.col("chars_per_token")))
    )


def _explode_chunks(files: DataFrame, pattern, carry, keep_empty: bool = False) -> DataFrame:
    """One row per chunk, with chunk_no from 0 and the file's n_chunks (known
    before the explode, so no later count over the file is needed). An empty
    text gives no chunk row (with keep_empty, one row with chunk_no NULL and
    n_chunks 0, so the file is still known downstream; a NULL text, i.e. a
    file that did not decode, gives such a row with n_chunks NULL)."""
    cols = ["rel_path", *carry]
    if keep_empty and "reason" in files.columns and "reason" not in cols:
        cols.append("reason")  # why a file was not read
    return (
        files.select(*cols, F.regexp_extract_all(F.col("text"), pattern, 0).alias("_parts"))
        .select(
            *cols,
            F.when(F.col("_parts").isNotNull(), F.size("_parts")).cast("bigint").alias("n_chunks"),
            F.posexplode_outer("_parts").alias("chunk_no", "chunk_text"),
        )
        .where(F.col("chunk_no").isNotNull() | F.lit(keep_empty))
        .withColumn("chunk_no", F.col("chunk_no").cast("bigint"))
    )


def chunk_words(files: DataFrame, max_chars="max_chars", carry=(), keep_empty: bool = False) -> DataFrame:
    """Word-boundary chunks; `max_chars` is an int or a column name."""
    pattern = word_chunk_pattern(max_chars if isinstance(max_chars, int) else F.col(max_chars))
    return _explode_chunks(files, pattern, carry, keep_empty)


def chunk_lines(files: DataFrame, max_chars="max_chars", carry=(), keep_empty: bool = False) -> DataFrame:
    """Line-boundary chunks; `max_chars` is an int or a column name."""
    pattern = line_chunk_pattern(max_chars if isinstance(max_chars, int) else F.col(max_chars))
    return _explode_chunks(files, pattern, carry, keep_empty)


def chunk_tokens(files: DataFrame, n: int, carry=(), tokenizer=None) -> DataFrame:
    """Windows of n pre-tokens, each rejoined to text; with a tokenizer (a
    function that loads (encode, decode), see functions.tokens), windows of n
    of its tokens."""
    if tokenizer is not None:
        return token_windows(files, n, tokenizer, carry)
    t = pretokens(F.col("text"))
    # windows are numbered by an outer generator: a filter on the array's size
    # would be pushed below it and split every text a second time
    last = F.floor((F.size("_t") - 1) / n).cast("int")
    return (
        files.select("rel_path", *carry, t.alias("_t"))
        .select(
            "rel_path",
            *carry,
            "_t",
            (last + 1).cast("bigint").alias("n_chunks"),
            F.explode_outer(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("chunk_no"),
        )
        .where(F.col("chunk_no").isNotNull())
        .select(
            "rel_path",
            *carry,
            "n_chunks",
            F.col("chunk_no").cast("bigint").alias("chunk_no"),
            F.array_join(F.slice("_t", F.col("chunk_no") * n + 1, F.lit(n)), "").alias("chunk_text"),
        )
    )


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Per file: chunk count, longest chunk and total characters."""
    return chunks.groupBy("rel_path").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_chunks"),
        F.max(F.length("chunk_text")).cast("bigint").alias("max_chunk_chars"),
        F.sum(F.length("chunk_text")).cast("bigint").alias("total_chars"),
    )


__all__ = ["with_budget", "chunk_words", "chunk_lines", "chunk_tokens", "chunk_stats"]
