"""Answer handling: extract, decode, validate, retry budget, resolve (D5-D15)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.functions.jsontext import (
    extract_json,
    json_incomplete,
    object_keys,
    response_status,
    strict_json_map,
    value_kinds,
)
from chunkwright.functions.text import py_strip

CHUNK_KEY = ["rel_path", "chunk_no"]

# Record for a chunk too small to ask about: all twelve sections, empty.
GATED_RECORD = json.dumps({k: ({} if k in P.MAP_SECTIONS else "") for k in P.SECTIONS})
# Record for a chunk with no valid answer within the allowed tries.
EXHAUSTED_RECORD = json.dumps({k: ({} if k in P.MAP_SECTIONS else "") for k in P.MERGED_SECTIONS})


def _error_col(df: DataFrame):
    return F.col("error") if "error" in df.columns else F.lit(None).cast("string")


def parse_attempts(attempts: DataFrame) -> DataFrame:
    """Add extracted, json_text (when it decodes), status, n_keys,
    object_keys (of the decoded record) and incomplete. The answer is parsed
    once; what later steps ask of it is taken from that parse.

    status is 'error' for a failed call or a missing answer, else one of
    valid / empty / bad_keys / bad_types."""
    resp = F.col("response")
    return (
        attempts.withColumn("extracted", extract_json(resp))
        .withColumn("_k", value_kinds(strict_json_map(F.col("extracted"))))
        .withColumn(
            "status",
            F.when(_error_col(attempts).isNotNull() | resp.isNull(), F.lit("error")).otherwise(response_status("_k")),
        )
        .withColumn("json_text", F.when(F.col("_k").isNotNull(), F.col("extracted")))
        .withColumn("n_keys", F.size("_k").cast("bigint"))
        .withColumn("object_keys", object_keys("_k"))
        .withColumn("incomplete", json_incomplete(resp))
        .drop("_k")
    )


def growth_flag():
    """The answer decoded to a non-empty record, failed validation and looks
    cut off: the next try gets a larger response budget."""
    return (F.col("status").isin("bad_keys", "bad_types") & F.col("incomplete")).cast("int")


def attempt_budget(parsed: DataFrame, base: int = P.RESPONSE_TOKENS, step: int = P.BUDGET_STEP) -> DataFrame:
    """max_tokens each try was asked with: base + step per earlier growth."""
    w = Window.partitionBy(*CHUNK_KEY).orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    return parsed.withColumn(
        "max_tokens", (F.lit(base) + F.lit(step) * F.coalesce(F.sum(growth_flag()).over(w), F.lit(0))).cast("bigint")
    )


def _within(max_attempts: int):
    return F.col("attempt") <= max_attempts


def _outcome_aggregates(max_attempts: int) -> list:
    """First valid try with its JSON, and first error. The valid tries of a
    chunk are at most max_attempts, so they are collected (a hash-based object
    aggregate) and the earliest is taken, instead of a string min_by, which
    Spark can only aggregate by sorting."""
    within = _within(max_attempts)
    won = F.struct(F.col("attempt").cast("bigint").alias("a"), F.col("json_text").alias("j"), F.col("object_keys").alias("o"))
    return [
        F.array_min(F.collect_list(F.when(within & (F.col("status") == "valid"), won))).alias("_w"),
        F.min(F.when(within & (F.col("status") == "error"), F.col("attempt"))).cast("bigint").alias("first_error"),
    ]


def _won() -> list:
    return [F.col("_w.a").alias("win"), F.col("_w.j").alias("json_text"), F.col("_w.o").alias("object_keys")]


def chunk_outcomes(parsed: DataFrame, max_attempts: int = P.SUMMARY_ATTEMPTS) -> DataFrame:
    """Per chunk: tries, first valid try, its JSON and object keys, first
    error, growth."""
    g = parsed.groupBy(*CHUNK_KEY).agg(
        F.count(F.when(_within(max_attempts), 1)).cast("bigint").alias("tries"),
        *_outcome_aggregates(max_attempts),
        F.sum(F.when(_within(max_attempts), growth_flag()).otherwise(0)).cast("bigint").alias("growth"),
    )
    return g.select(*CHUNK_KEY, "tries", *_won(), "first_error", "growth")


def round_outcomes(attempts: DataFrame, max_attempts: int = P.SUMMARY_ATTEMPTS, base: int = P.RESPONSE_TOKENS,
                   step: int = P.BUDGET_STEP) -> DataFrame:
    """chunk_outcomes from some of a chunk's answers, the latest included:
    an attempt row holds the number of tries up to it and the budget grown up
    to it, so a round's answers need no earlier ones. Also ``budget``
    (max_tokens of a next try) and ``settled`` (valid, failed, or no try
    left). Repeated rows change nothing."""
    within = _within(max_attempts)
    g = parse_attempts(attempts).groupBy(*CHUNK_KEY).agg(
        F.max(F.when(within, F.col("attempt"))).cast("bigint").alias("tries"),
        *_outcome_aggregates(max_attempts),
        F.max(F.when(within, F.col("max_tokens") + step * growth_flag())).cast("int").alias("budget"),
    )
    done = F.col("win").isNotNull() | F.col("first_error").isNotNull() | (F.col("tries") >= max_attempts)
    return g.select(*CHUNK_KEY, "tries", *_won(), "first_error", "budget").select(
        *CHUNK_KEY, "tries", "win", "json_text", "object_keys", "first_error",
        F.expr(f"(budget - {int(base)}) div {int(step)}").cast("bigint").alias("growth"), "budget", done.alias("settled"),
    )


def resolve_attempts(parsed: DataFrame, max_attempts: int = P.SUMMARY_ATTEMPTS) -> DataFrame:
    """The first valid answer within max_attempts wins (NULL win: none)."""
    return chunk_outcomes(parsed, max_attempts).select(*CHUNK_KEY, "tries", "win", "json_text")


def chunk_failed():
    """Summary mode: a call error before the first valid answer is fatal."""
    return F.col("first_error").isNotNull() & (
        F.col("win").isNull() | (F.col("first_error") < F.col("win"))
    )


def failed_files(parsed: DataFrame, max_attempts: int = P.SUMMARY_ATTEMPTS) -> DataFrame:
    """Files lost to a call error, with the number of chunks that hit one."""
    return failed_from_outcomes(chunk_outcomes(parsed, max_attempts))


def failed_from_outcomes(outcomes: DataFrame) -> DataFrame:
    return failures(outcomes.where(chunk_failed()).withColumn("fate", F.lit("call_error")))


def failures(rows: DataFrame) -> DataFrame:
    """Files with a chunk that has a fate, with the number of such chunks."""
    return (
        rows.where(F.col("fate").isNotNull())
        .groupBy("rel_path", F.col("fate").alias("reason"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("failed_chunks"), F.min("chunk_no").alias("first_failed_chunk"))
        .select("rel_path", "failed_chunks", "first_failed_chunk", "reason")
    )


def chunk_records(chunk_rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The chunk table with what became of each chunk, in one join by chunk:
    origin (model / gated / exhausted), its record (json_text, object_keys),
    win, tried, and fate: 'call_error' or 'no_answer' (asked, never tried)
    where it loses the file. Rows without a chunk (empty or undecoded files)
    stay, with no record."""
    carry = [c for c in ("n_chunks", "reason") if c in chunk_rows.columns]
    rows = chunk_rows.select(*CHUNK_KEY, "gated", *carry)
    o = outcomes.select(*CHUNK_KEY, "tries", "win", "json_text", "object_keys", "first_error")
    j = rows.join(o, CHUNK_KEY, "left")
    chunk, gated, won = F.col("chunk_no").isNotNull(), F.coalesce("gated", F.lit(False)), F.col("win").isNotNull()
    maps = F.array(*[F.lit(k) for k in P.MAP_SECTIONS])
    return j.select(
        *CHUNK_KEY, *carry,
        F.when(chunk, F.when(gated, "gated").when(won, "model").otherwise("exhausted")).alias("origin"),
        F.when(chunk, F.when(gated, F.lit(GATED_RECORD)).when(won, F.col("json_text")).otherwise(F.lit(EXHAUSTED_RECORD))).alias("json_text"),
        F.when(chunk, F.when(won & ~gated, F.col("object_keys")).otherwise(maps)).alias("object_keys"),
        "win", F.col("tries").isNotNull().alias("tried"),
        F.when(chunk_failed(), "call_error").when(chunk & ~gated & F.col("tries").isNull(), "no_answer").alias("fate"),
    )


def resolved_records(chunks: DataFrame, parsed: DataFrame, max_attempts: int = P.SUMMARY_ATTEMPTS) -> DataFrame:
    """One record per chunk of every file not lost to an error:
    (rel_path, chunk_no, origin, json_text), origin in model/gated/exhausted."""
    rows = chunk_records(chunks, chunk_outcomes(parsed, max_attempts))
    return without_failed(rows, rows.where(F.col("fate") == "call_error"))


def without_failed(rows: DataFrame, failed: DataFrame) -> DataFrame:
    return rows.join(failed.select("rel_path"), "rel_path", "left_anti")


def pending_requests(
    requests: DataFrame,
    parsed: DataFrame,
    max_attempts: int = P.SUMMARY_ATTEMPTS,
    base: int = P.RESPONSE_TOKENS,
    step: int = P.BUDGET_STEP,
) -> DataFrame:
    """Requests that still need a try: no valid answer, no fatal error, tries
    left. Gives the next attempt number and its response budget."""
    out = chunk_outcomes(parsed, max_attempts)
    j = requests.join(out.select(*CHUNK_KEY, "tries", "win", "first_error", "growth"), CHUNK_KEY, "left")
    tries = F.coalesce(F.col("tries"), F.lit(0))
    keep = F.col("win").isNull() & F.col("first_error").isNull() & (tries < max_attempts)
    return j.where(keep).select(
        *[c for c in requests.columns if c != "max_tokens"],
        (tries + 1).cast("bigint").alias("attempt"),
        (F.lit(base) + F.lit(step) * F.coalesce(F.col("growth"), F.lit(0))).cast("int").alias("max_tokens"),
    )


def comment_outcomes(attempts: DataFrame, max_attempts: int = P.COMMENT_ATTEMPTS) -> DataFrame:
    """Per chunk in comment mode: tries, first answered try and its text,
    first try whose answer was missing (no error, no text). An attempt's
    number is the count of tries up to it, so some of a chunk's attempts, the
    latest included, are enough."""
    err = _error_col(attempts)
    within = _within(max_attempts)
    ok = within & err.isNull() & F.col("response").isNotNull()
    missing = within & err.isNull() & F.col("response").isNull()
    g = attempts.groupBy(*CHUNK_KEY).agg(
        F.max(F.when(within, F.col("attempt"))).cast("bigint").alias("tries"),
        # at most max_attempts answers per chunk: a bounded, hash-based collect
        F.array_min(F.collect_list(F.when(ok, F.struct(F.col("attempt").cast("bigint").alias("a"), F.col("response").alias("r"))))).alias("_w"),
        F.min(F.when(missing, F.col("attempt"))).cast("bigint").alias("first_missing"),
    )
    return g.select(*CHUNK_KEY, "tries", F.col("_w.a").alias("first_ok"), F.col("_w.r").alias("response"), "first_missing")


def comment_round(attempts: DataFrame, max_attempts: int, budget: int) -> DataFrame:
    """comment_outcomes of a round, with ``budget`` (it never grows) and
    ``settled`` (answered, missing, or no try left)."""
    done = F.col("first_ok").isNotNull() | F.col("first_missing").isNotNull() | (F.col("tries") >= max_attempts)
    return comment_outcomes(attempts, max_attempts).withColumn("budget", F.lit(budget)).withColumn("settled", done)


def comment_failed():
    return F.col("first_ok").isNull() | (
        F.col("first_missing").isNotNull() & (F.col("first_missing") < F.col("first_ok"))
    )


def resolve_comments(attempts: DataFrame, max_attempts: int = P.COMMENT_ATTEMPTS) -> DataFrame:
    """Comment mode: the first answer wins with no validation. A failed call
    uses up a try; a missing answer fails the chunk at once."""
    return resolved_comments(comment_outcomes(attempts, max_attempts))


def resolved_comments(outcomes: DataFrame) -> DataFrame:
    failed = comment_failed()
    return outcomes.select(
        *CHUNK_KEY,
        F.when(~failed, F.col("first_ok")).alias("win"),
        F.when(~failed, py_strip(F.col("response"))).alias("comment"),
        failed.alias("failed"),
    )
