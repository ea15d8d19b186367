"""The comment (annotation) job as DataFrame stages:

files -> line chunks -> requests -> [completion] -> attempts -> first answer
per chunk -> answers stitched per file -> annotated file (answers, a blank
line, then the original text).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.operators import chunking as C
from chunkwright.operators import completion as D4
from chunkwright.operators import requests as R
from chunkwright.operators import responses as D
from chunkwright.operators.filters import chunk_gate
from chunkwright.plans.rounds import Rounds, settled_outcomes
from chunkwright.session import configure, scratch_path, spread, stage


def comment_chunks(files: DataFrame, params: P.CommentParams = P.CommentParams(), carry=(), tokenizer=None,
                   keep_empty: bool = False) -> DataFrame:
    budgeted = C.with_budget(files, params.chunk_tokens, params.sample_chars, params.chunk_chars, tokenizer)
    return chunk_gate(C.chunk_lines(budgeted, "max_chars", carry, keep_empty), params.min_chunk_chars)


@dataclass
class AnnotateRun:
    files: DataFrame
    chunk_rows: DataFrame  # chunks plus one chunk_no NULL row per empty file
    requests: DataFrame
    attempts: DataFrame
    resolved: DataFrame  # per asked chunk: win, comment, failed
    params: P.CommentParams

    @property
    def chunks(self) -> DataFrame:
        return self.chunk_rows.where(F.col("chunk_no").isNotNull())

    @property
    def failed(self) -> DataFrame:
        """Files with a chunk that failed, or an asked chunk with no try at
        all (so no file is stitched with a part missing)."""
        key = ["rel_path", "chunk_no"]
        failed = self.resolved.where(F.col("failed")).select(*key, F.lit("call_error").alias("reason"))
        unanswered = (
            self.chunks.where(~F.col("gated")).select(*key)
            .join(self.resolved.select(*key), key, "left_anti")
            .select(*key, F.lit("no_answer").alias("reason"))
        )
        return (
            failed.unionByName(unanswered)
            .groupBy("rel_path")
            .agg(
                F.count(F.lit(1)).cast("bigint").alias("failed_chunks"),
                F.min("chunk_no").alias("first_failed_chunk"),
                F.min("reason").alias("reason"),
            )
        )

    @property
    def stitched(self) -> DataFrame:
        """(rel_path, comments, text): answers joined with '\n' in chunk order
        (a gated chunk answers itself), and the original text rebuilt from its
        chunks. Chunk rows and answers meet in one aggregation per file, which
        also sees whether every asked chunk was answered, so the text is
        shuffled once and joined with nothing."""
        null = F.lit(None).cast("string")
        gated = F.coalesce("gated", F.lit(False))
        rows = self.chunk_rows.where(F.col("n_chunks").isNotNull()).select(
            "rel_path", "chunk_no", F.coalesce("chunk_text", F.lit("")).alias("part"),
            F.when(F.col("chunk_no").isNull(), F.lit("")).when(gated, F.col("chunk_text")).alias("comment"),
            (F.col("chunk_no").isNotNull() & ~gated).cast("int").alias("asked"))
        answered = self.resolved.where(~F.col("failed")).select("rel_path", "chunk_no", null.alias("part"), "comment", F.lit(-1).alias("asked"))

        def in_order(col):
            return F.transform(F.array_sort(F.collect_list(F.when(F.col(col).isNotNull(), F.struct("chunk_no", F.col(col).alias("t"))))), lambda x: x["t"])

        g = rows.unionByName(answered).groupBy("rel_path").agg(
            F.sum("asked").alias("open"), in_order("comment").alias("comments"), in_order("part").alias("parts"))
        return g.where(F.col("open") == 0).select(
            "rel_path", F.array_join("comments", P.COMMENT_JOIN).alias("comments"), F.array_join("parts", "").alias("text"))

    @property
    def artifacts(self) -> DataFrame:
        """(rel_path, out_path, body): the annotated file at the same path."""
        s = self.stitched
        return s.select("rel_path", F.col("rel_path").alias("out_path"), F.concat("comments", F.lit(P.ANNOTATION_SEPARATOR), "text").alias("body"))


def annotate(
    files: DataFrame,
    complete: D4.CompleteFn | None = None,
    attempts: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    params: P.CommentParams = P.CommentParams(),
    carry=(),
    tokenizer=None,
    attempts_path: str | None = None,
    partitions: int | None = None,
    materialize: bool = True,
    **publish,
) -> AnnotateRun:
    spark = configure(files.sparkSession)
    chunk_rows = comment_chunks(spread(files), params, carry, tokenizer, keep_empty=True)
    if materialize:
        chunk_rows = stage(chunk_rows, "comment-chunks")
    chunks = chunk_rows.where(F.col("chunk_no").isNotNull())
    requests = R.comment_requests(chunks, params, carry)
    if attempts is not None:
        att = attempts(chunks.where(~F.col("gated"))) if callable(attempts) else attempts
        if "request_id" in att.columns:
            att = att.join(requests.select("request_id"), "request_id", "left_semi")
        resolved = D.resolve_comments(att, params.max_attempts)
    else:
        path = attempts_path or scratch_path(spark, "comment-attempts")
        asked = chunks.where(~F.col("gated")).select("rel_path", "chunk_no", "chunk_text", *carry)
        rounds = Rounds(
            lambda rows: R.comment_requests(rows, params, carry),
            lambda answers: D.comment_round(answers, params.max_attempts, params.response_tokens),
            params.max_attempts, params.response_tokens,
        )
        outcomes = settled_outcomes(asked, rounds, complete or D4.offline_stub, path, partitions, **publish)
        att, resolved = D4.answers_to(requests, path), D.resolved_comments(outcomes)
    if materialize:
        resolved = stage(resolved, "comment-resolved")
    return AnnotateRun(files, chunk_rows, requests, att, resolved, params)
