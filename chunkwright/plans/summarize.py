"""The summary job as DataFrame stages:

files -> chunks -> requests -> [completion, materialised] -> attempts ->
parsed -> records -> long summaries -> wide record, artifacts, audit.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.functions.jsonfmt import json_indent2
from chunkwright.functions.paths import replace_extension
from chunkwright.operators import chunking as C
from chunkwright.operators import completion as D4
from chunkwright.operators import merge as E
from chunkwright.operators import requests as R
from chunkwright.operators import responses as D
from chunkwright.operators.filters import chunk_gate
from chunkwright.plans.rounds import Rounds, settled_outcomes
from chunkwright.session import configure, scratch_path, spread, stage


def summary_chunks(files: DataFrame, params: P.SummaryParams = P.SummaryParams(), carry=(), tokenizer=None,
                   keep_empty: bool = False) -> DataFrame:
    """Word-boundary chunks with the gate flag and the file's chunk count."""
    budgeted = C.with_budget(files, params.chunk_tokens, params.sample_chars, params.chunk_chars, tokenizer)
    return chunk_gate(C.chunk_words(budgeted, "max_chars", carry, keep_empty), params.min_chunk_chars)


class SummaryRun:
    """The stages of one summary job. Later stages are built on first use;
    with materialize, the per-chunk records are written once then."""

    def __init__(self, files, chunk_rows, requests, attempts, params: P.SummaryParams, materialize: bool, outcomes=None):
        self.files = files
        self.chunk_rows = chunk_rows
        self.chunks = chunk_rows.where(F.col("chunk_no").isNotNull())
        self.requests = requests
        self.attempts = attempts
        self.params = params
        self.materialize = materialize
        self._outcomes = outcomes

    @cached_property
    def parsed(self) -> DataFrame:
        return D.parse_attempts(self.attempts)

    @cached_property
    def outcomes(self) -> DataFrame:
        """Per chunk; from the completion rounds, or from a ready table."""
        return D.chunk_outcomes(self.parsed, self.params.max_attempts) if self._outcomes is None else self._outcomes

    @cached_property
    def chunk_records(self) -> DataFrame:
        """The chunk table with what became of each chunk: the one join of
        chunks and outcomes, on which every later stage is built."""
        out = D.chunk_records(self.chunk_rows, self.outcomes)
        return stage(out, "records") if self.materialize else out

    @cached_property
    def lost(self) -> DataFrame:
        """(rel_path, chunk_no, fate) of the chunks that lose their file: a
        call error before a valid answer, an asked chunk never tried
        (no_answer), and with strict_merge (no chunk) a nested map item in a
        many-chunk file."""
        rows = self.chunk_records.where(F.col("fate").isNotNull()).select("rel_path", "chunk_no", "fate")
        if self.params.strict_merge:
            sound = D.without_failed(self.chunk_records, self.chunk_records.where(F.col("fate") == "call_error"))
            nested = E.nested_items(E.record_entries(sound.where(F.col("chunk_no").isNotNull()), carry=("n_chunks",)))
            rows = rows.unionByName(nested.select("rel_path", F.lit(None).cast("bigint").alias("chunk_no"), F.lit("nested_value").alias("fate")))
        return rows

    @property
    def failed(self) -> DataFrame:
        """Files left out of the summaries, with the reason."""
        counted = D.failures(self.lost)
        by_chunk = F.col("reason") != "nested_value"
        return counted.withColumn("failed_chunks", F.when(by_chunk, F.col("failed_chunks")))

    @property
    def kept_rows(self) -> DataFrame:
        """chunk_records of every file that is not in `failed`."""
        return D.without_failed(self.chunk_records, self.lost)

    @property
    def records(self) -> DataFrame:
        """One record per chunk of every file that is not in `failed`."""
        return self.kept_rows.where(F.col("chunk_no").isNotNull()).select("rel_path", "chunk_no", "n_chunks", "origin", "json_text", "object_keys")

    @property
    def summaries(self) -> DataFrame:
        return E.long_summaries(self.kept_rows, self.params.keep_all_sections)

    @property
    def wide(self) -> DataFrame:
        return E.wide_summaries(self.kept_rows, keep_all_sections=self.params.keep_all_sections).drop("branch")

    @property
    def artifacts(self) -> DataFrame:
        return summary_artifacts(self)

    @property
    def entries(self) -> DataFrame:
        return E.record_entries(self.records, carry=("n_chunks",))

    @property
    def skips(self) -> DataFrame:
        return E.merge_skips(self.entries)


def summarize(
    files: DataFrame,
    complete: D4.CompleteFn | None = None,
    attempts: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    params: P.SummaryParams = P.SummaryParams(),
    carry=(),
    tokenizer=None,
    attempts_path: str | None = None,
    partitions: int | None = None,
    materialize: bool = True,
    **publish,
) -> SummaryRun:
    """Summarise every file of `files` (rel_path, text).

    Give either `complete`, a batch function over request rows returning
    `response` and `error` (it runs in at most max_attempts rounds; answers
    are published to the store at `attempts_path` as they come, see
    sources.answers, whose batch_rows, publish_rows and publish_seconds may be
    given), or a ready `attempts` table (or a function of the chunk table that
    returns one). Of a ready table with a request_id, only the answers to this
    run's requests count.

    With materialize (the default) the chunk table and the per-chunk
    records are written once to the shared work folder; every later branch
    reads them instead of chunking the corpus again."""
    spark = configure(files.sparkSession)
    # Files that did not decode (text NULL) stay in the chunk table as one row
    # with n_chunks NULL, for the audit; no later stage reads the text again.
    chunk_rows = summary_chunks(spread(files), params, carry, tokenizer, keep_empty=True)
    if materialize:
        chunk_rows = stage(chunk_rows, "chunks")
    chunks = chunk_rows.where(F.col("chunk_no").isNotNull())
    requests = R.summary_requests(chunks, params, carry)
    if attempts is not None:
        att = attempts(chunks.where(~F.col("gated"))) if callable(attempts) else attempts
        if "request_id" in att.columns:
            att = att.join(requests.select("request_id"), "request_id", "left_semi")
        return SummaryRun(files, chunk_rows, requests, att, params, materialize)
    path = attempts_path or scratch_path(spark, "attempts")
    asked = chunks.where(~F.col("gated")).select("rel_path", "chunk_no", "chunk_text", *carry)
    rounds = Rounds(
        lambda rows: R.summary_requests(rows, params, carry),
        lambda answers: D.round_outcomes(answers, params.max_attempts, params.response_tokens, params.budget_step),
        params.max_attempts, params.response_tokens,
    )
    outcomes = settled_outcomes(asked, rounds, complete or D4.offline_stub, path, partitions, **publish)
    return SummaryRun(files, chunk_rows, requests, D4.answers_to(requests, path), params, materialize, outcomes)


def summary_artifacts(run: "SummaryRun") -> DataFrame:
    """(rel_path, out_path, branch, body): one JSON document per file, to be
    saved beside the source path with its last extension replaced by '.txt',
    indented by two spaces with non-ASCII escaped.

    A one-chunk file keeps its record as the model wrote it (duplicate keys:
    the last wins); a merged file gets the ten sections in record order, map
    items in item order (nested item values stay JSON text)."""
    keep_all = run.params.keep_all_sections
    sections = P.MERGED_SECTIONS + (("ETL Processes", "Variables") if keep_all else ())
    wide = E.wide_summaries(run.kept_rows, sections, keep_all, whole=True)
    record = F.to_json(F.struct(*[F.col(f"`{s}`") for s in sections]))
    body = F.when(F.col("branch") == "single", F.col("whole")).otherwise(record)
    return wide.select("rel_path", replace_extension("rel_path", P.SUMMARY_EXTENSION).alias("out_path"), "branch", json_indent2(body).alias("body"))
