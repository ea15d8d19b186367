"""Registered queries: one per operator of the inventory, each a function
(spark, sf_dir) -> DataFrame over the given tables, with its DuckDB twin.

Output convention: an integer column that has no value for some rows (a
chunk with no winning try, a text row with no item number) shows -1 there in
both engines, so both hand back the same non-null integer type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.operators import merge as E
from chunkwright.operators import responses as D
from chunkwright.operators.filters import source_files
from chunkwright.plans import fixtures as FX
from chunkwright.plans import oracle as O
from chunkwright.plans.summarize import summarize
from chunkwright.session import configure, spread
from chunkwright.sources.tables import documents_as_files

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed chunk size for the fixture pipeline: with the real 126,000-token
# budget every document would be a single chunk.
FIXTURE_CHUNK_CHARS = 700
SUMMARY_FIXTURE = P.SummaryParams(chunk_chars=FIXTURE_CHUNK_CHARS)
CARRY = ("doc_id", "source")

_SPARK: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _SPARK[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- stages --

def kept_files(spark: SparkSession, sf: str) -> DataFrame:
    """The B1/B2-selected files, spread over all cores when the source table
    has fewer partitions (the regex work after it is CPU-bound)."""
    configure(spark)
    return spread(source_files(documents_as_files(spark, sf)))


def summary_run(spark: SparkSession, sf: str, with_errors: bool = False, params: P.SummaryParams = SUMMARY_FIXTURE):
    return summarize(
        kept_files(spark, sf),
        attempts=lambda asked: FX.summary_attempts(asked, params.max_attempts, with_errors),
        params=params,
        carry=CARRY,
    )


# SQL stages of the same pipeline.
S_FILES = [O.FILES, O.KEPT, O.chunks_cte("chunks", "kept", str(FIXTURE_CHUNK_CHARS))]
S_ASKED = "asked as (select * from chunks where not gated)"


def s_parsed(with_errors: bool = False, n: int = 5) -> list[str]:
    return [*S_FILES, S_ASKED, O.summary_attempts_cte("attempts", "asked", n, with_errors), O.parsed_cte("parsed", "attempts")]


# ---------------------------------------------------------------- E3/E4 --

@register(
    "merge_text",
    O.sql(
        *s_parsed(),
        O.outcomes_cte("outcomes", "parsed"),
        "best as (select rel_path, chunk_no, json_text from outcomes where win is not null)",
        final=O.merge_text_sql("best"),
    ),
)
def q_merge_text(spark, sf):
    run = summary_run(spark, sf)
    best = run.outcomes.where(F.col("win").isNotNull())
    return E.merge_text(E.record_entries(best))


# ------------------------------------------------------------------- B --

@register("python_files", O.sql(O.FILES, final="select rel_path, file_name from files where ends_with(file_name, '.py')"))
def q_python_files(spark, sf):
    from chunkwright.operators.filters import python_files
    configure(spark)
    return python_files(documents_as_files(spark, sf)).select("rel_path", "file_name")


@register("non_test_files", O.sql(O.FILES, final="select rel_path, file_name from files where not contains(lower(file_name), 'test')"))
def q_non_test_files(spark, sf):
    from chunkwright.operators.filters import non_test_files
    configure(spark)
    return non_test_files(documents_as_files(spark, sf)).select("rel_path", "file_name")


@register("chunk_gate", O.sql(*S_FILES, final="select rel_path, chunk_no, gated from chunks"))
def q_chunk_gate(spark, sf):
    return summary_run(spark, sf).chunks.select("rel_path", "chunk_no", "gated")


@register(
    "rel_paths",
    O.sql(O.FILES, final="select concat('/data/corpus/', rel_path) as path, rel_path from files"),
)
def q_rel_paths(spark, sf):
    from chunkwright.operators.filters import relative_paths
    configure(spark)
    absolute = documents_as_files(spark, sf).select(F.concat(F.lit("/data/corpus/"), "rel_path").alias("path"))
    return relative_paths(absolute, "/data/corpus/").select("path", "rel_path")


# ------------------------------------------------------------------- C --

@register("head_sample", O.sql(O.FILES, O.KEPT, final=f"select rel_path, substr(text, 1, {P.SUMMARY_SAMPLE_CHARS}) as head from kept"))
def q_head_sample(spark, sf):
    from chunkwright.functions.text import head_sample
    return kept_files(spark, sf).select("rel_path", head_sample("text", P.SUMMARY_SAMPLE_CHARS).alias("head"))


@register("centre_sample", O.sql(O.FILES, O.KEPT, final=f"select rel_path, {O.centre('text', P.SUMMARY_SAMPLE_CHARS)} as centre from kept"))
def q_centre_sample(spark, sf):
    from chunkwright.functions.text import centre_sample
    return kept_files(spark, sf).select("rel_path", centre_sample("text", P.SUMMARY_SAMPLE_CHARS).alias("centre"))


@register(
    "token_counts",
    O.sql(
        O.FILES, O.KEPT,
        final=f"select rel_path, {O.token_count(f'substr(text,1,{P.SUMMARY_SAMPLE_CHARS})')} as sample_tokens, "
        f"{O.token_count('text')} as text_tokens from kept",
    ),
)
def q_token_counts(spark, sf):
    from chunkwright.functions.text import head_sample, token_count
    return kept_files(spark, sf).select(
        "rel_path",
        token_count(head_sample("text", P.SUMMARY_SAMPLE_CHARS)).alias("sample_tokens"),
        token_count("text").alias("text_tokens"),
    )


@register(
    "chars_per_token",
    O.sql(
        O.FILES, O.KEPT,
        final=f"select rel_path, {O.ratio(f'substr(text,1,{P.SUMMARY_SAMPLE_CHARS})')} as ratio_summary, "
        f"{O.ratio(f'substr(text,1,{P.COMMENT_SAMPLE_CHARS})')} as ratio_comment from kept",
    ),
)
def q_chars_per_token(spark, sf):
    from chunkwright.functions.text import chars_per_token, head_sample, token_count
    def r(n):
        s = head_sample("text", n)
        return chars_per_token(s, token_count(s))
    return kept_files(spark, sf).select(
        "rel_path", r(P.SUMMARY_SAMPLE_CHARS).alias("ratio_summary"), r(P.COMMENT_SAMPLE_CHARS).alias("ratio_comment")
    )


@register(
    "chunk_budget",
    O.sql(
        O.FILES, O.KEPT,
        final=f"select rel_path, {O.budget(f'substr(text,1,{P.SUMMARY_SAMPLE_CHARS})', P.SUMMARY_CHUNK_TOKENS)} as max_chars_summary, "
        f"{O.budget(f'substr(text,1,{P.COMMENT_SAMPLE_CHARS})', P.COMMENT_CHUNK_TOKENS)} as max_chars_comment from kept",
    ),
)
def q_chunk_budget(spark, sf):
    from chunkwright.operators.chunking import with_budget
    k = kept_files(spark, sf)
    a = with_budget(k, P.SUMMARY_CHUNK_TOKENS, P.SUMMARY_SAMPLE_CHARS).withColumnRenamed("max_chars", "max_chars_summary")
    b = with_budget(a.drop("n_tokens", "chars_per_token"), P.COMMENT_CHUNK_TOKENS, P.COMMENT_SAMPLE_CHARS)
    return b.select("rel_path", "max_chars_summary", F.col("max_chars").alias("max_chars_comment"))


@register("chunk_words", O.sql(*S_FILES, final="select rel_path, chunk_no, n_chunks, chunk_text from chunks"))
def q_chunk_words(spark, sf):
    return summary_run(spark, sf).chunks.select("rel_path", "chunk_no", "n_chunks", "chunk_text")


RATIO_TOKENS = 200


@register(
    "chunk_words_by_ratio",
    O.sql(
        O.FILES, O.KEPT,
        f"kept_r as (select *, {O.budget(f'substr(text,1,{P.SUMMARY_SAMPLE_CHARS})', RATIO_TOKENS)} as mr from kept)",
        O.chunks_cte("rchunks", "kept_r", "mr"),
        final="select rel_path, chunk_no, n_chunks, mr::bigint as max_chars, chunk_text from rchunks join (select rel_path, mr from kept_r) using (rel_path)",
    ),
)
def q_chunk_words_by_ratio(spark, sf):
    """Sample, ratio, budget and word chunks in a row: the chunk size follows
    from each file's own characters per token."""
    from chunkwright.operators import chunking as C
    budgeted = C.with_budget(kept_files(spark, sf), RATIO_TOKENS, P.SUMMARY_SAMPLE_CHARS)
    return C.chunk_words(budgeted, "max_chars", ("max_chars",)).select("rel_path", "chunk_no", "n_chunks", "max_chars", "chunk_text")


COMMENT_BUDGET = O.budget(f"substr(text,1,{P.COMMENT_SAMPLE_CHARS})", P.COMMENT_CHUNK_TOKENS)
S_COMMENT_FILES = [
    O.FILES,
    O.KEPT,
    f"kept_m as (select *, {COMMENT_BUDGET} as mc from kept)",
    O.chunks_cte("cchunks", "kept_m", "mc", kind="line"),
]


@register("chunk_lines", O.sql(*S_COMMENT_FILES, final="select rel_path, chunk_no, n_chunks, chunk_text from cchunks"))
def q_chunk_lines(spark, sf):
    from chunkwright.plans.annotate import comment_chunks
    return comment_chunks(kept_files(spark, sf), carry=CARRY).select("rel_path", "chunk_no", "n_chunks", "chunk_text")


RANGE_CHARS = 4096


@register("chunk_words_by_range", O.sql(*S_FILES, final="select rel_path, chunk_no, n_chunks, chunk_text from chunks"))
def q_chunk_words_by_range(spark, sf):
    """Word chunks of texts that arrive in ranges of 4096 characters."""
    from chunkwright.operators.ranges import chunk_ranges, text_ranges
    files = kept_files(spark, sf).withColumn("max_chars", F.lit(FIXTURE_CHUNK_CHARS))
    return chunk_ranges(text_ranges(files, RANGE_CHARS), "word")


@register("chunk_lines_by_range", O.sql(*S_COMMENT_FILES, final="select rel_path, chunk_no, n_chunks, chunk_text from cchunks"))
def q_chunk_lines_by_range(spark, sf):
    """Line chunks at each file's own budget, which is often more than a range."""
    from chunkwright.operators.chunking import with_budget
    from chunkwright.operators.ranges import chunk_ranges, text_ranges
    files = with_budget(kept_files(spark, sf), P.COMMENT_CHUNK_TOKENS, P.COMMENT_SAMPLE_CHARS)
    return chunk_ranges(text_ranges(files, RANGE_CHARS), "line")


TOKEN_WINDOW = 256


@register(
    "chunk_tokens",
    O.sql(
        O.FILES, O.KEPT,
        f"tk as (select rel_path, regexp_extract_all(text, {O.PRETOKEN}) as t from kept)",
        final=f"""select rel_path, i::bigint as chunk_no, ((len(t)-1)//{TOKEN_WINDOW}+1)::bigint as n_chunks,
  array_to_string(t[i*{TOKEN_WINDOW}+1:i*{TOKEN_WINDOW}+{TOKEN_WINDOW}], '') as chunk_text
from (select rel_path, t, unnest(range(0, ((len(t)-1)//{TOKEN_WINDOW}+1)::bigint)) as i from tk where len(t)>0)""",
    ),
)
def q_chunk_tokens(spark, sf):
    from chunkwright.operators.chunking import chunk_tokens
    return chunk_tokens(kept_files(spark, sf), TOKEN_WINDOW).select("rel_path", "chunk_no", "n_chunks", "chunk_text")


SPACED = r"regexp_extract_all({x}, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+')"


@register(
    "chunk_tokens_own",
    O.sql(
        O.FILES, O.KEPT,
        f"tk as (select rel_path, {SPACED.format(x='text')} as t from kept)",
        final=f"""select rel_path, i::bigint as chunk_no, ((len(t)-1)//{TOKEN_WINDOW}+1)::bigint as n_chunks,
  array_to_string(t[i*{TOKEN_WINDOW}+1:i*{TOKEN_WINDOW}+{TOKEN_WINDOW}], '') as chunk_text
from (select rel_path, t, unnest(range(0, ((len(t)-1)//{TOKEN_WINDOW}+1)::bigint)) as i from tk where len(t)>0)""",
    ),
)
def q_chunk_tokens_own(spark, sf):
    """Windows of a tokenizer given by the user (words with their white space)."""
    from chunkwright.functions.tokens import load_spaced_words
    from chunkwright.operators.chunking import chunk_tokens
    windows = chunk_tokens(kept_files(spark, sf), TOKEN_WINDOW, tokenizer=load_spaced_words)
    return windows.select("rel_path", "chunk_no", "n_chunks", "chunk_text")


@register(
    "chunk_budget_own",
    O.sql(
        O.FILES, O.KEPT,
        f"counted as (select rel_path, text, len({SPACED.format(x='text')})::bigint as text_tokens, "
        f"len({SPACED.format(x=f'substr(text,1,{P.SUMMARY_SAMPLE_CHARS})')})::bigint as sample_tokens from kept)",
        f"rated as (select *, case when sample_tokens=0 then 2.5 else (length(substr(text,1,{P.SUMMARY_SAMPLE_CHARS}))::double/sample_tokens)*0.75 end as r from counted)",
        final=f"select rel_path, text_tokens, sample_tokens, r as chars_per_token, greatest(floor({float(P.SUMMARY_CHUNK_TOKENS)}*r)::bigint, 1) as max_chars from rated",
    ),
)
def q_chunk_budget_own(spark, sf):
    """Token counts, ratio and chunk size by a tokenizer given by the user."""
    from chunkwright.functions.tokens import spaced_words, token_count_udf
    from chunkwright.operators.chunking import with_budget
    count = token_count_udf(lambda: spaced_words)
    rated = with_budget(kept_files(spark, sf), P.SUMMARY_CHUNK_TOKENS, P.SUMMARY_SAMPLE_CHARS, tokenizer=count)
    return rated.select("rel_path", count("text").alias("text_tokens"), F.col("n_tokens").alias("sample_tokens"), "chars_per_token", "max_chars")


@register(
    "chunk_stats",
    O.sql(
        *S_FILES,
        final="select rel_path, count(*)::bigint as n_chunks, max(length(chunk_text))::bigint as max_chunk_chars, "
        "sum(length(chunk_text))::bigint as total_chars from chunks group by rel_path",
    ),
)
def q_chunk_stats(spark, sf):
    from chunkwright.operators.chunking import chunk_stats
    return chunk_stats(summary_run(spark, sf).chunks)


# ------------------------------------------------------------------- D --

def _req_sql(src: str, prefix: str, suffix: str, system: str, model: str, max_tokens: int) -> str:
    prompt = f"concat({O.sql_str(prefix)}, chunk_text, {O.sql_str(suffix)})"
    return f"""select sha256(concat_ws('|', rel_path, chunk_no::varchar, prompt)) as request_id, rel_path, chunk_no,
  {O.sql_str(system)} as system, prompt, {O.sql_str(model)} as model, {max_tokens}::integer as max_tokens,
  0.5::double as temperature, 1::integer as n
from (select *, {prompt} as prompt from {src} where not gated)"""


def _summary_req_sql(src: str = "chunks") -> str:
    from chunkwright.operators import requests as R
    return _req_sql(src, R.SUMMARY_PREFIX, R.SUMMARY_SUFFIX, R.SUMMARY_SYSTEM, SUMMARY_FIXTURE.model, P.RESPONSE_TOKENS)


@register("summary_requests", O.sql(*S_FILES, final=_summary_req_sql()))
def q_summary_requests(spark, sf):
    return summary_run(spark, sf).requests.select(
        "request_id", "rel_path", "chunk_no", "system", "prompt", "model", "max_tokens", "temperature", "n"
    )


def _comment_req_sql() -> str:
    from chunkwright.operators import requests as R
    base = _req_sql("cchunks", R.COMMENT_PREFIX, R.COMMENT_SUFFIX, R.COMMENT_SYSTEM, P.CommentParams().model, P.COMMENT_RESPONSE_TOKENS)
    return f"select *, '1:0.5-1.5;2:1.0-3.0' as waits from ({base})"


@register("comment_requests", O.sql(*S_COMMENT_FILES, final=_comment_req_sql()))
def q_comment_requests(spark, sf):
    req = annotate_run(spark, sf).requests
    waits = F.array_join(
        F.transform("waits", lambda w: F.concat(w["after_try"].cast("string"), F.lit(":"), w["min_wait_sec"].cast("string"),
                                                F.lit("-"), w["max_wait_sec"].cast("string"))), ";")
    return req.select("request_id", "rel_path", "chunk_no", "system", "prompt", "model", "max_tokens", "temperature", "n",
                      waits.alias("waits"))


@register(
    "complete_stub",
    O.sql(
        *S_FILES,
        f"requests as ({_summary_req_sql()})",
        final=f"""select r.request_id, r.rel_path, r.chunk_no, 1::bigint as attempt, r.max_tokens, {O.stub_answer()} as response, null::varchar as error
from requests r join chunks c on r.rel_path=c.rel_path and r.chunk_no=c.chunk_no""",
    ),
)
def q_complete_stub(spark, sf):
    from chunkwright.operators import completion as D4
    req = summary_run(spark, sf).requests.withColumn("attempt", F.lit(1).cast("bigint"))
    return D4.complete(req, D4.offline_stub)


OLDER = "Older version of this text: "


@register(
    "resumed_run",
    O.sql(
        *S_FILES,
        S_ASKED,
        f"older as (select doc_id, source, rel_path, case when doc_id%3=0 then concat({O.sql_str(OLDER)}, text) else text end as text from kept where doc_id%4<>1)",
        O.chunks_cte("ochunks", "older", str(FIXTURE_CHUNK_CHARS)),
        f"told as (select rel_path, chunk_no, chunk_text, {O.stub_answer()} as response from asked)",
        final=f"""select t.rel_path, t.chunk_no, a::bigint as attempt, {P.RESPONSE_TOKENS}::integer as max_tokens, t.response, o.rel_path is not null as reused
from told t left join ochunks o on not o.gated and o.rel_path=t.rel_path and o.chunk_no=t.chunk_no and o.chunk_text=t.chunk_text,
  unnest(range(1, 2 + case when json_valid(t.response) then 0 else {P.SUMMARY_ATTEMPTS - 1} end)) r(a)""",
    ),
)
def q_resumed_run(spark, sf):
    """The summary job over a store that an earlier run left behind: it had
    not seen a quarter of the files, and an older text of every third one.
    The answers to this run's requests, and whether each was already there."""
    from chunkwright.operators import completion as D4
    from chunkwright.session import scratch_path, stage
    files, path = kept_files(spark, sf), scratch_path(spark, "answers")
    older = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(OLDER), "text")).otherwise(F.col("text"))
    options = {"complete": D4.offline_stub, "params": SUMMARY_FIXTURE, "carry": CARRY, "attempts_path": path}
    summarize(files.where("doc_id % 4 <> 1").withColumn("text", older), **options)
    before = stage(D4.read_or_empty(spark, path).select("request_id", F.lit(True).alias("_there")).distinct(), "before")
    now = summarize(files, **options).attempts.join(before, "request_id", "left")
    return now.select("rel_path", "chunk_no", "attempt", "max_tokens", "response", F.coalesce("_there", F.lit(False)).alias("reused"))


ATTEMPT_KEY = "rel_path, chunk_no, attempt"


@register("extract_json", O.sql(*s_parsed(), final=f"select {ATTEMPT_KEY}, extracted from parsed"))
def q_extract_json(spark, sf):
    return summary_run(spark, sf).parsed.select("rel_path", "chunk_no", "attempt", "extracted")


@register("decode_json", O.sql(*s_parsed(), final=f"select {ATTEMPT_KEY}, json_text, coalesce(n_keys, -1) as n_keys from parsed"))
def q_decode_json(spark, sf):
    # n_keys is -1 when the answer does not decode (no NULLs in integer columns).
    return summary_run(spark, sf).parsed.select(
        "rel_path", "chunk_no", "attempt", "json_text", F.coalesce("n_keys", F.lit(-1)).cast("bigint").alias("n_keys"))


@register("validate_responses", O.sql(*s_parsed(), final=f"select {ATTEMPT_KEY}, status from parsed"))
def q_validate_responses(spark, sf):
    return summary_run(spark, sf).parsed.select("rel_path", "chunk_no", "attempt", "status")


@register("incomplete_json", O.sql(*s_parsed(), final=f"select {ATTEMPT_KEY}, incomplete from parsed"))
def q_incomplete_json(spark, sf):
    return summary_run(spark, sf).parsed.select("rel_path", "chunk_no", "attempt", "incomplete")


@register(
    "incomplete_prose",
    f"select conv_id, turn, case when text is null then null else {O.strip('text')}<>'' and right({O.strip('text')},1) not in ('.','!','?') end as incomplete from conversations",
)
def q_incomplete_prose(spark, sf):
    from chunkwright.functions.jsontext import prose_incomplete
    from chunkwright.sources.tables import table
    configure(spark)
    return table(spark, sf, "conversations").select("conv_id", "turn", prose_incomplete("text").alias("incomplete"))


@register(
    "resolve_attempts",
    O.sql(*s_parsed(), O.outcomes_cte("outcomes", "parsed"), final="select rel_path, chunk_no, tries, win, json_text from outcomes"),
)
def q_resolve_attempts(spark, sf):
    return D.resolve_attempts(summary_run(spark, sf).parsed)


@register(
    "attempt_budget",
    O.sql(
        *s_parsed(),
        final=f"""select {ATTEMPT_KEY}, ({P.RESPONSE_TOKENS} + {P.BUDGET_STEP}*coalesce(sum(case when status in ('bad_keys','bad_types') and incomplete then 1 else 0 end)
   over (partition by rel_path, chunk_no order by attempt rows between unbounded preceding and 1 preceding), 0))::bigint as max_tokens
from parsed""",
    ),
)
def q_attempt_budget(spark, sf):
    return D.attempt_budget(summary_run(spark, sf).parsed).select("rel_path", "chunk_no", "attempt", "max_tokens")


def _records_sql(max_attempts: int, with_errors: bool) -> list[str]:
    return [
        *s_parsed(with_errors),
        O.outcomes_cte("outcomes", "parsed", max_attempts),
        f"failed as ({O.outcomes_failed('outcomes')})",
        f"""records as (
  select c.rel_path, c.chunk_no, c.n_chunks,
    case when c.gated then 'gated' when o.win is not null then 'model' else 'exhausted' end as origin,
    case when c.gated then {O.sql_str(D.GATED_RECORD)} when o.win is not null then o.json_text
         else {O.sql_str(D.EXHAUSTED_RECORD)} end as json_text
  from chunks c left join outcomes o on c.rel_path=o.rel_path and c.chunk_no=o.chunk_no
  where c.rel_path not in (select rel_path from failed))""",
    ]


@register("fallback_records", O.sql(*_records_sql(1, False), final="select rel_path, chunk_no, origin, json_text from records"))
def q_fallback_records(spark, sf):
    run = summary_run(spark, sf, params=SUMMARY_FIXTURE.with_(max_attempts=1))
    return run.records.select("rel_path", "chunk_no", "origin", "json_text")


@register(
    "failed_files",
    O.sql(
        *s_parsed(True),
        O.outcomes_cte("outcomes", "parsed"),
        final=f"""select rel_path, count(*)::bigint as failed_chunks, min(chunk_no)::bigint as first_failed_chunk,
  'call_error' as reason from ({O.outcomes_failed('outcomes')}) group by rel_path""",
    ),
)
def q_failed_files(spark, sf):
    return summary_run(spark, sf, with_errors=True).failed


@register(
    "pending_requests",
    O.sql(
        *s_parsed(True),
        "so_far as (select * from parsed where attempt <= 2)",
        O.outcomes_cte("outcomes", "so_far"),
        f"requests as ({_summary_req_sql()})",
        final=f"""select r.request_id, r.rel_path, r.chunk_no, (coalesce(o.tries,0)+1)::bigint as attempt,
  ({P.RESPONSE_TOKENS} + {P.BUDGET_STEP}*coalesce(o.growth,0))::integer as max_tokens
from requests r left join outcomes o on r.rel_path=o.rel_path and r.chunk_no=o.chunk_no
where o.win is null and o.first_error is null and coalesce(o.tries,0) < {P.SUMMARY_ATTEMPTS}""",
    ),
)
def q_pending_requests(spark, sf):
    """Pending chunks are found on keys and text; prompts (and the ids hashed
    from them) are made for those alone."""
    from chunkwright.operators import requests as R
    run = summary_run(spark, sf, with_errors=True)
    asked = run.chunks.where(~F.col("gated")).select("rel_path", "chunk_no", "chunk_text")
    due = D.pending_requests(asked, run.parsed.where(F.col("attempt") <= 2))
    return R.summary_requests(due, run.params).select("request_id", "rel_path", "chunk_no", "attempt", "max_tokens")


# ------------------------------------------------------ comment mode (D14) --

def annotate_run(spark: SparkSession, sf: str):
    from chunkwright.plans.annotate import annotate
    return annotate(kept_files(spark, sf), attempts=lambda asked: FX.comment_attempts(asked), carry=CARRY)


S_COMMENTS = [
    *S_COMMENT_FILES,
    "casked as (select * from cchunks where not gated)",
    O.comment_attempts_cte("cattempts", "casked"),
    f"""coutcomes as (
  select rel_path, chunk_no, count(*) filter (where attempt<=3)::bigint as tries,
    min(attempt) filter (where attempt<=3 and error is null and response is not null)::bigint as first_ok,
    arg_min(response, attempt) filter (where attempt<=3 and error is null and response is not null) as response,
    min(attempt) filter (where attempt<=3 and error is null and response is null)::bigint as first_missing
  from cattempts group by rel_path, chunk_no)""",
    f"""cresolved as (
  select rel_path, chunk_no, fl as failed, case when not fl then first_ok end as win,
         case when not fl then {O.strip('response')} end as comment
  from (select *, (first_ok is null or (first_missing is not null and first_missing < first_ok)) as fl from coutcomes))""",
    "cfailed as (select distinct rel_path from cresolved where failed)",
    """ccomments as (
  select c.rel_path, c.chunk_no, c.chunk_text, case when c.gated then c.chunk_text else r.comment end as comment
  from cchunks c left join cresolved r on c.rel_path=r.rel_path and c.chunk_no=r.chunk_no
  where c.rel_path not in (select rel_path from cfailed))""",
    """cstitched as (
  select rel_path, string_agg(comment, chr(10) order by chunk_no) as comments, string_agg(chunk_text, '' order by chunk_no) as text
  from ccomments group by rel_path
  union all select rel_path, '' as comments, '' as text from kept where length(text)=0)""",
    "cartifacts as (select rel_path, rel_path as out_path, concat(comments, chr(10), chr(10), text) as body from cstitched)",
]


@register("resolve_comments", O.sql(*S_COMMENTS, final="select rel_path, chunk_no, coalesce(win, -1) as win, comment, failed from cresolved"))
def q_resolve_comments(spark, sf):
    r = annotate_run(spark, sf).resolved
    return r.select("rel_path", "chunk_no", F.coalesce("win", F.lit(-1)).cast("bigint").alias("win"), "comment", "failed")


@register("stitch_comments", O.sql(*S_COMMENTS, final="select rel_path, comments as stitched from cstitched"))
def q_stitch_comments(spark, sf):
    return annotate_run(spark, sf).stitched.select("rel_path", F.col("comments").alias("stitched"))


@register("annotated_files", O.sql(*S_COMMENTS, final="select rel_path, out_path, body from cartifacts"))
def q_annotated_files(spark, sf):
    return annotate_run(spark, sf).artifacts


@register(
    "stitch_lines",
    f"""select conv_id, len(l)::bigint as n_lines, array_to_string(l, chr(10)) as stitched
from (select conv_id, flatten(list(lines order by turn)) as l
      from (select conv_id, turn, {O.splitlines('text')} as lines from conversations) group by conv_id)""",
)
def q_stitch_lines(spark, sf):
    from chunkwright.sources.tables import table
    configure(spark)
    return E.stitch_lines(table(spark, sf, "conversations"), "conv_id", "turn", "text")


# -------------------------------------------------------------- E1, E5-E7 --

@register(
    "merge_maps",
    O.sql(
        *s_parsed(),
        O.outcomes_cte("outcomes", "parsed"),
        "best as (select rel_path, chunk_no, json_text from outcomes where win is not null)",
        final=O.merge_maps_sql("best"),
    ),
)
def q_merge_maps(spark, sf):
    run = summary_run(spark, sf)
    best = run.outcomes.where(F.col("win").isNotNull())
    return E.merge_maps(E.record_entries(best))


S_SUMMARIES = [
    *_records_sql(P.SUMMARY_ATTEMPTS, True),
    """fcounts as (
  select k.rel_path, coalesce(max(c.n_chunks), 0)::bigint as n_chunks
  from kept k left join chunks c on k.rel_path=c.rel_path
  where k.rel_path not in (select rel_path from failed) group by k.rel_path)""",
    "single as (select * from records where n_chunks = 1)",
    "multi as (select * from records where n_chunks <> 1)",
    """single_rows as (
  select rel_path, j.key as section, null::varchar as item, -1::bigint as item_no, j.value->>'$' as value, 'single' as branch
  from single, json_each(json_text) j where j.type='VARCHAR'
  union all
  select rel_path, s.key, i.key, (row_number() over (partition by rel_path, s.key order by i.id) - 1)::bigint,
         case when i.type='VARCHAR' then i.value->>'$' else i.value::varchar end, 'single'
  from single, json_each(json_text) s, json_each(s.value) i where s.type='OBJECT')""",
    f"mtext as ({O.merge_text_sql('multi')})",
    f"mmaps as ({O.merge_maps_sql('multi')})",
    f"""merged_rows as (
  select k.rel_path, k.section, null::varchar as item, -1::bigint as item_no, coalesce(t.value, '') as value, 'merged' as branch
  from (select f.rel_path, s.section from fcounts f, (select unnest({O._pylist(P.TEXT_SECTIONS)}) as section) s where f.n_chunks <> 1) k
  left join mtext t on k.rel_path=t.rel_path and k.section=t.section
  union all
  select rel_path, section, item, item_no, value, 'merged' from mmaps)""",
    "summaries as (select * from single_rows union all select * from merged_rows)",
]


def _no_null_item_no(df):
    return df.withColumn("item_no", F.coalesce("item_no", F.lit(-1)).cast("bigint"))


@register("file_summaries", O.sql(*S_SUMMARIES, final="select rel_path, section, item, item_no, value, branch from summaries"))
def q_file_summaries(spark, sf):
    return _no_null_item_no(summary_run(spark, sf, with_errors=True).summaries)


def _snake(s: str) -> str:
    import re
    return re.sub(r"[^a-z0-9]+", "_", s.lower()).strip("_")


def _wide_sql() -> str:
    cols = []
    for s in P.MERGED_SECTIONS:
        if s in P.MAP_SECTIONS:
            cols.append(
                f"coalesce(string_agg(concat(item, ': ', value), chr(10) order by item_no) filter (where section={O.sql_str(s)} and item is not null), '') as {_snake(s)}"
            )
        else:
            cols.append(f"coalesce(max(value) filter (where section={O.sql_str(s)} and item is null), '') as {_snake(s)}")
    return f"select rel_path, {', '.join(cols)} from summaries group by rel_path"


@register("summary_wide", O.sql(*S_SUMMARIES, final=_wide_sql()))
def q_summary_wide(spark, sf):
    wide = summary_run(spark, sf, with_errors=True).wide
    cols = []
    for s in P.MERGED_SECTIONS:
        c = F.col(f"`{s}`")
        if s in P.MAP_SECTIONS:
            c = F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
        cols.append(c.alias(_snake(s)))
    return wide.select("rel_path", *cols)


@register(
    "merge_skips",
    O.sql(
        *S_SUMMARIES,
        final=f"""select rel_path, chunk_no, s.key as section, null::varchar as item, 'not_object' as reason
from multi, json_each(json_text) s where s.key in {O.MAP_SECTIONS} and s.type <> 'OBJECT'
union all
select rel_path, chunk_no, section, item, reason from (
  select rel_path, chunk_no, s.key as section, i.key as item,
         case when i.type='VARCHAR' then {O.strip("(i.value->>'$')")} else i.value::varchar end as val, i.type as t
  from multi, json_each(json_text) s, json_each(s.value) i where s.key in {O.MAP_SECTIONS} and s.type='OBJECT'),
  (select unnest(['none_like_item', 'nested_value']) as reason)
where (reason='none_like_item' and {O.none_like('val')}) or (reason='nested_value' and t <> 'VARCHAR')""",
    ),
)
def q_merge_skips(spark, sf):
    return summary_run(spark, sf, with_errors=True).skips


@register(
    "summary_artifacts",
    O.sql(
        *S_SUMMARIES,
        final=f"""select rel_path, {O.replace_ext('rel_path', '.txt')} as out_path, 'single' as branch,
  len(json_keys(json_text))::bigint as n_keys, json_extract_string(json_text, '$."Overall Summary"') as overall_summary from single
union all
select rel_path, {O.replace_ext('rel_path', '.txt')}, 'merged', {len(P.MERGED_SECTIONS)}::bigint, value
from merged_rows where section='Overall Summary'""",
    ),
)
def q_summary_artifacts(spark, sf):
    art = summary_run(spark, sf, with_errors=True).artifacts
    m = F.from_json("body", "map<string,string>")
    return art.select(
        "rel_path", "out_path", "branch",
        F.size(m).cast("bigint").alias("n_keys"),
        F.try_element_at(m, F.lit("Overall Summary")).alias("overall_summary"),
    )


# ------------------------------------------------------------------- F --

DOC_TITLE = "Annotated sources"


def annotated_artifacts(spark, sf):
    return annotate_run(spark, sf).artifacts


S_NODES = [
    *S_COMMENTS,
    "ap as (select out_path, body, string_split(out_path, '/') as p from cartifacts)",
    """nodes as (
  select out_path as path, case when len(p)>1 then array_to_string(p[1:len(p)-1], '/') else '' end as parent,
         p[-1] as name, (len(p)-1)::integer as depth, 'file' as kind from ap
  union all
  select distinct array_to_string(p[1:i], '/'), case when i>1 then array_to_string(p[1:i-1], '/') else '' end,
         p[i], (i-1)::integer, 'dir' from (select p, unnest(range(1, len(p))) as i from ap))""",
    """children as (
  select parent as path, coalesce(list(name order by name) filter (where kind='dir'), []) as subdirs,
         coalesce(list(name order by name) filter (where kind='file'), []) as files
  from nodes group by parent)""",
    f"""crumbs as (
  select path, array_to_string(list_concat(list_transform(range(1, len(p)), lambda i: concat('<a href="#',
           {O.attr("array_to_string(p[1:i], '/')")}, '">', {O.esc('p[i]')}, '</a>')), [{O.esc('p[-1]')}]), ' > ') as crumbs
  from (select path, string_split(path, '/') as p from nodes where kind='dir'))""",
]


@register("directory_nodes", O.sql(*S_NODES, final="select path, parent, name, depth, kind from nodes"))
def q_directory_nodes(spark, sf):
    from chunkwright.operators.hierarchy import directory_nodes
    return directory_nodes(annotated_artifacts(spark, sf))


@register(
    "directory_children",
    O.sql(*S_NODES, final="select path, array_to_string(subdirs, chr(10)) as subdirs, array_to_string(files, chr(10)) as files from children"),
)
def q_directory_children(spark, sf):
    from chunkwright.operators.hierarchy import directory_children, directory_nodes
    k = directory_children(directory_nodes(annotated_artifacts(spark, sf)))
    return k.select("path", F.array_join("subdirs", "\n").alias("subdirs"), F.array_join("files", "\n").alias("files"))


@register(
    "directory_entries",
    O.sql(*S_NODES, final="""select parent as path, kind, (row_number() over (partition by parent, kind order by name) - 1)::bigint as position, name from nodes"""),
)
def q_directory_entries(spark, sf):
    """The entries of every folder as numbered rows."""
    from chunkwright.operators.hierarchy import directory_nodes
    from chunkwright.operators.positions import child_rows
    return child_rows(directory_nodes(annotated_artifacts(spark, sf)))


@register("breadcrumbs", O.sql(*S_NODES, final="select path, crumbs from crumbs"))
def q_breadcrumbs(spark, sf):
    from chunkwright.operators.hierarchy import breadcrumbs, directory_nodes
    return breadcrumbs(directory_nodes(annotated_artifacts(spark, sf)))


def _fragments_sql() -> str:
    def dirkey(x):
        return f"array_to_string(list_transform(string_split({x}, '/'), lambda y: '1' || y), chr(1))"
    t = O.esc(O.sql_str(DOC_TITLE))
    frames = "(values ('!1', '<ul class=\"dirs\">'), ('!3', '</ul>'), ('!4', '<ul class=\"files\">'), ('!6', '</ul>')) f(code, tag)"
    return f"""select '' as sort_key, concat('<!DOCTYPE html>', chr(10), '<html><head><meta charset="utf-8"><title>', {t},
    '</title></head>', chr(10), '<body>', chr(10), '<h1>', {t}, '</h1>', chr(10)) as body
union all select '2', concat('</body></html>', chr(10))
union all
select {dirkey('c.path')}, concat('<h2 id="', {O.attr('c.path')}, '">', c.crumbs, '</h2>', chr(10)) from crumbs c
union all
select concat({dirkey('c.path')}, chr(1), f.code), concat(f.tag, chr(10)) from crumbs c, {frames}
union all
select concat({dirkey('parent')}, chr(1), case when kind='dir' then '!2' else '!5' end, name),
       concat('<li><a href="#', {O.attr('path')}, '">', {O.esc('path')}, '</a></li>', chr(10))
from nodes where parent <> ''
union all
select array_to_string(list_concat(list_transform(p[1:len(p)-1], lambda x: '1' || x), ['0' || p[-1]]), chr(1)),
  concat('<h3 id="', {O.attr('out_path')}, '">', {O.esc('out_path')}, '</h3>', chr(10), '<pre><code>', {O.esc('body')}, '</code></pre>', chr(10))
from ap"""


@register("document_fragments", O.sql(*S_NODES, final=_fragments_sql()))
def q_document_fragments(spark, sf):
    from chunkwright.plans.document import build_document
    return build_document(annotated_artifacts(spark, sf), DOC_TITLE)


@register(
    "json_outline",
    "select event_id, j.fullkey as path, j.atom::varchar as value from events, json_tree(props) j where j.fullkey <> '$'",
)
def q_json_outline(spark, sf):
    from chunkwright.operators.hierarchy import json_outline
    from chunkwright.sources.tables import table
    configure(spark)
    o = json_outline(table(spark, sf, "events").select("event_id", "props"), "event_id", "props")
    return o.where(F.col("path") != "$").select("event_id", "path", "value")


@register(
    "record_outline",
    O.sql(
        *s_parsed(),
        O.outcomes_cte("outcomes", "parsed"),
        "best as (select rel_path, chunk_no, json_text from outcomes where win is not null)",
        final="""select concat(rel_path, '#', chunk_no) as record_id, j.fullkey as path, j.atom::varchar as value
from best, json_tree(json_text) j where j.fullkey <> '$'""",
    ),
)
def q_record_outline(spark, sf):
    """The JSON outline of every winning chunk answer of the summary job."""
    from chunkwright.operators.hierarchy import json_outline
    run = summary_run(spark, sf)
    best = run.outcomes.where(F.col("win").isNotNull()).select(
        F.concat("rel_path", F.lit("#"), F.col("chunk_no").cast("string")).alias("record_id"), "json_text")
    o = json_outline(best, "record_id", "json_text")
    return o.where(F.col("path") != "$").select("record_id", "path", "value")


# ------------------------------------------------------------------- G --

S_AUDIT = [
    *S_SUMMARIES,
    """audit as (
  select rel_path, 'select' as stage, case when reason is null then 'kept' else 'skipped' end as status, reason
  from (select rel_path, case when not ends_with(file_name, '.py') then 'suffix'
                              when contains(lower(file_name), 'test') then 'test_name' end as reason from files)
  union all
  select k.rel_path, 'complete', case when f.rel_path is not null then 'failed' else 'ok' end,
         case when f.rel_path is not null then 'call_error' end
  from kept k left join (select distinct rel_path from failed) f on k.rel_path=f.rel_path
  union all
  select k.rel_path, 'resolve',
         case when r.any_open=1 then 'exhausted' when r.max_win>1 then 'retried' else 'first_try' end, null
  from kept k left join (select rel_path, max(coalesce(win,0)) as max_win, max(case when win is null then 1 else 0 end) as any_open
                         from outcomes group by rel_path) r on k.rel_path=r.rel_path
  where k.rel_path not in (select rel_path from failed))""",
]


def summary_audit_df(spark, sf):
    from chunkwright.operators.audit import summary_audit
    run = summary_run(spark, sf, with_errors=True)
    return summary_audit(documents_as_files(spark, sf), run)


@register("quarantine", O.sql(*S_AUDIT, final="select rel_path, stage, reason from audit where status='failed'"))
def q_quarantine(spark, sf):
    from chunkwright.operators.audit import quarantine
    return quarantine(summary_audit_df(spark, sf))


@register("run_report", O.sql(*S_AUDIT, final="select stage, status, count(*)::bigint as n from audit group by rollup(stage, status)"))
def q_run_report(spark, sf):
    from chunkwright.operators.audit import run_report
    return run_report(summary_audit_df(spark, sf))


# ------------------------------------------------------------------- A --

def _tree_of(spark, df: DataFrame, name: str) -> str:
    """Write df (out_path, body) as a file tree in the shared work folder."""
    from chunkwright.session import scratch_path, strip_scheme
    from chunkwright.sources.tree import write_tree
    root = strip_scheme(scratch_path(spark, name))
    write_tree(df, root)
    return root


@register(
    "scan_tree",
    O.sql(O.FILES, O.KEPT, final="select rel_path, strlen(text)::bigint as n_bytes from kept"),
)
def q_scan_tree(spark, sf):
    """Write every document as a file, then scan the tree with the name
    filters as source options."""
    from chunkwright.sources.tree import scan_tree
    configure(spark)
    files = documents_as_files(spark, sf).select(F.col("rel_path").alias("out_path"), F.col("text").alias("body"))
    root = _tree_of(spark, files, "tree")
    return scan_tree(spark, root, P.SOURCE_SUFFIX, P.EXCLUDE_NAME).select("rel_path", "n_bytes")


@register(
    "decode_text",
    O.sql(O.FILES, final="select rel_path, regexp_replace(text, '\\r\\n?', chr(10), 'g') as text, length(regexp_replace(text, '\\r\\n?', chr(10), 'g'))::bigint as n_chars from files"),
)
def q_decode_text(spark, sf):
    from chunkwright.sources.tree import decode_text, scan_tree
    configure(spark)
    files = documents_as_files(spark, sf).select(F.col("rel_path").alias("out_path"), F.col("text").alias("body"))
    root = _tree_of(spark, files, "tree")
    return decode_text(scan_tree(spark, root)).select("rel_path", "text", "n_chars")


@register("read_artifacts", O.sql(*S_COMMENTS, final="select rel_path, out_path, body from cartifacts"))
def q_read_artifacts(spark, sf):
    """Annotated files written as a tree and read back."""
    from chunkwright.sources.artifacts import read_artifacts
    root = _tree_of(spark, annotate_run(spark, sf).artifacts, "annotated")
    return read_artifacts(spark, root)


S_CAUDIT = [
    *S_COMMENTS,
    """caudit as (
  select rel_path, 'select' as stage, case when reason is null then 'kept' else 'skipped' end as status, reason
  from (select rel_path, case when not ends_with(file_name, '.py') then 'suffix'
                              when contains(lower(file_name), 'test') then 'test_name' end as reason from files)
  union all
  select k.rel_path, 'complete', case when f.rel_path is not null then 'failed' else 'ok' end,
         case when f.rel_path is not null then 'call_error' end
  from kept k left join cfailed f on k.rel_path=f.rel_path)""",
]


def comment_audit_df(spark, sf):
    from chunkwright.operators.audit import annotate_audit
    return annotate_audit(documents_as_files(spark, sf), annotate_run(spark, sf))


@register("comment_quarantine", O.sql(*S_CAUDIT, final="select rel_path, stage, reason from caudit where status='failed'"))
def q_comment_quarantine(spark, sf):
    from chunkwright.operators.audit import quarantine
    return quarantine(comment_audit_df(spark, sf))


@register("comment_run_report", O.sql(*S_CAUDIT, final="select stage, status, count(*)::bigint as n from caudit group by rollup(stage, status)"))
def q_comment_run_report(spark, sf):
    from chunkwright.operators.audit import run_report
    return run_report(comment_audit_df(spark, sf))


@register("summary_document")
def q_summary_document(spark, sf):
    """The linked document over the summary artifacts (rows only: the bodies
    are json.dumps-formatted records, which the SQL engine cannot re-create
    byte for byte; the same operator is checked on annotated files)."""
    from chunkwright.plans.document import build_document
    return build_document(summary_run(spark, sf, with_errors=True).artifacts, "Project summary")
