"""The completion stage (D4): user function over request batches.

Model calls are costly and not repeatable. ``sources.answers.ask`` calls the
function in its write tasks and publishes the answers as they come, so a lost
job keeps what was paid for; ``complete`` is the same call as a lazy table,
for a caller that stores the answers itself. Speculative execution must stay
off for these stages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.operators import requests as R
from chunkwright.sources.answers import ATTEMPT_SCHEMA, answers_to, read_or_empty

CompleteFn = Callable[[pd.DataFrame], pd.DataFrame]


class _WrongLength(ValueError):
    """The function gave another number of rows: its fault, not a row's."""


def _answers(fn: CompleteFn, b: pd.DataFrame) -> tuple[list, list]:
    """(responses, errors) of one call, None where there is none."""
    out = fn(b)
    if len(out) != len(b):
        raise _WrongLength(f"complete() returned {len(out)} rows for {len(b)} requests")
    resp = out["response"].astype(object).where(out["response"].notna(), None)
    err = out["error"].astype(object).where(out["error"].notna(), None) if "error" in out else [None] * len(b)
    return list(resp), list(err)


def answer_batch(fn: CompleteFn, b: pd.DataFrame) -> pd.DataFrame:
    """One attempt row a request. A batch that raises is asked again row by
    row, so one bad request costs its own answer and no other."""
    try:
        resp, err = _answers(fn, b)
    except _WrongLength as e:
        resp, err = [None] * len(b), [f"ValueError: {e}"] * len(b)
    except Exception as whole:
        resp, err = [None] * len(b), [f"{type(whole).__name__}: {whole}"] * len(b)
        for i in range(len(b) if len(b) > 1 else 0):
            try:
                (resp[i],), (err[i],) = _answers(fn, b.iloc[i : i + 1].reset_index(drop=True))
            except Exception as e:
                err[i] = f"{type(e).__name__}: {e}"
    return pd.DataFrame(
        {
            "request_id": b["request_id"].values,
            "rel_path": b["rel_path"].values,
            "chunk_no": b["chunk_no"].astype("int64").values,
            "attempt": b["attempt"].astype("int64").values,
            "max_tokens": b["max_tokens"].astype("int32").values,
            "response": resp,
            "error": err,
        }
    )


ASKED = ["request_id", "rel_path", "chunk_no", "attempt", "system", "prompt", "model", "max_tokens", "temperature"]


def for_function(requests: DataFrame) -> DataFrame:
    """The columns the completion function sees: those of ASKED, ``n`` (the
    answers wanted) and, where waits are planned, ``min_wait_sec`` and
    ``max_wait_sec``: how long to wait before this attempt (null before the
    first)."""
    extra = [c for c in ("n",) if c in requests.columns]
    if "waits" in requests.columns:
        due = F.get("waits", (F.col("attempt") - 2).cast("int"))
        extra += [due["min_wait_sec"].alias("min_wait_sec"), due["max_wait_sec"].alias("max_wait_sec")]
    return requests.select(*ASKED, *extra)


def complete(requests: DataFrame, fn: CompleteFn, partitions: int | None = None) -> DataFrame:
    """Lazily call fn on batches of requests (which carry `attempt`).

    Requests are spread by request_id, so the chunks of one large file go to
    many tasks; `partitions` caps how many calls run at once."""
    spark = requests.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield answer_batch(fn, b)

    return for_function(requests).repartition(n, "request_id").mapInPandas(run, ATTEMPT_SCHEMA)


def offline_stub(batch: pd.DataFrame) -> pd.DataFrame:
    """A deterministic stand-in for a model, for tests and benchmarks."""
    out_resp = []
    for system, prompt in zip(batch["system"], batch["prompt"]):
        if system == R.SUMMARY_SYSTEM:
            body = prompt[len(R.SUMMARY_PREFIX): len(prompt) - len(R.SUMMARY_SUFFIX)]
            words = body.split()
            first = " ".join(words[:6]).replace("\\", " ").replace('"', "'")
            out_resp.append(
                '{"Overall Summary": "%s", "Data Inputs": "%d words", "Data Outputs": "%d lines"}'
                % (first, len(words), body.count("\n") + 1)
            )
        else:
            body = prompt[len(R.COMMENT_PREFIX): len(prompt) - len(R.COMMENT_SUFFIX)]
            out_resp.append('"""Documented part."""\n' + body)
    return pd.DataFrame({"response": out_resp, "error": [None] * len(out_resp)})


__all__ = ["ATTEMPT_SCHEMA", "CompleteFn", "answer_batch", "answers_to", "complete", "for_function", "offline_stub", "read_or_empty"]
