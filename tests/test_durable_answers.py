"""Answers survive a lost job, rounds parse only their own answers, and the
audit tells why a file was not read."""

import json
import os
import tempfile
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chunkwright import CommentParams, SummaryParams, annotate, decode_text, scan_tree, summarize
from chunkwright.operators import responses as D
from chunkwright.operators.audit import annotate_audit, quarantine, summary_audit
from chunkwright.sources import answers as store


def _files(spark, n=12, text="words of file number {i}, "):
    return spark.createDataFrame([(f"d/f{i:02d}.py", text.format(i=i) * 3) for i in range(n)], "rel_path string, text string")


def _logged(folder, body=None):
    """A completion function that leaves one file a request it was asked."""

    def complete(batch: pd.DataFrame) -> pd.DataFrame:
        for r, a in zip(batch["request_id"], batch["attempt"]):
            open(f"{folder}/{r[:16]}-{a}-{time.monotonic_ns()}", "w").close()
        return body(batch) if body else pd.DataFrame({"response": [json.dumps({"Overall Summary": "fine"})] * len(batch)})

    return complete


def _calls(folder):
    return sorted(f.rsplit("-", 1)[0] for f in os.listdir(folder))


def test_a_killed_job_keeps_what_it_paid_for(spark, tmp_path):
    path, log = str(tmp_path / "answers"), tempfile.mkdtemp(prefix="cw-calls-")

    def dies(batch):
        if len(os.listdir(log)) >= 8:
            os._exit(1)  # the worker is gone, and the job with it
        return pd.DataFrame({"response": [json.dumps({"Overall Summary": "fine"})] * len(batch)})

    params = SummaryParams(chunk_chars=1000)
    options = {"params": params, "attempts_path": path, "partitions": 1, "batch_rows": 1, "publish_seconds": 0.0}
    with pytest.raises(Exception):
        summarize(_files(spark), complete=_logged(log, dies), **options)
    kept = {r.request_id[:16] for r in spark.read.parquet(path).collect()}
    assert len(kept) == 7 and not [f for f in os.listdir(path) if f.startswith("_round")]
    before = _calls(log)
    run = summarize(_files(spark), complete=_logged(log), **options)
    asked = {c.rsplit("-", 1)[0] for c in _calls(log)[0:]} - kept
    again = [c for c in _calls(log) if c not in before]
    assert len(asked) == 12 - 7 and not {c.rsplit("-", 1)[0] for c in again} & kept
    assert run.wide.count() == 12 and run.attempts.count() == 12
    told = [json.load(open(f"{path}/{f}")) for f in os.listdir(path) if f.startswith("_round")]
    assert [t["rows"] for t in told] == [5] and all(p.startswith(f"part-{told[0]['tag']}-000000-") for p in told[0]["parts"])


def test_a_task_that_runs_again_asks_only_the_rest(tmp_path, monkeypatch):
    """The writer of a second task attempt finds the parts of the first."""
    import pyarrow as pa

    asked = []

    def answer(b):
        asked.extend(b["request_id"])
        return pd.DataFrame({"request_id": b["request_id"], "rel_path": "f", "chunk_no": b["chunk_no"], "attempt": 1, "max_tokens": 10, "response": "r", "error": None})

    class Context:
        attempt = 0

        def partitionId(self):
            return 3

        def attemptNumber(self):
            return self.attempt

    context = Context()
    monkeypatch.setattr(store.TaskContext, "get", lambda: context)
    batches = [pa.RecordBatch.from_pydict({"request_id": [f"{i:064x}"], "chunk_no": [i]}) for i in range(6)]
    writer = store.AnswerWriter(str(tmp_path / "s"), "tag", answer, 1, 1, 0.0)

    def lost():
        yield from batches[:4]
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(lost())
    context.attempt = 1
    done = writer.write(iter(batches))
    assert (done.rows, done.found, len(done.parts)) == (2, 4, 6) and len(asked) == 6
    writer.commit([done, None])
    assert json.load(open(tmp_path / "s" / "_round-tag.json"))["rows"] == 6


def test_no_answer_is_parsed_twice(spark, monkeypatch, tmp_path):
    seen = []
    parse = D.parse_attempts

    def counted(attempts):
        seen.append(attempts.select("request_id", "attempt").collect())
        return parse(attempts)

    monkeypatch.setattr(D, "parse_attempts", counted)

    def slow(batch):
        cut = '{"Overall Summary": ["l"]} and'
        hard = batch["rel_path"].str.contains("f0[1-4]").values
        done = [json.dumps({"Overall Summary": f"try {a}"}) for a in batch["attempt"]]
        return pd.DataFrame({"response": [cut if h and a < 4 else d for h, a, d in zip(hard, batch["attempt"], done)]})

    path = str(tmp_path / "answers")
    run = summarize(_files(spark), complete=slow, params=SummaryParams(chunk_chars=1000), attempts_path=path)
    rows = [tuple(r) for part in seen for r in part]
    assert len(rows) == len(set(rows)) == run.attempts.count() == 12 + 3 * 4
    assert [len(part) for part in seen] == [12, 4, 4, 4]
    out = {r.rel_path: (r.tries, r.win, r.growth) for r in run.outcomes.collect()}
    assert out["d/f02.py"] == (4, 4, 3) and out["d/f07.py"] == (1, 1, 0)
    assert {r.max_tokens for r in run.attempts.where("attempt = 4").collect()} == {2300}
    # the same outcomes as one pass over all answers
    want = sorted(map(tuple, D.chunk_outcomes(parse(run.attempts), 5).drop("object_keys").collect()))
    assert sorted(map(tuple, run.outcomes.drop("object_keys").select("rel_path", "chunk_no", "tries", "win", "json_text", "first_error", "growth").collect())) == want
    # a run that resumes folds the stored answers once and asks nothing
    seen.clear()
    summarize(_files(spark), complete=slow, params=SummaryParams(chunk_chars=1000), attempts_path=path)
    assert [len(part) for part in seen] == [24]


def test_resumed_run_grows_on_from_where_it_was(spark, tmp_path):
    """Two rounds, then a run with more tries allowed: attempt numbers and
    budgets go on."""
    cut = lambda b: pd.DataFrame({"response": ['{"Overall Summary": ["l"]} and'] * len(b)})
    path = str(tmp_path / "answers")
    summarize(_files(spark, 3), complete=cut, params=SummaryParams(chunk_chars=1000, max_attempts=2), attempts_path=path)
    run = summarize(_files(spark, 3), complete=cut, params=SummaryParams(chunk_chars=1000, max_attempts=4), attempts_path=path)
    got = sorted({(r.attempt, r.max_tokens) for r in run.attempts.collect()})
    assert got == [(1, 2000), (2, 2100), (3, 2200), (4, 2300)] and run.attempts.count() == 12
    assert {(r.tries, r.growth) for r in run.outcomes.collect()} == {(4, 4)}
    assert {r.origin for r in run.records.collect()} == {"exhausted"}


def test_repeated_rows_change_no_outcome(spark):
    rows = [("f", 0, k, 2000 + 100 * (k - 1), '{"Overall Summary": ["l"]} more', None) for k in (1, 2)] + [("f", 0, 3, 2200, '{"Overall Summary": "x"}', None)]
    df = spark.createDataFrame(rows, "rel_path string, chunk_no long, attempt long, max_tokens int, response string, error string")
    once, twice = D.round_outcomes(df).collect(), D.round_outcomes(df.union(df)).collect()
    assert once == twice and (once[0].tries, once[0].win, once[0].growth, once[0].settled) == (3, 3, 2, True)


def test_comment_rounds_wait_as_planned(spark, tmp_path):
    """A failed call uses up a try; the function is told the planned waits."""
    log = tempfile.mkdtemp(prefix="cw-waits-")

    def limited(b):
        for a, lo, hi, n in zip(b["attempt"], b["min_wait_sec"], b["max_wait_sec"], b["n"]):
            open(f"{log}/{a}_{lo}_{hi}_{n}_{time.monotonic_ns()}", "w").close()
        return pd.DataFrame({"response": ["doc" if a == 3 else None for a in b["attempt"]], "error": [None if a == 3 else "rate limit" for a in b["attempt"]]})

    run = annotate(_files(spark, 2), complete=limited, params=CommentParams(chunk_chars=1000), attempts_path=str(tmp_path / "c"))
    assert {r.win for r in run.resolved.collect()} == {3} and run.artifacts.count() == 2
    assert {f.rsplit("_", 1)[0] for f in os.listdir(log)} == {"1_nan_nan_1", "2_0.5_1.5_1", "3_1.0_3.0_1"}


def test_ready_answers_count_for_their_request_only(spark):
    files = _files(spark, 2)
    ids = {r.rel_path: r.request_id for r in summarize(files, attempts=lambda c: spark.createDataFrame([], store.ATTEMPT_SCHEMA), params=SummaryParams(chunk_chars=1000)).requests.collect()}
    rows = [(ids["d/f00.py"], "d/f00.py", 0, 1, 10, '{"Overall Summary": "x"}', None), ("0" * 64, "d/f01.py", 0, 1, 10, '{"Overall Summary": "of an earlier text"}', None)]
    run = summarize(files, attempts=spark.createDataFrame(rows, store.ATTEMPT_SCHEMA), params=SummaryParams(chunk_chars=1000))
    assert [r.rel_path for r in run.wide.collect()] == ["d/f00.py"]
    assert [(r.rel_path, r.reason) for r in run.failed.collect()] == [("d/f01.py", "no_answer")]


def test_quarantine_tells_the_reasons_apart(spark):
    root = tempfile.mkdtemp(prefix="cw-typed-")
    open(f"{root}/fine.py", "w").write("some text of a file")
    open(f"{root}/bytes.py", "wb").write(b"\xff\xfe text")
    os.symlink(f"{root}/nowhere.py", f"{root}/gone.py")
    at = os.open(root, os.O_RDONLY)
    for _ in range(18):  # too long a path to be opened, for any user
        os.mkdir("d" * 250, dir_fd=at)
        below = os.open("d" * 250, os.O_RDONLY, dir_fd=at)
        os.close(at)
        at = below
    os.close(at)
    names = scan_tree(spark, root, list_only=True).selectExpr("rel_path", "substring_index(rel_path, '/', -1) AS file_name", "reason")
    files = decode_text(scan_tree(spark, root, ".py", "test"))
    for audit in (summary_audit(names, summarize(files)), annotate_audit(names, annotate(files))):
        rows = {(r.rel_path if "/" not in r.rel_path else "deep", r.stage, r.reason) for r in quarantine(audit).collect()}
        assert rows == {("bytes.py", "decode", "not_utf8"), ("gone.py", "scan", "io_error"), ("deep", "scan", "not_listed")}
        assert audit.where("stage = 'select' and status = 'skipped'").count() == 0
        assert audit.where("rel_path = 'fine.py' and stage = 'complete' and status = 'ok'").count() == 1
