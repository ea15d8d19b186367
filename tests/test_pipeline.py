"""End to end with a completion function: rounds, retries, exactly-once."""

import json

import pandas as pd
from pyspark.sql import functions as F

from chunkwright import CommentParams, SummaryParams, annotate, build_document, summarize
from chunkwright.operators import completion as D4
from chunkwright.session import scratch_path


def _files(spark):
    data = [
        ("pkg/a.py", "alpha beta gamma delta " * 20),
        ("pkg/sub/b.py", "one two three"),
        ("c.py", ""),
        ("pkg/tiny.py", "x = 1"),
    ]
    return spark.createDataFrame(data, "rel_path string, text string")


def test_summarize_rounds_and_budget(spark):
    def flaky(batch: pd.DataFrame) -> pd.DataFrame:
        """First try: cut-off JSON; second: a valid answer naming the budget."""
        out = []
        for a, mt in zip(batch["attempt"], batch["max_tokens"]):
            out.append('{"Overall Summary": ["cut"]} and' if a == 1 else json.dumps({"Overall Summary": f"budget {mt}", "Classes": {"K": "v"}}))
        return pd.DataFrame({"response": out, "error": [None] * len(out)})

    path = scratch_path(spark, "t-attempts")
    run = summarize(_files(spark), complete=flaky, params=SummaryParams(chunk_chars=100), attempts_path=path)
    att = spark.read.parquet(path)
    # every asked chunk was tried exactly twice; the second try had +100 tokens
    tries = {(r.rel_path, r.chunk_no): r["n"] for r in att.groupBy("rel_path", "chunk_no").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(tries.values()) == {2}
    assert {r.max_tokens for r in att.where("attempt = 2").collect()} == {2100}
    wide = {r.rel_path: r for r in run.wide.collect()}
    assert wide["pkg/a.py"]["Overall Summary"] == "budget 2100"
    assert wide["c.py"]["Overall Summary"] == ""          # empty file: skeleton
    assert set(wide) == {"pkg/a.py", "pkg/sub/b.py", "c.py", "pkg/tiny.py"}
    # rerun over the same attempts path makes no new call
    n = att.count()
    summarize(_files(spark), complete=flaky, params=SummaryParams(chunk_chars=100), attempts_path=path)
    assert spark.read.parquet(path).count() == n
    arts = {r.rel_path: r for r in run.artifacts.collect()}
    assert arts["pkg/sub/b.py"].out_path == "pkg/sub/b.txt"
    assert json.loads(arts["pkg/a.py"].body)["Classes"] == {"K": "v"}


def test_annotate_with_stub_and_document(spark):
    run = annotate(_files(spark), complete=D4.offline_stub, params=CommentParams(chunk_chars=50))
    arts = {r.rel_path: r.body for r in run.artifacts.collect()}
    assert arts["c.py"] == "\n\n"                             # empty file
    assert arts["pkg/tiny.py"] == "x = 1\n\nx = 1"            # gated chunk answers itself
    assert arts["pkg/sub/b.py"].startswith('"""Documented part."""')
    frags = build_document(run.artifacts, "Doc").orderBy("sort_key").collect()
    assert frags[0].body.startswith("<!DOCTYPE html>") and frags[-1].body == "</body></html>\n"


def test_completion_batch_failure_becomes_errors(spark):
    def broken(batch):
        raise RuntimeError("down")

    req = spark.createDataFrame(
        [("r1", "f", 0, 1, "s", "p", "m", 10, 0.5)],
        "request_id string, rel_path string, chunk_no long, attempt long, system string, prompt string, model string, max_tokens int, temperature double",
    )
    r = D4.complete(req, broken).first()
    assert r.response is None and "down" in r.error


def _answers(spark, recs):
    """Attempts table giving answer recs[i] for chunk i of file 'm.py' (try 1)."""
    rows = [("m.py", i, 1, json.dumps(r), None) for i, r in enumerate(recs)]
    return spark.createDataFrame(rows, "rel_path string, chunk_no long, attempt long, response string, error string")


def test_strict_merge_and_keep_all_sections(spark):
    files = spark.createDataFrame([("m.py", "aaaa bbbb cccc dddd")], "rel_path string, text string")
    recs = [{"Classes": {"A": {"Description": "x"}}, "Variables": {"v": "1"}}, {"Variables": {"v": "2", "w": "3"}}]
    att = _answers(spark, recs)
    base = SummaryParams(chunk_chars=10, min_chunk_chars=1)
    loose = summarize(files, attempts=att, params=base)
    assert {(r.section, r.item, r.value) for r in loose.summaries.where("item is not null").collect()} == {
        ("Classes", "A", '{"Description":"x"}')}
    strict = summarize(files, attempts=att, params=base.with_(strict_merge=True))
    assert strict.summaries.count() == 0
    assert [(r.rel_path, r.reason) for r in strict.failed.collect()] == [("m.py", "nested_value")]
    allsec = summarize(files, attempts=att, params=base.with_(keep_all_sections=True))
    got = {(r.section, r.item, r.value) for r in allsec.summaries.where("section = 'Variables'").collect()}
    assert got == {("Variables", "v", "1"), ("Variables", "w", "3")}
    body = json.loads(allsec.artifacts.first().body)
    assert body["Variables"] == {"v": "1", "w": "3"} and len(body) == 12


def test_undecodable_files_are_quarantined(spark):
    from chunkwright.operators.audit import quarantine, summary_audit
    from chunkwright.sources.tree import decode_text

    raw = spark.createDataFrame([("ok.py", b"hello world here"), ("bad.py", b"\xff\xfe")], "rel_path string, content binary")
    files = decode_text(raw)
    run = summarize(files, attempts=_answers(spark, [{"Overall Summary": "hi"}]).replace("m.py", "ok.py"),
                    params=SummaryParams(chunk_chars=100))
    assert [r.rel_path for r in run.wide.collect()] == ["ok.py"]
    q = [(r.rel_path, r.stage, r.reason) for r in quarantine(summary_audit(files, run)).collect()]
    assert q == [("bad.py", "decode", "not_utf8")]


def test_user_tokenizer_udf(spark):
    from chunkwright.functions.tokens import token_count_udf
    from chunkwright.operators.chunking import with_budget

    count = token_count_udf(lambda: str.split)
    df = spark.createDataFrame([("f", "one two three four")], "rel_path string, text string")
    r = with_budget(df, 10, 100, tokenizer=count).first()
    assert r.n_tokens == 4 and r.chars_per_token == 18 / 4 * 0.75 and r.max_chars == int(10 * 18 / 4 * 0.75)


def test_annotate_missing_answer_fails_file(spark):
    files = spark.createDataFrame([("a.py", "line one\nline two\n"), ("b.py", "other text here\n")], "rel_path string, text string")
    att = spark.createDataFrame([("a.py", 0, 1, "doc", None)], "rel_path string, chunk_no long, attempt long, response string, error string")
    run = annotate(files, attempts=att, params=CommentParams(chunk_chars=100))
    assert [r.rel_path for r in run.artifacts.collect()] == ["a.py"]
    assert [(r.rel_path, r.reason) for r in run.failed.collect()] == [("b.py", "no_answer")]


def test_summarize_untried_chunk_fails_file(spark):
    files = spark.createDataFrame([("a.py", "some words here"), ("b.py", "other words here")], "rel_path string, text string")
    att = spark.createDataFrame([("a.py", 0, 1, '{"Overall Summary": "A"}', None)],
                                "rel_path string, chunk_no long, attempt long, response string, error string")
    run = summarize(files, attempts=att, params=SummaryParams(chunk_chars=100))
    assert [r.rel_path for r in run.wide.collect()] == ["a.py"]
    assert [(r.rel_path, r.reason) for r in run.failed.collect()] == [("b.py", "no_answer")]


def test_summary_artifact_body_format(spark):
    files = spark.createDataFrame([("one.py", "tiny file"), ("two.py", "aaaa bbbb cccc dddd")], "rel_path string, text string")
    rows = [("one.py", 0, 1, '{"Overall Summary": " café ", "Classes": {"A": {"b": [1, 2]}}, "Overall Summary": "last"}', None),
            ("two.py", 0, 1, '{"Overall Summary": "x", "Classes": {"K": "é"}}', None),
            ("two.py", 1, 1, '{"Data Inputs": "y"}', None)]
    att = spark.createDataFrame(rows, "rel_path string, chunk_no long, attempt long, response string, error string")
    run = summarize(files, attempts=att, params=SummaryParams(chunk_chars=10, min_chunk_chars=1))
    body = {r.rel_path: r.body for r in run.artifacts.collect()}
    assert body["one.py"] == json.dumps({"Overall Summary": "last", "Classes": {"A": {"b": [1, 2]}}}, indent=2)
    expected_two = {"Overall Summary": "x", "Module/Library Name": "", "Classes": {"K": "é"}, "Functions/Methods": {},
                    "Data Structures": "", "Interfaces/APIs": "", "Configuration/Environment Variables": {},
                    "Error Handling/Logging": "", "Data Inputs": "y", "Data Outputs": ""}
    assert body["two.py"] == json.dumps(expected_two, indent=2)


def test_artifact_tree_round_trip_and_document(spark):
    import os
    import tempfile

    from chunkwright import read_artifacts, save_document, write_tree

    run = annotate(_files(spark), complete=D4.offline_stub, params=CommentParams(chunk_chars=50))
    root = tempfile.mkdtemp(prefix="cw-art-")
    n, _ = write_tree(run.artifacts, root)
    back = {r.rel_path: r.body for r in read_artifacts(spark, root).collect()}
    assert len(back) == n and back == {r.rel_path: r.body for r in run.artifacts.collect()}
    out = tempfile.mkdtemp(prefix="cw-doc-") + "/doc"
    save_document(read_artifacts(spark, root), "Doc", out)
    page = "".join(open(os.path.join(out, p)).read() for p in sorted(os.listdir(out)) if p.startswith("part-"))
    assert page.count("<h3 id=") == n and page.index('id="c.py"') < page.index('id="pkg"')


def test_completion_wrong_length_becomes_errors(spark):
    def short(batch):
        return pd.DataFrame({"response": ["x"] * (len(batch) - 1)})

    req = spark.createDataFrame(
        [(f"r{i}", "f", i, 1, "s", "p", "m", 10, 0.5) for i in range(3)],
        "request_id string, rel_path string, chunk_no long, attempt long, system string, prompt string, model string, max_tokens int, temperature double",
    )
    rows = D4.complete(req, short, partitions=1).collect()
    assert len(rows) == 3 and all(r.response is None and "returned 2 rows" in r.error for r in rows)


def test_command_line(spark, capsys):
    import os
    import tempfile

    from chunkwright.__main__ import main

    root = tempfile.mkdtemp(prefix="cw-cli-src-")
    for rel, text in {"pkg/a.py": "def f():\n    return 1\n", "pkg/test_a.py": "x", "b.txt": "no"}.items():
        os.makedirs(os.path.dirname(os.path.join(root, rel)), exist_ok=True)
        open(os.path.join(root, rel), "w").write(text)
    out = tempfile.mkdtemp(prefix="cw-cli-out-")
    assert main(["summarize", root, out + "/s", "--complete", "stub"]) == 0
    assert os.listdir(out + "/s/pkg") == ["a.txt"]
    assert json.loads(open(out + "/s/pkg/a.txt").read())["Data Inputs"] == "4 words"
    assert main(["annotate", root, out + "/c", "--complete", "stub"]) == 0
    assert open(out + "/c/pkg/a.py").read().startswith('"""Documented part."""')
    assert main(["document", out + "/c", out + "/doc", "--title", "Commented code"]) == 0
    assert any(p.startswith("part-") for p in os.listdir(out + "/doc"))
    capsys.readouterr()


def test_annotate_audit(spark):
    from chunkwright.operators.audit import annotate_audit, quarantine
    from chunkwright.sources.tree import decode_text

    raw = spark.createDataFrame([("a.py", b"line one\n"), ("b.py", b"other text\n"), ("c.py", b"\xff"), ("d.txt", b"x")],
                                "rel_path string, content binary")
    files = decode_text(raw)
    att = spark.createDataFrame([("a.py", 0, 1, "doc", None), ("b.py", 0, 1, None, "e"), ("b.py", 0, 2, None, "e"), ("b.py", 0, 3, None, "e")],
                                "rel_path string, chunk_no long, attempt long, response string, error string")
    kept = files.where("file_name like '%.py'")
    run = annotate(kept, attempts=att, params=CommentParams(chunk_chars=100))
    q = sorted((r.rel_path, r.stage, r.reason) for r in quarantine(annotate_audit(files, run)).collect())
    assert q == [("b.py", "complete", "call_error"), ("c.py", "decode", "not_utf8")]


def test_changed_text_is_asked_again(spark, tmp_path):
    path = str(tmp_path / "attempts")
    run = lambda text: summarize(
        spark.createDataFrame([("a.py", text)], "rel_path string, text string"), params=SummaryParams(min_chunk_chars=0), attempts_path=path)
    told = lambda r: {x.section: x.value for x in r.summaries.collect()}["Overall Summary"]
    assert told(run("first text of the file")) == "first text of the file"
    assert told(run("another text now")) == "another text now"
    assert spark.read.parquet(path).count() == 2
    assert told(run("first text of the file")) == "first text of the file"
    assert spark.read.parquet(path).count() == 2


def test_poison_request_costs_only_its_file(spark):
    from chunkwright.operators.completion import offline_stub

    def fussy(batch):
        if batch["prompt"].str.contains("poison").any():
            raise ValueError("no")
        return offline_stub(batch)

    files = spark.createDataFrame([(f"f{i}.py", "poison here" if i == 1 else f"text number {i}") for i in range(6)], "rel_path string, text string").coalesce(1)
    run = summarize(files, complete=fussy, params=SummaryParams(min_chunk_chars=0), partitions=1)
    assert [r.rel_path for r in run.failed.collect()] == ["f1.py"]
    assert run.wide.count() == 5
