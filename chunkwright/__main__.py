"""Command line: the three jobs over folders.

    python -m chunkwright summarize ROOT OUT --complete pkg.mod:fn [--model M]
    python -m chunkwright annotate  ROOT OUT --complete pkg.mod:fn
    python -m chunkwright document  ARTIFACTS OUT --title "Project summary"

`--complete` names a function taking a pandas DataFrame of requests and
returning `response` and `error` columns (see operators.completion);
`--complete stub` uses the offline stand-in. ROOT and ARTIFACTS are folders
every executor can read; OUT of summarize/annotate receives one artifact per
source file, OUT of document the ordered HTML part files.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import SparkSession


def _complete(name: str):
    from chunkwright.operators.completion import offline_stub

    if name == "stub":
        return offline_stub
    mod, _, fn = name.partition(":")
    return getattr(importlib.import_module(mod), fn)


def main(argv=None) -> int:
    from chunkwright import (CommentParams, SummaryParams, annotate, configure, decode_text, read_artifacts,
                             save_document, scan_tree, summarize, write_tree)
    from chunkwright.operators.audit import annotate_audit, run_report, summary_audit
    from chunkwright.sources.artifacts import artifact_paths

    ap = argparse.ArgumentParser(prog="python -m chunkwright")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for cmd in ("summarize", "annotate"):
        p = sub.add_parser(cmd)
        p.add_argument("root")
        p.add_argument("out")
        p.add_argument("--complete", required=True)
        p.add_argument("--model", default="chat-model")
        p.add_argument("--attempts-path", default=None, help="keep answers here to resume a run")
        p.add_argument("--listing", default="executors", choices=("driver", "executors"))
    p = sub.add_parser("document")
    p.add_argument("artifacts")
    p.add_argument("out")
    p.add_argument("--title", default="Project summary")
    p.add_argument("--no-escape", action="store_true")
    a = ap.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"chunkwright-{a.cmd}").getOrCreate())
    if a.cmd == "document":
        save_document(read_artifacts(spark, a.artifacts), a.title, a.out, escape=not a.no_escape, paths=artifact_paths(spark, a.artifacts))
        return 0
    # Names of every file for the audit; contents only of the files to work on
    # (the name filters run in the scan, so no other file is opened).
    all_files = scan_tree(spark, a.root, listing=a.listing, list_only=True).selectExpr(
        "rel_path", "substring_index(rel_path, '/', -1) AS file_name", "reason")
    files = decode_text(scan_tree(spark, a.root, ".py", "test", listing=a.listing))
    if a.cmd == "summarize":
        run = summarize(files, complete=_complete(a.complete), params=SummaryParams(model=a.model),
                        attempts_path=a.attempts_path)
        n, size = write_tree(run.artifacts, a.out)
        report = [r.asDict() for r in run_report(summary_audit(all_files, run)).collect()]
    else:
        run = annotate(files, complete=_complete(a.complete), params=CommentParams(model=a.model),
                       attempts_path=a.attempts_path)
        n, size = write_tree(run.artifacts, a.out)
        report = [r.asDict() for r in run_report(annotate_audit(all_files, run)).collect()]
    print(json.dumps({"artifacts": n, "bytes": size, "report": report}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
