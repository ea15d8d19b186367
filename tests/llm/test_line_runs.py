"""The levelled sorted runs of line keys: what a batch finds in them."""

import random
from collections import defaultdict

import pytest

from chunkwright.llm import lines
from chunkwright.llm.common import stage


def key_rows(n_docs=60, seed=7):
    """(doc, text_hash, pos, h1, h2): one key in all documents, some in few."""
    rnd, rows = random.Random(seed), []
    for doc in range(n_docs):
        keys = [0, *(rnd.randrange(1, 40) for _ in range(4))]
        rows += [(doc, doc, pos, k, -k) for pos, k in enumerate(keys)]
    return rows


def plain(rows, min_docs):
    docs = defaultdict(set)
    for doc, _, _, k, _ in rows:
        docs[k].add(doc)
    return {k: max(d) for k, d in docs.items() if len(d) >= min_docs}


def found(spark, rows, min_docs, batches, fanout):
    table = stage(spark.createDataFrame(rows, "doc long, text_hash long, pos int, h1 long, h2 long"), "keys")
    return lines.repeated_keys(table, min_docs, batches, fanout)[0].collect()


@pytest.mark.parametrize("min_docs, batches, fanout", [(3, 1, 2), (2, 5, 2), (5, 7, 3)])
def test_runs_equal_one_grouping(spark, min_docs, batches, fanout):
    rows = key_rows()
    got = found(spark, rows, min_docs, batches, fanout)
    assert len(got) == len({r.h1 for r in got})
    assert {r.h1: r.keeper for r in got} == plain(rows, min_docs)


def test_anti_join_decides(spark, monkeypatch):
    """Without it a settled key settles again, with another keeper."""
    monkeypatch.setattr(lines.LineRuns, "unsettled", lambda self, batch: batch)
    got = found(spark, key_rows(), 3, 4, 2)
    assert len(got) > len({r.h1 for r in got})
    assert len({r.keeper for r in got if r.h1 == 0}) > 1


def test_settled_keys_enter_no_later_run(spark, monkeypatch):
    runs, written = [], lines.sorted_run

    def kept(df, name):
        out = written(df, name)
        if name == "lines-L0":
            runs.append([r.h1 for r in out.collect()])
        return out

    monkeypatch.setattr(lines, "sorted_run", kept)
    found(spark, key_rows(), 3, 4, 2)
    assert 0 in runs[0] and not any(0 in run for run in runs[1:])
    assert sum(map(len, runs[-2:])) < sum(map(len, runs[:2]))


def test_joins_with_runs_neither_shuffle_nor_sort(spark, monkeypatch):
    plans, written = [], lines.sorted_run

    def seen(df, name):
        if name != "batch":
            plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name)

    monkeypatch.setattr(lines, "sorted_run", seen)
    found(spark, key_rows(), 3, 4, 2)
    joined = [plan for _, plan in plans if "Join" in plan]
    assert len(joined) >= 4 and any(name != "lines-L0" for name, _ in plans)
    for plan in joined:
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan, plan


def test_no_lines(spark):
    assert found(spark, [], 3, 4, 2) == []
