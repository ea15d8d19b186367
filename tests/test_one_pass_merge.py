"""The summary plans: one join, two groupings, entries opened once; and the
merge against a plain fold over the records."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ENTRY
from chunkwright import params as P
from chunkwright.operators import merge as E
from tests import plain_rules
from tests.conftest import SF_SMALL


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name, exchanges", [("file_summaries", 4), ("summary_wide", 4), ("summary_artifacts", 4), ("merge_skips", 2)])
def test_one_join_and_few_exchanges(spark, no_broadcast, name, exchanges):
    df = ENTRY.queries()[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin", plan)) == 1
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan)) <= exchanges
    assert len(re.findall(r"FileScan parquet", plan)) == 2  # records, and of them those that lose a file


def _records(rnd, n):
    values = ["a, b", "b, c, a", " N/A ", "none", "", " x ,  y", "a", "z, "]
    out = []
    for c in range(n):
        rec = {}
        for s in rnd.sample(P.SECTIONS, rnd.randrange(1, 9)):
            if rnd.random() < 0.5:
                rec[s] = rnd.choice(values)
            else:
                rec[s] = {rnd.choice("klmn"): rnd.choice([*values, {"deep": " v "}, ["q "], 7, None]) for _ in range(rnd.randrange(4))}
        out.append((c, rec))
    return out


def _plain(records):
    """Sections of a many-chunk file, folded record by record."""
    texts, maps = {s: [] for s in P.TEXT_SECTIONS}, {s: {} for s in P.MAP_SECTIONS}
    for _, rec in records:
        for s, v in rec.items():
            if s in texts and isinstance(v, str) and v.strip().lower() not in P.NONE_LIKE:
                texts[s] += [f for f in v.strip().split(", ")]
            if s in maps and isinstance(v, dict):
                for k, x in v.items():
                    x = x.strip() if isinstance(x, str) else json.dumps(plain_rules.stripped(x), separators=(",", ":"))
                    if x.lower() not in P.NONE_LIKE:
                        maps[s].setdefault(k, x)
    return {s: ", ".join(dict.fromkeys(t)).rstrip(", ") for s, t in texts.items()}, maps


@pytest.mark.parametrize("seed", range(3))
def test_random_files_equal_a_plain_fold(spark, seed):
    rnd = random.Random(seed)
    files = {f"f{i}": _records(rnd, rnd.choice([1, 2, 5, 9])) for i in range(25)}
    rows = [(f, c, len(recs), json.dumps(rec), [k for k, v in rec.items() if isinstance(v, dict)]) for f, recs in files.items() for c, rec in recs]
    rows.append(("empty", None, 0, None, None))
    df = spark.createDataFrame(rows, "rel_path string, chunk_no long, n_chunks long, json_text string, object_keys array<string>").repartition(3)
    long = {}
    for r in E.long_summaries(df).collect():
        long.setdefault(r.rel_path, []).append(r)
    in_order = [F.map_entries(f"`{s}`").alias(s) if s in P.MAP_SECTIONS else f"`{s}`" for s in P.MERGED_SECTIONS]
    wide = {r.rel_path: r for r in E.wide_summaries(df, whole=True).select("rel_path", "branch", "whole", *in_order).collect()}
    assert set(wide) == {*files, "empty"}
    for f, recs in [*files.items(), ("empty", [])]:
        if len(recs) == 1:
            rec = recs[0][1]
            got = {(r.section, r.item): (r.item_no, r.value) for r in long.get(f, [])}
            want = {(s, None): (None, v) for s, v in rec.items() if isinstance(v, str)}
            for s, v in rec.items():
                if isinstance(v, dict):
                    want |= {(s, k): (i, x if isinstance(x, str) or x is None else json.dumps(x, separators=(",", ":"))) for i, (k, x) in enumerate(v.items())}
            assert got == want and json.loads(wide[f].whole) == rec and wide[f].branch == "single"
            continue
        texts, maps = _plain(recs)
        got = sorted((r.section, r.item or "", -1 if r.item_no is None else r.item_no, r.value) for r in long[f])
        want = [(s, "", -1, v) for s, v in texts.items()] + [(s, k, i, v) for s, m in maps.items() for i, (k, v) in enumerate(m.items())]
        assert got == sorted(want)
        assert wide[f].branch == "merged" and wide[f].whole is None
        assert all(wide[f][s] == v for s, v in texts.items()) and all([tuple(e) for e in wide[f][s]] == list(m.items()) for s, m in maps.items())


def test_validated_records_are_opened_once(spark):
    """Kinds come with the record: a key that is not among object_keys is text."""
    df = spark.createDataFrame([("f", 0, '{"Overall Summary": "{not an object}", "Classes": {"a": "b"}}', ["Classes"])],
                               "rel_path string, chunk_no long, json_text string, object_keys array<string>")
    assert [(r.section, r.kind) for r in E.record_entries(df).collect()] == [("Overall Summary", "STRING"), ("Classes", "OBJECT")]
    plan = E.record_entries(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" not in plan.lower() and plan.count("from_json") == 1


def test_strict_decode_keeps_record_order(spark):
    from chunkwright.functions.jsontext import strict_json_map

    df = spark.createDataFrame([('{"z": "1", "a": {"q": 1}, "m": "2"}',), ('{"a":1}],[{"b":2}',), ('{"a":1}}',)], "j string")
    assert [r[0] for r in df.select(F.map_keys(strict_json_map("j"))).collect()] == [["z", "a", "m"], None, None]
