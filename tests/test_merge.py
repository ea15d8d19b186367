import json

from chunkwright.operators import merge as E
from tests.plain_rules import merge_records


def _records(spark, recs, n_chunks=None):
    n = n_chunks if n_chunks is not None else len(recs)
    data = [("f", i, n, json.dumps(r)) for i, r in enumerate(recs)]
    return spark.createDataFrame(data, "rel_path string, chunk_no long, n_chunks long, json_text string")


def test_text_fragment_dedupe(spark):
    recs = [{"Overall Summary": "a, c"}, {"Overall Summary": "b, a"}, {"Overall Summary": "d, "}]
    got = E.merge_text(E.record_entries(_records(spark, recs))).collect()
    assert [(r.section, r.value) for r in got] == [("Overall Summary", "a, c, b, d")]


def test_text_skips_none_like_and_non_strings(spark):
    recs = [{"Data Inputs": " N/A "}, {"Data Inputs": {"x": "y"}}, {"Data Inputs": "  real  "}, {"Data Inputs": "NONE"}]
    got = E.merge_text(E.record_entries(_records(spark, recs))).collect()
    assert [(r.section, r.value) for r in got] == [("Data Inputs", "real")]


def test_map_first_chunk_wins_and_nested_kept(spark):
    recs = [
        {"Classes": {"A": "n/a", "B": " first "}},
        {"Classes": {"A": "second", "B": "later", "C": {"Description": "x"}}},
    ]
    got = {(r.item): (r.item_no, r.value) for r in E.merge_maps(E.record_entries(_records(spark, recs))).collect()}
    assert got == {"B": (0, "first"), "A": (1, "second"), "C": (2, '{"Description":"x"}')}


def test_nested_strings_are_stripped_at_every_depth(spark):
    nested = {" name ": [" a ", "\t\\ b\u00a0", {"x": "\n", "y": [1, None, ' "q": " ']}], "long": "w \\n " * 20000}
    recs = [{"Classes": {"A": nested, "B": [" ", "\u000b c"], "C": 1}}, {"Classes": {"A": " later "}}]
    got = {r.item: r.value for r in E.merge_maps(E.record_entries(_records(spark, recs))).collect()}
    assert {k: json.loads(v) for k, v in got.items()} == {k: json.loads(v) for k, v in merge_records(recs)[1]["Classes"].items()}


def test_one_chunk_record_kept_as_is(spark):
    files = spark.createDataFrame([("f", 1)], "rel_path string, n_chunks long")
    recs = _records(spark, [{"Overall Summary": " x ", "Variables": {"v": " 1 "}}])
    got = sorted((r.section, r.item, r.value, r.branch) for r in E.file_summaries(files, recs).collect())
    assert got == [("Overall Summary", None, " x ", "single"), ("Variables", "v", " 1 ", "single")]


def test_empty_file_gets_skeleton(spark):
    files = spark.createDataFrame([("f", 0)], "rel_path string, n_chunks long")
    recs = spark.createDataFrame([], "rel_path string, chunk_no long, n_chunks long, json_text string")
    got = E.file_summaries(files, recs).collect()
    assert len(got) == 7 and all(r.value == "" and r.branch == "merged" for r in got)


def test_merge_is_order_and_partition_independent(spark):
    recs = [{"Overall Summary": f"s{i % 3}, t{i}", "Classes": {f"K{i % 4}": f"v{i}"}} for i in range(30)]
    df = _records(spark, recs)
    base_t = sorted(map(tuple, E.merge_text(E.record_entries(df)).collect()))
    base_m = sorted(map(tuple, E.merge_maps(E.record_entries(df)).collect()))
    shuffled = df.orderBy("json_text").repartition(7)
    assert sorted(map(tuple, E.merge_text(E.record_entries(shuffled)).collect())) == base_t
    assert sorted(map(tuple, E.merge_maps(E.record_entries(shuffled)).collect())) == base_m


def test_stitch_lines_like_splitlines(spark):
    answers = ["a\r\nb\n", "", "c\x0bd", "\n", "e"]
    df = spark.createDataFrame([("k", i, t) for i, t in enumerate(answers)], "k string, o long, t string")
    r = E.stitch_lines(df, "k", "o", "t").first()
    expected = [line for t in answers for line in t.splitlines()]
    assert r.stitched == "\n".join(expected) and r.n_lines == len(expected)
