import json

import pytest

from chunkwright.functions.jsontext import json_incomplete, prose_incomplete
from chunkwright.operators import responses as D
from tests.plain_rules import json_incomplete as loop_incomplete


def _parse(spark, responses, errors=None):
    errors = errors or [None] * len(responses)
    data = [("f", 0, i + 1, r, e) for i, (r, e) in enumerate(zip(responses, errors))]
    df = spark.createDataFrame(data, "rel_path string, chunk_no long, attempt long, response string, error string")
    return D.parse_attempts(df).orderBy("attempt").collect()


@pytest.mark.parametrize("resp", ['{"a":1,}', "{'a':1}", '{"a":1} {"b":2}', '{"a":1},{"b":2}', "no json", "{}", "", '{"a": NaN}'])
def test_strict_decode_refusals_count_as_empty(spark, resp):
    assert _parse(spark, [resp])[0].status == "empty"


def test_duplicate_keys_last_wins(spark):
    from chunkwright.operators.merge import record_entries

    df = spark.createDataFrame([("f", 0, '{"Overall Summary":"1","Data Inputs":"3","Overall Summary":"2"}')],
                               "rel_path string, chunk_no long, json_text string")
    got = [(r.section, r.raw) for r in record_entries(df).orderBy("sec_pos").collect()]
    assert got == [("Overall Summary", "2"), ("Data Inputs", "3")]


def test_validation_order_and_quirks(spark):
    r = _parse(spark, [
        '{"Overall Summary": "x"}',               # one known key only: valid
        '{"Overall Summary": ""}',                # empty string: valid
        '{"Bogus": ["l"]}',                       # unknown key and list: bad_keys first
        '{"Classes": ["l"]}',                     # list value: bad_types
        'sure: {"Classes": {"A": {"b": 1}}} ok',  # nested object: valid
        '{"Variables": null}',                    # null: bad_types
    ])
    assert [x.status for x in r] == ["valid", "valid", "bad_keys", "bad_types", "valid", "bad_types"]


def test_error_rows(spark):
    r = _parse(spark, [None, '{"Overall Summary": "x"}'], [None, "timeout"])
    assert [x.status for x in r] == ["error", "error"]


@pytest.mark.parametrize("resp", ["", '{"a":1} \n', '{"a":{"b":1}', '{"a":"{"}', "  {\"a\": 1}  ", "x }", "{ }  {"])
def test_incomplete_json_matches_rule(spark, resp):
    df = spark.createDataFrame([(resp,)], "r string")
    assert df.select(json_incomplete("r")).first()[0] == loop_incomplete(resp)


def test_incomplete_prose(spark):
    df = spark.createDataFrame([("",), ("Done.",), ("Why?  ",), ("and then",), ("ok!",)], "r string")
    assert [r[0] for r in df.select(prose_incomplete("r")).collect()] == [False, False, False, True, False]


def _attempts(spark, rows):
    return spark.createDataFrame(rows, "rel_path string, chunk_no long, attempt long, response string, error string")


VALID = '{"Overall Summary": "x"}'


def test_summary_error_before_valid_fails_file(spark):
    a = _attempts(spark, [
        ("bad", 0, 1, None, "timeout"),
        ("fine", 0, 1, VALID, None), ("fine", 0, 2, None, "timeout"),
    ])
    failed = [r.rel_path for r in D.failed_files(D.parse_attempts(a)).collect()]
    assert failed == ["bad"]


def test_comment_mode_errors_use_tries(spark):
    a = _attempts(spark, [
        ("f", 0, 1, None, "e"), ("f", 0, 2, None, "e"), ("f", 0, 3, "  answer  ", None),
        ("g", 0, 1, None, "e"), ("g", 0, 2, None, "e"), ("g", 0, 3, None, "e"),
        ("h", 0, 1, None, None), ("h", 0, 2, "late", None),
    ])
    got = {r.rel_path: (r.win, r.comment, r.failed) for r in D.resolve_comments(a).collect()}
    assert got == {"f": (3, "answer", False), "g": (None, None, True), "h": (None, None, True)}


def test_budget_grows_only_on_parsed_incomplete_invalid(spark):
    a = _attempts(spark, [
        ("f", 0, 1, '{"Overall Summary": ["l"]} more', None),  # bad_types + incomplete: grow
        ("f", 0, 2, '{"Overall Summary": "trunc', None),        # does not parse: no growth
        ("f", 0, 3, '{"Bogus": "x"}', None),                    # bad_keys, complete: no growth
        ("f", 0, 4, VALID, None),
    ])
    got = [r.max_tokens for r in D.attempt_budget(D.parse_attempts(a)).orderBy("attempt").collect()]
    assert got == [2000, 2100, 2100, 2100]


def test_records_fallbacks(spark):
    chunks = spark.createDataFrame([("f", 0, True), ("f", 1, False), ("f", 2, False)], "rel_path string, chunk_no long, gated boolean")
    a = _attempts(spark, [("f", 1, 1, VALID, None), ("f", 2, 1, "nope", None)])
    got = {r.chunk_no: (r.origin, json.loads(r.json_text)) for r in D.resolved_records(chunks, D.parse_attempts(a)).collect()}
    assert got[0][0] == "gated" and len(got[0][1]) == 12
    assert got[1] == ("model", {"Overall Summary": "x"})
    assert got[2][0] == "exhausted" and list(got[2][1]) == ["Overall Summary", "Module/Library Name", "Classes", "Functions/Methods",
                                                          "Data Structures", "Interfaces/APIs", "Configuration/Environment Variables",
                                                          "Error Handling/Logging", "Data Inputs", "Data Outputs"]


def test_incomplete_json_random_against_rule(spark):
    import random

    rnd = random.Random(3)
    alphabet = ["{", "}", " ", "\n", "\t", "a", '"', ":", " ", "\x1c", ","]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, r string")
    got = {r.i: r.x for r in df.select("i", json_incomplete("r").alias("x")).collect()}
    assert all(got[i] == loop_incomplete(t) for i, t in enumerate(texts))


def test_pending_requests_edges(spark):
    req = spark.createDataFrame(
        [(f"r{c}", "f", c, "p", 2000) for c in range(5)], "request_id string, rel_path string, chunk_no long, prompt string, max_tokens int")
    cut = '{"Overall Summary": ["l"]} more'  # bad_types and incomplete: budget +100
    a = _attempts(spark, [
        ("f", 0, 1, VALID, None),                                   # resolved
        ("f", 1, 1, None, "timeout"),                               # fatal error
        *[("f", 2, k, "nope", None) for k in range(1, 6)],          # tries spent
        ("f", 3, 1, cut, None), ("f", 3, 2, cut, None),             # grows twice
        # chunk 4: never tried
    ])
    got = {r.chunk_no: (r.attempt, r.max_tokens) for r in D.pending_requests(req, D.parse_attempts(a)).collect()}
    assert got == {3: (3, 2200), 4: (1, 2000)}
