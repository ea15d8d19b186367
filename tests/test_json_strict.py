"""Strict decode agrees with Python's json.loads on randomly mutated answers:
a text decodes exactly when json.loads returns a dict, and then the keys
(duplicates: last wins) and the string values agree. NaN/Infinity, which
Python accepts and the strict decode refuses on purpose, are left out."""

import json
import random

from pyspark.sql import functions as F

from chunkwright.functions.jsontext import strict_json_map

KEYS = ["Overall Summary", "Classes", "Data Inputs", "é", 'a"b', "x"]


def _value(rnd, depth=0):
    r = rnd.random()
    if depth < 2 and r < 0.2:
        return {rnd.choice(KEYS): _value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}
    if depth < 2 and r < 0.3:
        return [_value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    return rnd.choice(["text", "", " spaced ", "uni é ☃", 'quote " in', 1, -2.5, 1e300, 10**30, True, None])


def _mutate(rnd, s):
    m = rnd.randint(0, 14)
    if m == 0:
        return s[: rnd.randint(1, max(1, len(s) - 1))]          # truncated
    if m == 1:
        return s[:-1] + ",}"                                       # trailing comma
    if m == 2:
        return s.replace('"', "'")                                 # single quotes
    if m == 3:
        return s + " trailing words"
    if m == 4:
        return s + " " + s                                         # two objects
    if m == 5:
        return s[:-1] + (', "x": 1, "x": 2}' if len(s) > 2 else '"x": 1, "x": 2}')  # duplicate key
    if m == 6:
        return s.replace(":", ": /* c */", 1)                     # comment
    if m == 7:
        return s.replace('"text"', '"te\\u0001xt"').replace('"text"', '"te' + chr(1) + 'xt"')  # control chars
    if m == 8:
        return s.replace(": 1", ": 01", 1)                        # leading zero
    if m == 9:
        return s.replace('"', '', 2)                               # unquoted key
    if m == 10:
        return s.replace('"text"', '"t\\qx"')                     # bad escape
    if m == 11:
        return "\n  " + s.replace(", ", ",\n   ") + "\n"           # whitespace
    return s                                                        # unchanged


def test_strict_decode_matches_json_loads(spark):
    rnd = random.Random(5)
    texts = []
    for _ in range(1500):
        obj = {rnd.choice(KEYS): _value(rnd) for _ in range(rnd.randint(0, 4))}
        texts.append(_mutate(rnd, json.dumps(obj, ensure_ascii=rnd.random() < 0.5)))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r.m for r in df.select("i", F.to_json(strict_json_map(F.col("t"))).alias("m")).collect()}
    bad = []
    for i, t in enumerate(texts):
        try:
            want = json.loads(t)
            want = want if isinstance(want, dict) else None
        except ValueError:
            want = None
        have = None if got[i] is None else json.loads(got[i])
        if (want is None) != (have is None):
            bad.append((t, want, have))
        elif want is not None:
            if list(have) != list(want) and sorted(have) != sorted(want):
                bad.append((t, want, have))
            for k, v in want.items():
                if isinstance(v, str) and have.get(k) != v:
                    bad.append((t, want, have))
    assert not bad, bad[:5]
    decoded = sum(v is not None for v in got.values())
    assert 0.25 * len(texts) < decoded < 0.75 * len(texts)  # both outcomes well covered


def test_tails_that_close_a_wrap_are_refused(spark):
    good = ['{"a": "x"}', '{"a": 1, "a": 2}', '{"a": {"b": [1, "]"]}}']
    bad = ['{"a": "x"}] and then {b}', '[{"a": "x"}], [{"b": 1}]', '{"a": "x"}]', '{"a": "x"}}', '{"a": "x"}, "k": {"b": 1}', '{"a": "x"}, {"b": 1}', '{"a": "x"} tail']
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    got = {r.t: r.n for r in df.select("t", F.size(strict_json_map("t")).alias("n")).collect()}
    assert all((got[t] or -1) > 0 for t in good), got
    assert all((got[t] or -1) < 0 for t in bad), got
