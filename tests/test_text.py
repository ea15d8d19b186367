import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkwright.functions.paths import replace_extension
from chunkwright.functions.text import centre_sample, py_strip
from chunkwright.operators.chunking import chunk_lines, chunk_tokens, chunk_words
from tests.conftest import rows
from tests.plain_rules import line_chunks, word_chunks


def test_strip_matches_python_for_all_bmp_spaces(spark):
    cps = [c for c in range(0x3100) if not (0xD800 <= c <= 0xDFFF)]
    texts = [f"{chr(c)}a{chr(c)}b{chr(c)}" for c in cps]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(py_strip("t")).collect()]
    assert got == [t.strip() for t in texts]


def test_none_like_and_centre_sample(spark):
    df = spark.createDataFrame([("abcdefghij",), ("abc",)], "t string")
    got = [r[0] for r in df.select(centre_sample("t", 4)).collect()]
    # len 10: start = 10//2 - 4//2 = 3 -> "defg"; short text kept whole
    assert got == ["defg", "abc"]


@pytest.mark.parametrize(
    "path,expected",
    [("a.b/x.tar.py", "a.b/x.tar.txt"), ("a/.py", "a/.py.txt"), ("pkg/__init__.py", "pkg/__init__.txt"),
     ("a..py", "a..txt"), ("..py", "..py.txt"), ("x", "x.txt"), ("d.e/f", "d.e/f.txt")],
)
def test_replace_extension_like_splitext(spark, path, expected):
    import os

    assert os.path.splitext(path)[0] + ".txt" == expected
    assert spark.createDataFrame([(path,)], "p string").select(replace_extension("p", ".txt")).first()[0] == expected


def _chunks(spark, fn, text, m):
    df = spark.createDataFrame([("f", text)], "rel_path string, text string")
    return [r.chunk_text for r in fn(df, m).orderBy("chunk_no").collect()]


def test_word_chunk_edges(spark):
    assert _chunks(spark, chunk_words, "abc def", 4) == ["abc", " def"]
    assert _chunks(spark, chunk_words, "x" * 300, 100) == ["x" * 100] * 3
    assert _chunks(spark, chunk_words, "", 5) == []


def test_line_chunk_edges(spark):
    assert _chunks(spark, chunk_lines, "a\nbc\nd", 4) == ["a\n", "bc\nd"]


alphabet = st.sampled_from(list("ab \né\U0001F600x"))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=alphabet, max_size=120), min_size=1, max_size=8), st.integers(1, 30))
def test_chunkers_equal_plain_loops(spark, texts, m):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "rel_path string, text string")
    for fn, loop in ((chunk_words, word_chunks), (chunk_lines, line_chunks)):
        got = {}
        for r in fn(df, m).collect():
            got.setdefault(r.rel_path, []).append((r.chunk_no, r.chunk_text, r.n_chunks))
        for i, t in enumerate(texts):
            parts = [c for _, c, _ in sorted(got.get(str(i), []))]
            assert parts == loop(t, m)
            assert "".join(parts) == t
            assert all(0 < len(p) <= m for p in parts)
            assert all(n == len(parts) for _, _, n in got.get(str(i), []))


def test_chunkers_with_per_row_size(spark):
    rnd = random.Random(7)
    data = [(str(i), "".join(rnd.choice("ab \n") for _ in range(rnd.randint(0, 200))), rnd.randint(1, 40)) for i in range(40)]
    df = spark.createDataFrame(data, "rel_path string, text string, max_chars int")
    got = {}
    for r in chunk_words(df, "max_chars").collect():
        got.setdefault(r.rel_path, []).append((r.chunk_no, r.chunk_text))
    for k, t, m in data:
        assert [c for _, c in sorted(got.get(k, []))] == word_chunks(t, m)


def test_token_windows_rejoin(spark):
    df = spark.createDataFrame([("f", "Hello, world! 12 items\n  ok")], "rel_path string, text string")
    parts = [r.chunk_text for r in chunk_tokens(df, 2).orderBy("chunk_no").collect()]
    assert "".join(parts) == "Hello, world! 12 items\n  ok"
    assert len(parts) > 1


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab é1 2\n\t.,;!x")), max_size=80), min_size=1, max_size=6),
       st.integers(1, 7))
def test_token_windows_equal_plain_loop(spark, texts, n):
    import regex

    from chunkwright.functions.text import PRETOKEN_RE

    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "rel_path string, text string")
    got = {}
    for r in chunk_tokens(df, n).collect():
        got.setdefault(r.rel_path, []).append((r.chunk_no, r.chunk_text, r.n_chunks))
    for i, t in enumerate(texts):
        toks = regex.findall(PRETOKEN_RE, t)
        want = ["".join(toks[k:k + n]) for k in range(0, len(toks), n)]
        parts = sorted(got.get(str(i), []))
        assert [p for _, p, _ in parts] == want
        assert "".join(want) == t
        assert all(c == len(want) for _, _, c in parts)
