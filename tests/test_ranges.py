"""Chunks cut from ranges equal the chunks of the whole text."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import chunking as C
from chunkwright.operators.ranges import chunk_ranges, next_starts, range_starts, range_steps, text_ranges, _steps
from chunkwright.session import stage
from chunkwright.sources import tree
from tests import plain_rules

ALPHABETS = ["ab \n", "abcdefgh ", "x", "é日 \n😀", "a\n"]


def texts(seed, n=60):
    rnd = random.Random(seed)
    for i in range(n):
        letters = rnd.choice(ALPHABETS)
        yield "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 5, 40, 300])))


@pytest.mark.parametrize("kind, rule", [("word", plain_rules.word_chunks), ("line", plain_rules.line_chunks)])
@pytest.mark.parametrize("chars, most", [(7, 5), (16, 30), (50, 11), (64, 1)])
def test_ranges_equal_whole_texts(spark, kind, rule, chars, most):
    rows = [(f"f{i}", t, most + i % 3) for i, t in enumerate(texts(chars))]
    df = stage(spark.createDataFrame([*rows, ("none", None, most)], "rel_path string, text string, max_chars long"), "texts")
    got = {}
    for r in chunk_ranges(text_ranges(df, chars), kind).collect():
        got.setdefault(r.rel_path, []).append((r.chunk_no, r.chunk_text, r.n_chunks))
    want = {p: [(i, c, len(cs)) for i, c in enumerate(cs)] for p, t, m in rows if (cs := rule(t, m))}
    assert {p: sorted(v) for p, v in got.items()} == want


def test_both_rules_are_monotone():
    rnd = random.Random(1)
    for _ in range(300):
        text, m = "".join(rnd.choice("ab \n") for _ in range(80)), rnd.randrange(1, 20)
        for kind in ("word", "line"):
            ends = next_starts(text[:60], text[60:], m, kind)
            assert (ends[1:] >= ends[:-1]).all()


def test_steps_are_few_and_hold_no_text(spark):
    """All entries of a long range of prose lead to a handful of exits."""
    rnd = random.Random(2)
    text = " ".join("w" * rnd.randrange(1, 9) for _ in range(40000))
    steps = range_steps(text[:100000], text[100000:], 5000, "word")
    assert 1 <= len(steps) < 500 and steps[0][0] == 0
    starts = range_starts(_steps(text_ranges(spark.createDataFrame([("f", text, 700)], "rel_path string, text string, max_chars long"), 4096), "word")).collect()
    assert len(starts) == -(-len(text) // 4096) and {r.n_chunks for r in starts} == {len(plain_rules.word_chunks(text, 700))}


def test_text_meets_its_starts_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("f", "some words " * 500, 50)], "rel_path string, text string, max_chars long")
        plan = chunk_ranges(text_ranges(df, 400))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "body" not in line
    assert plan.count("Exchange hashpartitioning(rel_path") == 2  # steps by file, starts by range


def test_file_ranges_equal_whole_files(spark):
    rnd = random.Random(5)
    root = tempfile.mkdtemp(prefix="cw-ranges-")
    pieces = ["a", "word ", "\r\n", "\r", "\n", "é", "日本", "😀", "  ", "﻿"]
    for i in range(40):
        with open(f"{root}/f{i}.py", "wb") as fh:
            fh.write("".join(rnd.choice(pieces) for _ in range(rnd.choice([0, 1, 30, 200]))).encode())
    with open(f"{root}/bad.py", "wb") as fh:
        fh.write(b"fine text first " * 10 + b"\xe2\x82" + b" and more text " * 10)
    os.symlink(f"{root}/nowhere", f"{root}/gone.py")
    whole = tree.decode_text(tree.scan_tree(spark, root, ".py")).select("rel_path", "text")
    want = sorted(map(tuple, C.chunk_words(whole.where("text IS NOT NULL"), 23).select("rel_path", "chunk_no", "n_chunks", "chunk_text").collect()))
    for range_bytes in (9, 64):
        ranges = stage(tree.scan_ranges(spark, root, 23, range_bytes, ".py"), "read")
        kept, lost = tree.sound_ranges(ranges)
        assert sorted(map(tuple, chunk_ranges(kept).collect())) == want
        assert {(r.rel_path, r.reason) for r in lost.collect()} == {("bad.py", "not_utf8"), ("gone.py", "io_error")}
    # each file's own size, from its head
    heads = tree.scan_heads(spark, root, 50, ".py")
    assert {(r.rel_path, r.text) for r in heads.where("rel_path not in ('bad.py')").collect()} == {
        (r.rel_path, r.text[:50]) for r in whole.where("text IS NOT NULL").collect()}
    sizes = heads.select("rel_path", (F.length("text") + 3).alias("max_chars"))
    kept, _ = tree.sound_ranges(tree.scan_ranges(spark, root, sizes, 32, ".py"))
    own = C.chunk_words(whole.where("text IS NOT NULL").join(sizes, "rel_path"), "max_chars").select("rel_path", "chunk_no", "n_chunks", "chunk_text")
    assert sorted(map(tuple, chunk_ranges(kept).collect())) == sorted(map(tuple, own.collect()))
