"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from chunkwright.llm import entries, periodic
from chunkwright.llm.common import stage
from chunkwright.llm.words import word_groups
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=12):
    out, seen = [], set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q) and (i, j) not in seen:
                n = j - i + q
                if not any(s == i and m == n for s, m, _ in out):
                    out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_words(i, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]


def plain_row(i, text):
    words = plain_words(i, text)
    runs = plain_runs(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def periodic_texts(count, seed):
    rnd = random.Random(seed)
    for _ in range(count):
        k = rnd.choice([1, 2, 3, 5, 20])
        unit = [f"w{rnd.randrange(k)}" for _ in range(rnd.randrange(1, 30))]
        yield " ".join(unit * rnd.randrange(1, 6) + [f"w{rnd.randrange(k)}" for _ in range(rnd.randrange(20))] + [f"u{rnd.randrange(10**6)}"] + unit[:3] * rnd.randrange(8))


def test_query_equals_plain_search(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    out = {r.doc_id: tuple(r)[1:] for r in entries.queries()["op13_periodic_runs"](spark, SF_SMALL).collect()}
    small = [r for r in table if len(r.text or "") < 9000]
    assert len(out) == len(table) and len(small) > 150
    assert {r.doc_id: out[r.doc_id] for r in small} == {r.doc_id: plain_row(r.doc_id, r.text) for r in small}
    assert sum(v[0] > 0 for v in out.values()) > 10


@pytest.mark.parametrize("seed", range(3))
def test_random_periodic_texts(seed):
    texts = list(periodic_texts(150, seed))
    for a, b, w in word_groups(pa.array(texts)):
        runs = periodic.text_runs(w)
        for i in range(a, b):
            assert [tuple(r[1:]) for r in runs[runs[:, 0] == i - a].tolist()] == plain_runs(texts[i].split())


def test_splitting_parts_the_text_and_loses_no_run():
    """A word seen once splits; what is left is counted anew until stable."""
    words = [f"u{i}" for i in range(50)] + ["a", "b", "c"] * 6 + ["x"] + ["a", "b"] * 3 + ["y"] + ["c"] * 14
    (_, _, w), = word_groups(pa.array([" ".join(words)]))
    number = np.unique(w.hash, return_inverse=True)[1]
    first, last = periodic.survivors(number, w.doc)
    assert list(zip(first.tolist(), last.tolist())) == [(50, 68), (76, 90)]
    assert [tuple(r) for r in periodic.text_runs(w).tolist()] == [(0, 50, 18, 3), (0, 76, 14, 1)]


def test_wrong_prefix_hashes_are_caught(monkeypatch):
    """With prefix hashes that call everything equal the segments are scanned plainly."""
    monkeypatch.setattr(periodic.Extender, "same", lambda self, a, lag, length: np.ones(len(a), bool))
    texts = list(periodic_texts(60, 9))
    for a, b, w in word_groups(pa.array(texts)):
        runs = periodic.text_runs(w)
        for i in range(a, b):
            assert [tuple(r[1:]) for r in runs[runs[:, 0] == i - a].tolist()] == plain_runs(texts[i].split())


def test_long_text_over_few_words():
    """No word is rare, so nothing splits: pairs of all lags, m log m of them."""
    rnd = random.Random(2)
    noise = [f"w{rnd.randrange(50)}" for _ in range(60000)]
    words = noise[:30000] + noise[:5000] * 4 + noise[30000:]
    (_, _, w), = word_groups(pa.array([" ".join(words)]))
    longest = max(periodic.text_runs(w).tolist(), key=lambda r: r[2])
    assert longest[3] == 5000 and longest[2] >= 20000 and longest[1] <= 30000


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a b " * 20), (4, "x " * 12), (4, "x " * 12), (5, "x " * 11), (42, "one two three four five six seven eight nine ten eleven twelve " * 300)]
    df = stage(spark.createDataFrame(rows, "doc_id long, text string"), "odd")
    clash = df.selectExpr("*", *[f"1 as {c}" for c in ("id", "h", "words", "runs", "top", "collapsed", "start", "length")])
    want = sorted(((i, *plain_row(i, t)) for i, t in rows), key=str)
    for table in (df, clash):
        assert sorted((tuple(r) for r in periodic.run_digest(table).collect()), key=str) == want
    assert periodic.run_digest(df.where("doc_id = -1")).collect() == []


def test_real_outputs(spark):
    df = spark.createDataFrame([(7, "start " + "do re mi " * 5 + "end")], "k int, body string")
    (r,) = periodic.find_runs(df, "k", "body").collect()
    assert (r.id, [tuple(x) for x in r.runs], r.collapsed) == (7, [(1, 15, 3)], "start do re mi end")
