"""Chunked byte-level encoding against the tiktoken library."""

import hashlib
import random

import numpy as np
import pytest

from chunkwright.llm import bytebpe, entries
from chunkwright.llm.common import stage
from tests.conftest import SF_SMALL

PARTS = ["a", "the", "'", "'re", "'ve", "s", " ", "  ", "\n", "é", "日", "1", "²", "-", "…", "\xa0", "zq", "ing", "\r\n\r\n", "😀", "٣", "ǅ", "\x1c", "\x85"]
ODD = ["", " ", "a<|endoftext|>b", "\n\n x   y\t\tz", "it's we'll 12345 ééé 日本語 😀😀", "a" * 3000, "=" * 400 + " " * 300 + "x", "\x00\x1f\x85\xa0 　 x", "ab" * 500, "x" + " " * 600 + "\n" * 200]


@pytest.fixture(scope="module")
def bpe():
    return bytebpe.ByteBpe(bytebpe.vocabulary_path())


@pytest.fixture(scope="module")
def library(bpe):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def texts(n, length, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(length))) for _ in range(n)]


def row(text, library):
    raw = (text or "").encode()
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest()


def test_query_equals_the_library(spark, library):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    out = {r.doc_id: tuple(r)[1:] for r in entries.queries()["op12_byte_bpe"](spark, SF_SMALL).collect()}
    assert out == {r.doc_id: row(r.text, library) for r in table}


@pytest.mark.parametrize("chunk, overlap", [(50, 20), (64, 8), (301, 47)])
def test_stitched_chunks_equal_the_library(spark, library, chunk, overlap):
    rows = list(enumerate([*ODD, *texts(150, 400, chunk)]))
    df = stage(spark.createDataFrame(rows, "doc_id long, text string"), "texts")
    out = {r.doc_id: tuple(r)[1:] for r in bytebpe.byte_digest(df, chunk=chunk, overlap=overlap).collect()}
    assert out == {i: row(t, library) for i, t in rows}


def test_chunks_are_stitched_inside_the_overlap(spark):
    """Chunks start inside words; entries move to the next common boundary,
    and a text whose overlap is one long word is not sound."""
    words = " ".join(f"word{i}" for i in range(400))
    rows = [(0, "prose", words), (1, "letters", "q" * 1500)]
    cut = bytebpe._cut(spark.createDataFrame(rows, "key long, id string, text string"), 100, 30)
    spans = bytebpe.stitched(stage(bytebpe._pretokenised(cut, 100, 30), "pieces"), 100).collect()
    prose = sorted((r.no, r.entry, r.leave) for r in spans if r.key == 0)
    assert len(prose) > 20 and all(r.sound == (r.key == 0) for r in spans)
    assert any(e > 0 for _, e, _ in prose)
    assert all(b[1] + 100 == a[2] for a, b in zip(prose, prose[1:]))


def test_pieces_and_merges_equal_the_library(bpe, library):
    import public_tokenizers
    import regex

    find = regex.compile(public_tokenizers.PATTERN).findall
    for text in [*ODD, *texts(1500, 60, 5)]:
        pieces = bpe.split.pieces(text)
        assert pieces == find(text)
        assert np.frombuffer(bpe.encode([pieces])[0], "<u4").tolist() == library.encode_ordinary(text)
    hard = sorted({p.encode() for t in [*ODD, *texts(300, 60, 6)] for p in find(t)} - bpe.ranks.keys())
    assert [x.tolist() for x in bpe.merge_all(hard)] == [bpe.merge_long(p).tolist() for p in hard]


def test_decoding_joins_bytes(bpe):
    """A token may end inside a character; bytes are joined, not texts."""
    raw = "日本é😀".encode()
    ids = np.array([bpe.ranks[bytes([b])] for b in raw], "<u4").tobytes()
    assert bpe.decode(ids) == raw and bpe.decode(ids[:4]) == raw[:1] and bpe.decode(b"") == b""


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "same"), (3, "same"), (4, "w " * 20000)]
    df = stage(spark.createDataFrame(rows, "doc_id long, text string"), "odd")
    clash = df.selectExpr("*", *[f"1 as {c}" for c in ("id", "ids", "key", "no", "body", "last")])
    for table in (df, clash):
        got = sorted((tuple(r) for r in bytebpe.byte_digest(table).collect()), key=str)
        assert got == sorted(((i, *row(t, library)) for i, t in rows), key=str)
    assert bytebpe.byte_digest(df.where("doc_id = -1")).collect() == []
