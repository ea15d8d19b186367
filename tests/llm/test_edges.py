"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
column names, for every operator and pipeline stage."""

import pytest

import corpus_pipeline
from chunkwright.llm import bpe, entries, exact, lines, mixing, near, quality, substrings
from chunkwright.llm.common import stage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(3000))
PASSAGE = " ".join(f"p{i % 40}x{i}" for i in range(60))
ROWS = [
    (1, None, "en", "a", 0), (2, "", None, None, 0), (3, " \n\t ", "en", "a", 4), (4, LONG, "en", "b", 9), (4, LONG, "en", "b", 9),
    (None, "Some words of a text without an id, more than ten of them in all here", "de", "b", 1),
    (5, f"before {PASSAGE} after", "en", "a", 1), (6, f"other words {PASSAGE}", "fr", None, 1), (7, "x" * 5000, "en", "c", 1),
    (8, "A line long enough to be one of the keys\nshort\nA line long enough to be one of the keys", "en", "c", 1),
    (9, "  a LINE long enough to be one of the keys\nown", "en", "c", None), (10, "a line long enough to be one of the keys", "en", "c", 1),
    (11, "one two three four", "en", "c", 1), (12, "ONE two three\nfour", "en", "c", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return stage(spark.createDataFrame(ROWS, SCHEMA), "edges")


DIGESTS = {name: digest for name, (digest, _) in entries._DIGESTS.items()}


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_odd_rows_and_empty_table(spark, docs, name):
    rows = DIGESTS[name](docs).collect()
    assert len(rows) == len(ROWS)
    assert DIGESTS[name](docs.where("doc_id = -1")).collect() == []


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_extra_columns_do_not_matter(spark, docs, name):
    extra = ["row", "key", "h", "n", "root", "size", "copies", "node", "tokens", "text_sha256", "_sha", "_key", "_size", "position", "rank"]
    more = docs.selectExpr("*", *[f"1 as {c}" for c in extra])
    a, b = DIGESTS[name](docs).drop("score").collect(), DIGESTS[name](more).drop("score").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


@pytest.mark.parametrize("name, stage_function", corpus_pipeline.STAGES[:-1])
def test_stages_keep_all_columns(spark, docs, name, stage_function):
    more = docs.selectExpr("*", "1 as _sha", "2 as _key", "3 as _size", "4 as _text_hash", "5 as _copy")
    out = stage_function(spark, more, "")
    assert out.columns == more.columns
    assert {(r.doc_id, r.text) for r in out.collect()} <= {(r[0], r[1]) for r in ROWS}
    assert stage_function(spark, more.where("doc_id = -1"), "").collect() == []


def test_pipeline_on_odd_rows(spark, docs):
    out = docs
    for _, f in corpus_pipeline.STAGES[:-1]:
        out = stage(f(spark, out, ""), "pipe")
    ids = [r.doc_id for r in out.collect()]
    assert 1 not in ids and 2 not in ids and 3 not in ids  # too few words
    assert ids.count(4) <= 2
    assert len(corpus_pipeline.encode(spark, out, "").collect()) == len(ids)


def test_defined_results(docs):
    kept = {(r.doc_id, r.keep_id): r for r in exact.duplicate_classes(docs).collect()}
    assert kept[1, 3].group_size == 3 and not kept[1, 3].kept  # null and blank are equal, the longest stays
    four = [r for r in exact.duplicate_classes(docs).collect() if r.doc_id == 4]
    assert sorted(r.kept for r in four) == [False, True]
    assert exact.drop_copies(docs).count() == len(ROWS) - 2 - 1  # blank ones and the repeated row; 11 and 12 differ in case
    line = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert (line[8].n_dropped, line[9].n_dropped, line[10].n_dropped) == (2, 1, 0)
    assert line[8].kept_text == "short" and line[1].kept_text == "" and line[1].n_lines == 1
    near_ids = {r.doc_id: r for r in near.near_classes(docs).collect()}
    assert near_ids[12].component_id == 11 and near_ids[11].n_shingles == 1 and near_ids[1].component_id == 1 and near_ids[2].component_id == 2
    cut = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert cut[5].kept_text == "before after" and cut[6].kept_text == "other words" and cut[4].kept_text == ""
    judged = {r.doc_id: r for r in quality.quality_digest(docs).collect()}
    assert judged[4].kept and judged[1].base_failed and judged[1].n_words == 0
    mixed = {r.doc_id: r for r in mixing.mix_digest(docs).collect()}
    assert mixed[1].taken == 0 and mixed[2].source_size == mixed[6].source_size
    codes = {r.doc_id: r for r in bpe.encode_documents(docs, bpe.vocabulary_path()).collect()}
    assert codes[1].ids == [] and codes[4].decoded == LONG


def test_rule_order_never_changes_the_verdict(docs):
    import pyarrow as pa

    from chunkwright.llm.words import word_groups

    column = pa.array([r[1] for r in ROWS])
    for _, n, w in word_groups(column):
        one = quality.cascade(w, n, list(quality.RULES)) < 0
        two = quality.cascade(w, n, list(reversed(quality.RULES))) < 0
        assert (one == two).all()


def test_bloom_filter_only_passes_more(docs):
    few = exact.duplicate_classes(docs, max_bits=3).collect()
    assert sorted(map(str, few)) == sorted(map(str, exact.duplicate_classes(docs).collect()))


def test_hot_near_group_links_without_all_pairs(spark):
    import random

    rnd = random.Random(4)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(k % 8):
            words[rnd.randrange(400)] = f"n{rnd.randrange(10**9)}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, " ".join(f"u{k}_{i}" for i in range(50))) for k in range(20)]
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r.doc_id: r.component_id for r in near.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: find(i) for i in sets}
