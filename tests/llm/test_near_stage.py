"""One document of each group of near copies stays, with or without ids."""

from chunkwright.llm import near

BASE = [f"b{i}" for i in range(80)]


def _copy(group, k):
    words = [f"{group}{w}" for w in BASE]
    words[-1] = f"{group}end{k}"
    return " ".join(words)


def test_near_copies_without_ids_and_with_one_id_go(spark):
    rows = [(None, _copy("p", k)) for k in range(3)]  # no id at all
    rows += [(7, _copy("q", 0)), (None, _copy("q", 1)), (9, _copy("q", 2))]  # beside a named one
    rows += [(5, _copy("r", k)) for k in range(3)]  # different texts of one id
    rows += [(None, "a lonely text of some words without any copy"), (None, "and one more lonely text that is not like it"), (None, None), (None, None), (5, "")]
    out = near.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = [(r.doc_id, (r.text or "")[:1]) for r in out]
    assert [i for i, g in left if g == "p"] == [None]
    assert [i for i, g in left if g == "q"] == [7]
    assert [i for i, g in left if g == "r"] == [5]
    assert len(out) == 3 + 5  # rows without a copy all stay
