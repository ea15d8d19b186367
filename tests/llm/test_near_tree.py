"""Every candidate pair of the n-gram join comes from a search of a count tree."""

import random

from chunkwright.llm import near
from chunkwright.llm.counttree import CountTree

WORDS = 120


def texts(seed=3):
    """Families of drifting copies, where each text differs from the one before
    by some words; and pairs of copies whose common words also stand in a long
    text, which leads all of their keys but links with neither."""
    rnd, rows = random.Random(seed), []
    for family in range(3):
        words = [f"f{family}w{i}" for i in range(WORDS)]
        for step in range(6):
            rows.append((family * 10 + step, " ".join(words)))
            at = rnd.randrange(WORDS - 12)
            words[at : at + 8] = [f"f{family}n{rnd.randrange(10**9)}" for _ in range(8)]
    for pair in range(3):
        common, more = ([f"{c}{pair}w{i}" for i in range(k)] for c, k in (("c", 100), ("m", 900)))
        own = [[f"p{pair}{c}{i}" for i in range(k)] for c, k in (("x", 8), ("y", 8), ("z", 400))]
        for i, words in enumerate((common + own[0], common + own[1], common + more, more + own[2])):
            rows.append((100 + pair * 10 + i, " ".join(words)))
    return rows


def plain(rows):
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
    return {i: find(i) for i in sets}


def classes(spark, rows):
    out = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: r.component_id for r in out}


def test_links_that_only_the_full_search_finds(spark, monkeypatch):
    rows, found, verified = texts(), [], near.verified

    def counted(pairs, sets, percent):
        out = verified(pairs, sets, percent)
        found.append(out.count())
        return out

    monkeypatch.setattr(near, "verified", counted)
    assert classes(spark, rows) == plain(rows)
    stars, rest = found
    assert stars > 0 and rest > 0


def test_without_the_full_search_links_are_lost(spark, monkeypatch):
    real = near.tree_pairs
    monkeypatch.setattr(near, "tree_pairs", lambda *args: real(*args).where("false"))
    rows = texts()
    assert classes(spark, rows) != plain(rows)


def test_no_tree_no_links(spark, monkeypatch):
    monkeypatch.setattr(near, "tree_hits", lambda tree, *args: tree.order[:0])
    rows = texts()
    assert classes(spark, rows) == {i: i for i, _ in rows}


def test_search_keeps_every_link():
    import numpy as np

    rng = np.random.default_rng(1)
    counts = rng.poisson(0.3, (300, near.GROUPS)).astype(np.int32)
    counts[100:200] = np.maximum(counts[:100] - (rng.random((100, near.GROUPS)) < 0.05), 0)
    n = counts.sum(1).astype(np.int64)
    tree = CountTree(counts, n)
    for i in range(0, 300, 7):
        most = np.minimum(counts, counts[i]).sum(1)
        want = np.flatnonzero(100 * most >= 75 * (n + n[i] - most))
        assert set(want) <= set(tree.search(counts[i], int(n[i]), 75))
