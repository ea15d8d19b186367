"""Every opN query against its DuckDB twin or a plain Python version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest

from chunkwright.llm import bpe, entries, hmm, sharding
from tests.conftest import SF_SMALL
from tools.oracle_check import digest

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{SF_SMALL}/documents.parquet')")
    got, want = entries.queries()[name](spark, SF_SMALL).toPandas(), con.sql(entries.oracle_sql()[name]).df()
    a, b = digest(got), digest(want)
    assert a[0] == b[0] and len(got) == len(want)
    assert a[2] == b[2], (sorted(set(a[1]) - set(b[1]))[:2], sorted(set(b[1]) - set(a[1]))[:2])


def test_hmm_base_scores_and_gain(spark, table):
    out = entries.queries()["op2_hmm_score"](spark, SF_SMALL).toPandas()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*re.findall(WORD, (t or "").translate(lower)), None] for i, t in zip(table.doc_id, table.text)}
    c = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, mass = sum(c.values()), sum(c.values()) + 0.1 * (len(c) + 1)
    for r in out.itertuples():
        ws = tokens[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), total)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / mass) for w in ws), rel_tol=1e-9)
    held = out[out.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_hmm_forward_equals_enumeration():
    """The scaled recursion gives the sum over all state paths."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    share = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(s))
    m = hmm.Hmm(share(2), share(2), share(2, 2), share(2, 4).T)
    seen, offsets = np.array([0, 3, 1, 2, 2, 0]), np.array([0, 4, 5, 6])
    got = m.log10(seen, offsets)
    for k in range(3):
        s = seen[offsets[k] : offsets[k + 1]]
        total = 0.0
        for path in itertools.product(range(2), repeat=len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= m.move[path[t - 1], path[t]] * m.emit[s[t], path[t]]
            total += p
        assert math.isclose(got[k], math.log10(total), rel_tol=1e-9)


def test_baum_welch_raises_the_likelihood():
    import numpy as np

    rng = np.random.default_rng(5)
    seen = np.concatenate([rng.integers(0, 3, 300) + 3 * (i % 2) for i in range(20)])
    offsets = np.arange(0, 6001, 300)
    base = np.full(6, 1 / 6)
    m, last = hmm.Hmm.fresh(base, 2), -np.inf
    for _ in range(6):
        sums = hmm.Sums(6, 2)
        m.expected(seen, offsets, sums)
        assert math.isclose(sums.emit.sum(), len(seen))
        m = m.updated(sums, base)
        now = m.log10(seen, offsets).sum()
        assert now > last - 1
        last = now
    assert last > len(seen) * math.log10(1 / 6) * 0.75


def test_language_accuracy_on_held_out_rows(spark, table):
    out = entries.queries()["op7_language_id"](spark, SF_SMALL).toPandas().merge(table[["doc_id", "lang"]], on="doc_id")
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and len(out) == len(table)
    held = out[out.held_out & out.lang.notna()]
    assert (held.lang == held.lang_pred).mean() > 0.9


def test_gru_gradients():
    """Backpropagation through time against finite differences."""
    import numpy as np

    from chunkwright.llm.langid import Gru, LanguageModel

    rng = np.random.default_rng(2)
    m = LanguageModel(["a", "b"], Gru.fresh(3, rng), Gru.fresh(3, rng), rng.normal(0, 1, (6, 2)), np.zeros(2))
    for g in (m.forward, m.back):
        g.wx, g.wh, g.b = g.wx.astype(float), g.wh.astype(float), g.b.astype(float)
    x = rng.integers(0, 4, (5, 3)).astype(np.uint8)
    live = (np.arange(5)[:, None] < np.array([5, 3, 1])).astype(np.float32)
    y = np.array([0, 1, 1])
    loss = lambda: -(np.log(m.positions(x, live)[:, np.arange(3), y]) * live).sum() / live.sum()
    for p, g in zip(m.parameters(), m.step(x, live, y)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        h, old = 1e-2, p[at]
        p[at] = old + h
        up = loss()
        p[at] = old - h
        down = loss()
        p[at] = old
        assert math.isclose((up - down) / (2 * h), g[at], rel_tol=0.03, abs_tol=1e-4)


def test_bpe_equals_the_library(spark, table):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path())
    library.no_truncation()
    library.no_padding()
    out = entries.queries()["op9_bpe_codec"](spark, SF_SMALL).toPandas().set_index("doc_id")
    import numpy as np

    for i, text in zip(table.doc_id, table.text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert out.n_tokens[i] == len(ids)
        assert out.ids_sha256[i] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out.decoded_sha256[i] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_texts():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(bpe.vocabulary_path()), bpe.Bpe(bpe.vocabulary_path())
    texts = ["", " ", "a<|endoftext|>b  <|endoftext|>", "\n\n x   y\t\tz", "it's 12345 ééé 日本語 😀😀", "a" * 3000, "=" * 400 + " " * 300 + "x", "\x00\x1f\x85\xa0"]
    for text, ids in zip(texts, own.encode_texts(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_shards_are_the_permutation(spark, table):
    out = entries.queries()["op10_feistel_shards"](spark, SF_SMALL).toPandas().sort_values("doc_id")
    n = len(table)
    a, b = sharding.grid(n)

    def mixed(v, k):
        t = (v & sharding.MASK) ^ k
        t = (t * 1103515245 + 12345) & sharding.MASK
        t ^= t >> 15
        t = (t * 1812433253 + 1) & sharding.MASK
        return t ^ (t >> 13)

    def once(x):
        left, right = divmod(x, b)
        for i, k in enumerate(sharding.KEYS):
            if i % 2:
                right = (right + mixed(left, k)) % b
            else:
                left = (left + mixed(right, k)) % a
        return left * b + right

    for i, r in enumerate(out.itertuples()):
        p = once(i)
        while p >= n:
            p = once(p)
        assert (r.shard, r.slot) == (p % 16, p // 16)
    texts = dict(zip(table.doc_id, table.text))
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) and r.size == len((texts[r.doc_id] or "").encode()) + 1 for r in out.itertuples())
    sizes = out.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and len(sizes) == 16
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
