"""The whole of op2 against a plain version: one process, one token at a time."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from chunkwright.llm import entries, hmm
from chunkwright.llm.words import word_groups
from tests.conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = None


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), END]


def hashes(words):
    """The hash of each word, as the encoder has it."""
    out = [w.hash for _, _, w in word_groups(pa.array(words))]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def short(x):
    """As rounds exchange the own symbols' emissions and sums: in 16 bits."""
    return np.concatenate((x[:2], hmm.whole(hmm.half(x[2:]))))


def plain_scores(docs, rounds, exchanged=lambda x: x):
    """{doc_id: (base score, score)} of (doc_id, text) rows."""
    texts = {i: tokens(t) for i, t in docs}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in train for w in t)
    total, k = sum(c.values()), hmm.STATES
    mass = total + 0.1 * (len(c) + 1)
    p = lambda w: (c[w] + 0.1) / mass
    own = [w for w in c if w is not END and c[w] >= hmm.OWN]
    other = 1 - sum(map(p, own)) - p(END)
    symbol = {END: 1} | {w: i + 2 for i, w in enumerate(own)}
    base = np.array([other, p(END), *map(p, own)])
    # first model: the base distribution, disturbed by word and state
    jitter = np.concatenate((hmm.noise(np.arange(2, dtype=np.uint64), k), hmm.noise(hashes(own), k)))
    emit = base[:, None] * np.exp(0.7 * jitter)
    emit /= emit.sum(0)
    start = anywhere = np.full(k, 1 / k)
    move = np.full((k, k), 0.1 / (k - 1))
    np.fill_diagonal(move, 0.9)
    move /= move.sum(1, keepdims=True)
    seen = {i: [symbol.get(w, 0) for w in t] for i, t in texts.items()}
    for _ in range(rounds):
        emit = exchanged(emit)
        e_sum, m_sum, s_sum = np.zeros_like(emit), np.zeros((k, k)), np.zeros(k)
        for i, all_symbols in seen.items():
            if zlib.crc32(str(i).encode()) % 10 == 0:
                continue
            for first in range(0, len(all_symbols), hmm.SEGMENT):
                s = all_symbols[first : first + hmm.SEGMENT]
                alpha, scale = [], []
                for t, x in enumerate(s):
                    a = ((start if first == 0 else anywhere) if t == 0 else alpha[-1] @ move) * emit[x]
                    scale.append(a.sum())
                    alpha.append(a / a.sum())
                beta = np.ones(k)
                for t in range(len(s) - 1, -1, -1):
                    gamma = alpha[t] * beta
                    e_sum[s[t]] += gamma
                    if t == 0:
                        s_sum += gamma if first == 0 else 0
                    else:
                        onward = emit[s[t]] * beta / scale[t]
                        m_sum += alpha[t - 1][:, None] * move * onward
                        beta = move @ onward
        share = e_sum.sum(0) + 0.1
        emit = exchanged(e_sum) + hmm.PRIOR * base[:, None]
        emit /= emit.sum(0)
        anywhere, start = share / share.sum(), (s_sum + 0.1) / (s_sum + 0.1).sum()
        move = (m_sum + 0.1) / (m_sum + 0.1).sum(1, keepdims=True)
    out = {}
    for i, t in texts.items():
        a, score = start, 0.0
        for n, (w, x) in enumerate(zip(t, seen[i])):
            a = (a if n == 0 else a @ move) * emit[x]
            score += math.log10(a.sum()) + (math.log10(p(w) / other) if x == 0 else 0)
            a = a / a.sum()
        out[i] = (sum(math.log10(p(w)) for w in t), score)
    return out


@pytest.mark.parametrize("rounds", [0, hmm.ROUNDS])
def test_query_equals_the_plain_version(spark, monkeypatch, rounds):
    monkeypatch.setattr(hmm, "ROUNDS", rounds)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_scores(docs, rounds, short)
    exact = plain_scores(docs, rounds) if rounds else want
    got = entries.queries()["op2_hmm_score"](spark, SF_SMALL).collect()
    assert len(got) == len(want)
    for r in got:
        base, score = want[r.doc_id]
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=1e-4), (r.doc_id, r.score, score)
        # what the 16 bits cost against rounds that exchange doubles
        assert math.isclose(r.score, exact[r.doc_id][1], rel_tol=5e-3)


def test_sixteen_bits_keep_three_digits():
    x = np.float32(10.0) ** np.random.default_rng(1).uniform(-30, 5, 5000).astype(np.float32)
    assert (np.abs(hmm.whole(hmm.half(x)) / x - 1) <= 2.0**-8).all()
    assert (hmm.unplanes(pa.scalar(hmm.planes(np.array([0, 1, 255, 256, 2**31 - 1])), pa.binary())) == [0, 1, 255, 256, 2**31 - 1]).all()


def test_many_groups_take_turns(spark, monkeypatch):
    """Groups beyond SIDE_BY_SIDE read a block in turns; scores stay."""
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 60}" for j in range(30))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    once = {r.doc_id: r.score for r in hmm.score_digest(docs).collect()}
    monkeypatch.setattr(hmm, "SIDE_BY_SIDE", 1)
    turns = {r.doc_id: r.score for r in hmm.score_digest(docs).collect()}
    assert all(math.isclose(once[i], turns[i], rel_tol=1e-6) for i in once)
