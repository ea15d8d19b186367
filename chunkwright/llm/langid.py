"""Operator 7: language identification with a bidirectional GRU over bytes.

A gated recurrent network reads the bytes of a word from both ends and labels
every byte position with language probabilities; a document's probabilities
are the mean over all positions of all its words. It is trained in numpy by
backpropagation through time (Adam). Words are the sequences (pieces of at
most ``MAX_BYTES`` bytes), so equal words of a batch are read once and texts
of any length need bounded memory.

Training uses a bounded sample: about ``PER_LANG`` labelled documents of each
language (at most ``MAX_LANGS`` languages, the most frequent), whole texts, and
of their distinct (piece of a word, language) pairs the ``MAX_WORDS`` of
smallest hash.
Held-out rows are never among them.

Edge cases: a null text or one without a letter is ``und`` with score 0; with
no labelled rows everything is ``und``; a null id counts as an empty string in
the split; rows with equal texts get equal labels; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import WORD
from chunkwright.llm.words import Words, word_groups

PER_LANG, MAX_LANGS, MAX_WORDS = 400, 256, 60_000
MAX_BYTES = 32
HIDDEN, STEPS, BATCH, RATE = 16, 700, 256, 0.01
CHUNK = 8192  # words read side by side
UNKNOWN = "und"


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Gru:
    """One direction. Gates: update z, reset r, candidate c (columns in this
    order); x is a byte, so its input weights are a row of ``wx``."""

    wx: np.ndarray  # 256 x 3H
    wh: np.ndarray  # H x 3H
    b: np.ndarray  # 3H

    @classmethod
    def fresh(cls, hidden: int, rng: np.random.Generator) -> Gru:
        f = np.float32
        return cls(rng.normal(0, 0.3, (256, 3 * hidden)).astype(f), rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(f), np.zeros(3 * hidden, f))

    def run(self, x: np.ndarray, live: np.ndarray, keep: bool = False):
        """x, live: steps x rows. Returns the states after each step (and what
        backward() needs). Where a row isn't live its state stays zero."""
        hid = self.wh.shape[0]
        h = np.zeros((x.shape[1], hid), np.float32)
        states, saved = np.empty((*x.shape, hid), np.float32), []
        for t in range(len(x)):
            a = self.wx[x[t]] + self.b
            g = h @ self.wh[:, : 2 * hid]
            zr = _sigmoid(a[:, : 2 * hid] + g)
            z, r = zr[:, :hid], zr[:, hid:]
            c = np.tanh(a[:, 2 * hid :] + (r * h) @ self.wh[:, 2 * hid :])
            m = live[t][:, None]
            new = (h + z * (c - h)) * m
            if keep:
                saved.append((h, z, r, c, m))
            states[t] = h = new
        return states, saved

    def backward(self, x: np.ndarray, saved: list, grads: np.ndarray) -> list[np.ndarray]:
        """Gradients of wx, wh, b from those of the states."""
        hid = self.wh.shape[0]
        dwx, dwh, db = np.zeros_like(self.wx), np.zeros_like(self.wh), np.zeros_like(self.b)
        carry = np.zeros(grads.shape[1:], np.float32)
        for t in range(len(x) - 1, -1, -1):
            h, z, r, c, m = saved[t]
            d = (grads[t] + carry) * m
            da_c = d * z * (1 - c * c)
            back = da_c @ self.wh[:, 2 * hid :].T
            da_z = d * (c - h) * z * (1 - z)
            da_r = back * h * r * (1 - r)
            da = np.concatenate((da_z, da_r, da_c), 1)
            dwh[:, : 2 * hid] += h.T @ da[:, : 2 * hid]
            dwh[:, 2 * hid :] += (r * h).T @ da_c
            db += da.sum(0)
            np.add.at(dwx, x[t], da)
            carry = d * (1 - z) + back * r + da[:, : 2 * hid] @ self.wh[:, : 2 * hid].T
        return [dwx, dwh, db]


@dataclass
class LanguageModel:
    langs: list[str]
    forward: Gru
    back: Gru
    wo: np.ndarray  # 2H x langs
    bo: np.ndarray

    def _logits(self, x: np.ndarray, live: np.ndarray, keep: bool = False):
        f, sf = self.forward.run(x, live, keep)
        b, sb = self.back.run(x[::-1], live[::-1], keep)
        both = np.concatenate((f, b[::-1]), 2)
        return both @ self.wo + self.bo, both, sf, sb

    def positions(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Language probabilities of every byte position."""
        logits = self._logits(x, live)[0]
        p = np.exp(logits - logits.max(2, keepdims=True))
        return p / p.sum(2, keepdims=True)

    def step(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        logits, both, sf, sb = self._logits(x, live, True)
        p = np.exp(logits - logits.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        p[:, np.arange(len(y)), y] -= 1
        d = p * (live[:, :, None] / max(live.sum(), 1))
        flat = both.reshape(-1, both.shape[2])
        dwo, dbo = flat.T @ d.reshape(-1, d.shape[2]), d.sum((0, 1))
        dboth = (d @ self.wo.T).astype(np.float32)
        hid = self.forward.wh.shape[0]
        gf = self.forward.backward(x, sf, dboth[:, :, :hid])
        gb = self.back.backward(x[::-1], sb, dboth[::-1, :, hid:])
        return [*gf, *gb, dwo, dbo]

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.wx, self.forward.wh, self.forward.b, self.back.wx, self.back.wh, self.back.b, self.wo, self.bo]

    def pooled(self, w: Words, n: int) -> np.ndarray:
        """Mean position probabilities of each of n texts (0 without words)."""
        k = len(self.langs)
        size = w.end - w.start
        pieces = -(-size // MAX_BYTES)
        word = np.repeat(np.arange(len(size)), pieces)
        part = np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = w.start[word] + part * MAX_BYTES
        length = np.minimum(w.end[word] - start, MAX_BYTES)
        # equal words are read once; a piece of a long word is read by itself
        whole = np.flatnonzero(pieces[word] == 1)
        _, rep, back = np.unique(w.hash[word[whole]], return_index=True, return_inverse=True)
        cut = np.flatnonzero(pieces[word] > 1)
        todo = np.concatenate((whole[rep], cut))
        sums = np.empty((len(todo), k), np.float32)
        by_length = np.argsort(length[todo], kind="stable")
        for a in range(0, len(todo), CHUNK):
            rows = by_length[a : a + CHUNK]
            x, live = _matrix(w.data, start[todo[rows]], length[todo[rows]])
            sums[rows] = (self.positions(x, live) * live[:, :, None]).sum(0)
        at = np.empty(len(word), np.int64)
        at[whole], at[cut] = back, len(rep) + np.arange(len(cut))
        doc = w.doc[word]
        total = np.bincount(doc, weights=length, minlength=n)
        out = np.stack([np.bincount(doc, weights=sums[at, j], minlength=n) for j in range(k)], 1)
        return out / np.maximum(total, 1)[:, None]


def _matrix(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps x rows) bytes and which of them are there."""
    steps = np.arange(int(length.max()) if len(length) else 0)[:, None]
    live = steps < length
    return data[np.where(live, start + steps, 0)] * live, live.astype(np.float32)


def train(words: list[bytes], labels: list[str], counts: list[int], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 1) -> LanguageModel:
    """Fit on (word, language, count) rows; frequent words are drawn more often."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    data = np.frombuffer(b"".join(words), np.uint8)
    length = np.array([len(w) for w in words], np.int64)
    start = np.cumsum(length) - length
    length = np.minimum(length, MAX_BYTES)
    y = np.searchsorted(langs, labels)
    share = np.array(counts, float) ** 0.75
    for j in range(len(langs)):
        share[y == j] /= share[y == j].sum()  # each language is drawn as often
    edges = np.cumsum(share / share.sum())
    f = np.float32
    model = LanguageModel(langs, Gru.fresh(hidden, rng), Gru.fresh(hidden, rng), rng.normal(0, 0.1, (2 * hidden, len(langs))).astype(f), np.zeros(len(langs), f))
    params = model.parameters()
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        rows = np.minimum(np.searchsorted(edges, rng.random(BATCH)), len(words) - 1)
        x, live = _matrix(data, start[rows], length[rows])
        rate = RATE * (1 - t / (steps + 1))
        for p, g, a, b in zip(params, model.step(x, live, y[rows]), m, v):
            g = np.clip(g, -1, 1)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)).astype(f)
    return model


def _pieces(word: Column) -> Column:
    """All pieces of at most MAX_BYTES bytes of a word, as ``pooled`` cuts it."""
    raw = F.encode(word, "UTF-8")
    last = F.floor((F.octet_length(word) - 1) / MAX_BYTES).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * MAX_BYTES + 1, F.lit(MAX_BYTES)))


def training_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[bytes, str, int]]:
    """(word, language, count) rows of the bounded sample: about PER_LANG
    documents a language, drawn by a hash of id and text, so that null or
    repeated ids are drawn like any others."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(~held_out("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    per = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS)
    pick = F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    some = rows.join(F.broadcast(per), "lang").where(pick < F.lit(float(PER_LANG)) / F.col("n"))
    words = some.select("lang", F.explode(F.flatten(F.transform(F.regexp_extract_all("text", F.lit(f"({WORD})")), _pieces))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    few = counts.orderBy(F.xxhash64("word", "lang"), "word", "lang").limit(MAX_WORDS).collect()
    return [(bytes(r.word), r.lang, r.n) for r in few]


def fit(docs: DataFrame, **columns: str) -> LanguageModel | None:
    rows = training_words(docs, **columns)
    return train(*map(list, zip(*rows))) if rows else None


def label(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""

    def run(batches):
        for batch in batches:
            for a, b, w in word_groups(batch.column(1), group_bytes=8 << 20):
                n = b - a
                letters = batch.column(3).slice(a, n).to_numpy(zero_copy_only=False)
                if model is None:
                    best, score = [UNKNOWN] * n, np.zeros(n)
                else:
                    p = model.pooled(w, n)
                    top = p.argmax(1)
                    best = [model.langs[j] if ok else UNKNOWN for j, ok in zip(top, letters)]
                    score = np.where(letters, np.clip(p[np.arange(n), top], 0, 1), 0.0)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(a, n), "held_out": batch.column(2).slice(a, n), "lang_pred": pa.array(best, pa.string()), "score": pa.array(score, pa.float64()),
                })

    letter = F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out(id_col).alias("held_out"), letter.alias("letter"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_digest(docs: DataFrame) -> DataFrame:
    return label(docs, fit(docs))
