"""Operator 2: language-model scores from a hidden Markov model of words.

Training documents give word counts (Spark aggregate over 64-bit word hashes).
Every word seen at least ``OWN`` times in training is a symbol of the hidden
Markov model, at every size, next to the end of text and one symbol for all
other words. A word below that is the other symbol times its share of that
symbol's base probability, so the model is a distribution over the same tokens
as the base model.

No task and not the driver holds the word tables: counts and emissions lie in
blocks by word hash. Texts are encoded once, in groups of about ``GROUP_BYTES``,
each with the sorted distinct words it needs of every block; counts are looked
up once (co-group by block), which gives base scores and leaves each group its
texts as symbols and the places of its symbols in the blocks. A Baum-Welch
round looks up the symbols' emissions (co-group by block), sums expected
emissions and transitions by group (forward-backward over segments; co-group by
group) and adds the sums to the blocks, streamed block by block. What a round
exchanges are emissions and sums as floats of 16 bits (8 of exponent), a float
of 32 bits for the scores. The driver holds starts, transitions and the
emissions of the two shared symbols. Every one of the ``ROUNDS`` rounds reads
all training documents. Scores use the scaled forward recursion over whole
texts.

Edge cases: null and empty texts are one end token; a null id counts as an
empty string in the split; repeated rows are scored alike and count in
training as often as they occur; without training rows every token has
probability 1 / 1 of the empty counts, (0 + 0.1) / (0 + 0.1).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import drop_stage, in_buckets, stage, stage_by
from chunkwright.llm.words import mix64, split_words, text_groups, word_groups

SMOOTH = 0.1
OWN = 2  # a word seen this often has emissions of its own
BLOCK_WORDS, GROUP_BYTES = 1 << 15, 8 << 20
SIDE_BY_SIDE = 1024  # groups that look up a block together
SPREAD = 256  # rows the shared sums are gathered in
STATES, SEGMENT, SLAB = 8, 128, 1024
ROUNDS = 4
PRIOR = 200.0  # strength of the base distribution in each state's emissions
LN10 = np.log(10.0)
CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",  # a round's shuffles are of no use after it
    # zstd works through a stream; snappy holds direct buffers as large as the largest page, outside the heap
    "spark.sql.parquet.compression.codec": "zstd",
}


def split_bucket(id_col: str = "doc_id") -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 10


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c): how often each lower-cased word occurs; partly summed in each batch."""

    def run(batches):
        for batch in batches:
            found = [np.unique(w.hash, return_counts=True) for _, _, w in word_groups(batch.column(0), lower=True)]
            if found:
                keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                c = np.bincount(back, weights=np.concatenate([n for _, n in found]), minlength=len(keys))
                yield pa.RecordBatch.from_pydict({"h": pa.array(keys.view(np.int64)), "c": pa.array(c.astype(np.int64))})

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What is known of all words together."""

    total: int  # N
    distinct: int  # V
    ends: int
    own: int  # words that are symbols, and how often they occur
    own_total: int

    @property
    def mass(self) -> float:
        return self.total + SMOOTH * (self.distinct + 1)

    @property
    def shared(self) -> np.ndarray:
        """Base probabilities of the other symbol and of the end."""
        end = (self.ends + SMOOTH) / self.mass
        own = (self.own_total + SMOOTH * self.own) / self.mass
        return np.array([max(1 - own - end, SMOOTH / self.mass), end])

    def p(self, c: np.ndarray) -> np.ndarray:
        return (c + SMOOTH) / self.mass


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    own = F.col("c") >= OWN
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    words, distinct, n, c = counts.agg(total("c"), F.count(F.lit(1)), F.count_if(own), total(F.when(own, F.col("c")))).first()
    return Vocabulary(int(words) + ends, int(distinct) + (ends > 0), ends, int(n), int(c))


def noise(h: np.ndarray, states: int) -> np.ndarray:
    """Normal numbers by word hash and state, the same in every task."""
    u = [(mix64(h[:, None] ^ mix64(np.arange(1, states + 1, dtype=np.uint64) * np.uint64(k))) >> np.uint64(11)) * 2.0**-53 for k in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)]
    return np.sqrt(-2 * np.log1p(-u[0])) * np.cos(2 * np.pi * u[1])


def _array(value: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def half(x: np.ndarray) -> np.ndarray:
    """Floats as the upper 16 bits of their 32-bit form, rounded to nearest."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32)
    return ((bits + np.uint32(0x7FFF) + ((bits >> np.uint32(16)) & np.uint32(1))) >> np.uint32(16)).astype(np.uint16)


def whole(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint32) << np.uint32(16)).view(np.float32)


def planes(x: np.ndarray) -> bytes:
    """32-bit integers byte by byte, which packs small ones well."""
    return np.ascontiguousarray(x.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplanes(value: pa.Scalar) -> np.ndarray:
    raw = _array(value, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<i4").reshape(-1)


def _rows(table: pa.Table, *names: str):
    return zip(*(table.column(n) for n in names))


@dataclass
class Hmm:
    start: np.ndarray  # K
    anywhere: np.ndarray  # K: state shares, for segments inside a text
    move: np.ndarray  # K x K
    emit: np.ndarray  # symbols x K

    @classmethod
    def fresh(cls, base: np.ndarray, states: int = STATES, seed: int = 1) -> Hmm:
        rng = np.random.default_rng(seed)
        emit = base[:, None] * np.exp(rng.normal(0, 0.7, (len(base), states)))
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9)
        even = np.full(states, 1 / states)
        return cls(even, even, move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def log10(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each whole sequence: the forward recursion over
        all of them side by side, longest first, scaled at every step."""
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        at, size = offsets[:-1][order], size[order]
        total = np.zeros(len(size))
        active = len(size) - np.searchsorted(size[::-1], np.arange(1, size[0] + 1 if len(size) else 1), "left")
        alpha = np.tile(self.start, (len(size), 1))
        for t, n in enumerate(active):
            if t:
                alpha = alpha[:n] @ self.move
            alpha = alpha[:n] * self.emit[symbols[at[:n] + t]]
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            total[:n] += np.log(scale)
        out = np.empty(len(size))
        out[order] = total / LN10
        return out

    def expected(self, symbols: np.ndarray, offsets: np.ndarray, sums: Sums) -> None:
        """Adds the expected counts of the sequences, cut into segments."""
        size = np.diff(offsets)
        pieces = -(-size // SEGMENT)
        text = np.repeat(np.arange(len(size)), pieces)
        part = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = offsets[text] + part * SEGMENT
        length = np.minimum(offsets[text + 1] - at, SEGMENT)
        order = np.argsort(length, kind="stable")
        for a in range(0, len(order), SLAB):
            rows = order[a : a + SLAB]
            self._slab(symbols, at[rows], length[rows], part[rows] == 0, sums)

    def _slab(self, symbols, at, length, first, sums: Sums) -> None:
        """length ascends, so the rows still running at step t are those from over[t] on."""
        steps, k = int(length.max()), len(self.start)
        over = np.searchsorted(length, np.arange(steps), "right")
        seen = symbols[np.minimum(at + np.arange(steps)[:, None], len(symbols) - 1)]
        emit = self.emit[seen]
        alpha, one = np.zeros((steps, len(at), k)), np.ones((k, 1))
        for t, lo in enumerate(over):
            now = alpha[t, lo:]
            if t:
                np.matmul(alpha[t - 1, lo:], self.move, out=now)
            else:
                now[:] = np.where(first[:, None], self.start, self.anywhere)
            now *= emit[t, lo:]
            scale = now @ one
            now /= scale
            emit[t, lo:] /= scale
        beta = np.ones((len(at), k))
        moves = np.zeros((k, k))
        for t in range(steps - 1, -1, -1):
            lo = over[t]
            back = emit[t, lo:] * beta[lo:]
            alpha[t, lo:] *= beta[lo:]  # now the shares of the states
            if t:
                moves += alpha[t - 1, lo:].T @ back
                beta[lo:] = back @ self.move.T
        sums.moves += moves * self.move
        sums.start += alpha[0][first].sum(0)
        flat, g = seen.ravel(), alpha.reshape(-1, k)
        for j in range(k):
            sums.emit[:, j] += np.bincount(flat, weights=g[:, j], minlength=len(self.emit))

    def updated(self, sums: Sums, base: np.ndarray) -> Hmm:
        """The next model from all expected counts, held in one place."""
        emit = sums.emit + PRIOR * base[:, None]
        move, start = sums.moves + 0.1, sums.start + 0.1
        share = sums.emit.sum(0) + 0.1
        return Hmm(start / start.sum(), share / share.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class Sums:
    """Expected counts."""

    def __init__(self, symbols: int, states: int):
        self.emit, self.moves, self.start = np.zeros((symbols, states)), np.zeros((states, states)), np.zeros(states)

    def shared(self) -> bytes:
        """What the driver needs: shares of the states, starts, transitions
        and the emissions of the first two symbols."""
        return np.concatenate((self.emit.sum(0), self.start, self.moves.ravel(), self.emit[:2].ravel())).tobytes()


def encoded(docs: DataFrame, blocks: int) -> DataFrame:
    """docs (doc_id, held_out, text) -> rows by group of texts: g, ids and
    held of its texts, sizes (tokens of each, with the end), symbols (0 is
    unused, 1 the end, then the group's distinct words by block and hash),
    first (of each block) and refs, the words' hashes by block."""

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in text_groups(batch.column(2), GROUP_BYTES):
                hashes, counts = [], []
                for _, _, part, own in text_groups(pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))):
                    w = split_words(part, own, lower=True)
                    hashes.append(w.hash)
                    counts.append(w.counts)
                h, sizes = np.concatenate(hashes), np.concatenate(counts)
                words, back = np.unique(h, return_inverse=True)
                block = words.view(np.int64) % blocks
                order = np.argsort(block, kind="stable")
                place = np.empty(len(words), np.int32)
                place[order] = np.arange(2, len(words) + 2)
                symbols = np.ones(len(h) + b - a, np.int32)
                symbols[np.arange(len(h)) + np.repeat(np.arange(b - a), sizes)] = place[back]
                words, first = words[order], np.searchsorted(block[order], np.arange(blocks + 1))
                refs = [{"p": i, "h": words[first[i] : first[i + 1]].tobytes()} for i in np.flatnonzero(np.diff(first))]
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                    "held": pa.array([batch.column(1).slice(a, b - a).to_pylist()], pa.list_(pa.bool_())),
                    "sizes": pa.array([(sizes + 1).astype(np.int64).tobytes()], pa.binary()), "symbols": pa.array([planes(symbols)], pa.binary()),
                    "first": pa.array([(first + 2).astype(np.int64).tobytes()], pa.binary()),
                    "refs": pa.array([refs], pa.list_(pa.struct([("p", pa.int32()), ("h", pa.binary())]))),
                })

    schema = "ids array<long>, held array<boolean>, sizes binary, symbols binary, first binary, refs array<struct<p: int, h: binary>>"
    return stage(docs.mapInArrow(run, schema).withColumn("g", F.monotonically_increasing_id()), "encoded")


TEXTS = "g long, ids array<long>, held array<boolean>, sizes binary, known binary, base binary, rest binary, symbols binary, own array<struct<p: int, at: binary>>"


def prepared(rows: DataFrame, blocks: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The groups with all that counts tell: known, base and rest of each text
    (tokens seen in training, base score, and the logarithm of what the words
    without emissions add to the other symbol), the texts as symbols (0 the
    other one, 1 the end, then the group's own symbols) and, by block, the
    places of those among the block's symbols."""
    log_other, log_end = np.log10(vocab.shared)

    def find(words: pa.Table, block: pa.Table) -> pa.Table:
        h, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if block.num_rows:
            h, c = _array(block.column("h")[0], np.uint64), _array(block.column("c")[0], np.int64)
        rank, out = np.where(c >= OWN, np.cumsum(c >= OWN) - 1, -1), []
        for own in words.column("h"):
            own = _array(own, np.uint64)
            count, at = np.zeros(len(own), np.int64), np.full(len(own), -1, np.int32)
            if len(h):
                i = np.minimum(np.searchsorted(h, own), len(h) - 1)
                found = h[i] == own
                count[found], at[found] = c[i[found]], rank[i[found]]
            out.append((count.tobytes(), at.tobytes()))
        return pa.table({"g": words.column("g"), "p": words.column("p"), **{n: pa.array([o[k] for o in out], pa.binary()) for k, n in enumerate(("c", "at"))}})

    def text(group: pa.Table, found: pa.Table) -> pa.Table:
        first, sizes = _array(group.column("first")[0], np.int64), _array(group.column("sizes")[0], np.int64)
        c, own = np.zeros(int(first[-1]), np.int64), np.full(int(first[-1]), -1, np.int32)
        for p, n, at in _rows(found, "p", "c", "at"):
            n = _array(n, np.int64)
            here = slice(first[p.as_py()], first[p.as_py()] + len(n))
            c[here], own[here] = n, _array(at, np.int32)
        logs = np.log10(vocab.p(c))
        c[1], logs[1], own[1] = vocab.ends, log_end, 0
        symbol = np.where(own >= 0, np.cumsum(own >= 0), 0).astype(np.int32)  # the end is 1
        seen, offsets = unplanes(group.column("symbols")[0]), np.concatenate(([0], np.cumsum(sizes)))[:-1]
        sums = lambda x: pa.array([np.add.reduceat(x[seen], offsets).tobytes()], pa.binary())
        block = np.searchsorted(first, np.arange(len(c)), "right") - 1
        mine = np.flatnonzero(own[2:] >= 0) + 2
        edges = np.searchsorted(block[mine], np.arange(len(first)))
        refs = [{"p": i, "at": own[mine[edges[i] : edges[i + 1]]].tobytes()} for i in np.flatnonzero(np.diff(edges))]
        return pa.table({
            "g": group.column("g"), "ids": group.column("ids"), "held": group.column("held"), "sizes": group.column("sizes"),
            "known": sums((c > 0).astype(np.int64)), "base": sums(logs), "rest": sums(np.where(symbol == 0, logs - log_other, 0.0)),
            "symbols": pa.array([planes(symbol[seen])], pa.binary()), "own": pa.array([refs], pa.list_(pa.struct([("p", pa.int32()), ("at", pa.binary())]))),
        })

    words = rows.select("g", F.explode("refs").alias("r")).select("g", "r.p", "r.h")
    found = words.groupBy("p").cogroup(blocks.groupBy("p")).applyInArrow(find, "g long, p int, c binary, at binary")
    texts = rows.drop("refs").groupBy("g").cogroup(found.groupBy("g")).applyInArrow(text, TEXTS)
    return in_buckets(texts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["g"], "texts")


def word_blocks(counts: DataFrame, blocks: int) -> DataFrame:
    """(p, h, c): the training words of each block by hash, and their counts."""

    def pack(rows: pa.Table) -> pa.Table:
        h = rows.column("h").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(h)
        return pa.table({"p": rows.column("p").slice(0, 1), "h": pa.array([h[order].tobytes()], pa.binary()), "c": pa.array([rows.column("c").to_numpy()[order].astype(np.int64).tobytes()], pa.binary())})

    rows = counts.select(F.pmod("h", F.lit(blocks)).cast("int").alias("p"), "h", "c")
    return stage(rows.groupBy("p").applyInArrow(pack, "p int, h binary, c binary"), "blocks")


@dataclass
class Model:
    """What the driver holds; ``words`` has the weights (p, w, ...) of the
    words' emissions, which are those divided by ``norm``."""

    start: np.ndarray
    anywhere: np.ndarray
    move: np.ndarray
    shared: np.ndarray  # 2 x K: emissions of the other symbol and of the end
    norm: np.ndarray
    words: DataFrame

    def local(self, emit: np.ndarray) -> Hmm:
        emit[:2] = self.shared
        return Hmm(self.start, self.anywhere, self.move, emit)


WEIGHTS = "p int, w binary, total binary, shared binary"


def _weights(p: int, w: np.ndarray | None, shared: np.ndarray | None = None) -> pa.Table:
    blobs = (w.astype(np.float32).tobytes(), w.sum(0).tobytes(), None) if w is not None else (None, None, shared.tobytes())
    return pa.table({"p": pa.array([p], pa.int32()), **{n: pa.array([b], pa.binary()) for n, b in zip(("w", "total", "shared"), blobs)}})


def _collected(words: DataFrame, states: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Of staged weights: their sums by state, and the shared sums."""
    total, shared = np.zeros(states), None
    for r in words.select("p", "total", "shared").orderBy("p").collect():
        if r.p < 0:
            shared = np.frombuffer(r.shared) + (0.0 if shared is None else shared)
        else:
            total += np.frombuffer(r.total)
    return total, shared


def fresh_model(blocks: DataFrame, vocab: Vocabulary, states: int = STATES) -> Model:
    def run(batches):
        for batch in batches:
            for p, h, c in _rows(pa.Table.from_batches([batch]), "p", "h", "c"):
                c = _array(c, np.int64)
                own = c >= OWN
                w = vocab.p(c[own])[:, None] * np.exp(0.7 * noise(_array(h, np.uint64)[own], states))
                yield from _weights(p.as_py(), w).to_batches()

    words = stage(blocks.mapInArrow(run, WEIGHTS), "weights")
    plain = Hmm.fresh(np.ones(1), states)
    shared = vocab.shared[:, None] * np.exp(0.7 * noise(np.arange(2, dtype=np.uint64), states))
    norm = _collected(words, states)[0] + shared.sum(0)
    return Model(plain.start, plain.anywhere, plain.move, shared / norm, norm, words)


def looked_up(refs: DataFrame, model: Model, exact: bool = False) -> DataFrame:
    """(g, p, e): the emissions of each group's symbols of each block. At most
    about SIDE_BY_SIDE groups read a block in one task: beyond that the groups
    are dealt in turns, each with the block's weights."""
    norm, states = model.norm, len(model.start)

    def run(rows: pa.Table, block: pa.Table) -> pa.Table:
        w = (_array(block.column("w")[0], np.float32).reshape(-1, states) / norm).astype(np.float32)
        e = [(w[_array(at, np.int32)] if exact else half(w[_array(at, np.int32)])).tobytes() for at in rows.column("at")]
        return pa.table({"g": rows.column("g"), "p": rows.column("p"), "e": pa.array(e, pa.binary())})

    words = model.words.where("p >= 0").select("p", "w")
    turns = refs.agg(F.count_distinct("g")).first()[0] // SIDE_BY_SIDE + 1
    if turns == 1:
        return refs.groupBy("p").cogroup(words.groupBy("p")).applyInArrow(run, "g long, p int, e binary")
    dealt = refs.withColumn("turn", F.pmod("g", F.lit(turns)).cast("int"))
    each = words.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    return dealt.groupBy("p", "turn").cogroup(each.groupBy("p", "turn")).applyInArrow(run, "g long, p int, e binary")


def _local(model: Model, group: pa.Table, found: pa.Table, exact: bool = False) -> tuple[Hmm, dict]:
    """The model of a group's symbols, and by block where they are and their
    places in the block."""
    own, size = {}, 2
    for r in group.column("own")[0]:
        at = _array(r["at"], np.int32)
        own[r["p"].as_py()] = slice(size, size + len(at)), at
        size += len(at)
    emit = np.zeros((size, len(model.start)))
    for p, e in _rows(found, "p", "e"):
        here, at = own[p.as_py()]
        emit[here] = (_array(e, np.float32) if exact else whole(_array(e, np.uint16))).reshape(len(at), -1)
    return model.local(emit), own


def next_model(texts: DataFrame, refs: DataFrame, blocks: DataFrame, model: Model, vocab: Vocabulary) -> Model:
    """One Baum-Welch round over all training texts."""
    states, head = len(model.start), Model(model.start, model.anywhere, model.move, model.shared, model.norm, None)

    def expect(group: pa.Table, found: pa.Table) -> pa.Table:
        sizes, train = _array(group.column("sizes")[0], np.int64), ~np.array(group.column("held")[0].as_py(), bool)
        local, own = _local(head, group, found)
        seen = unplanes(group.column("symbols")[0])[np.repeat(train, sizes)]
        sums = Sums(len(local.emit), states)
        if len(seen):
            local.expected(seen, np.concatenate(([0], np.cumsum(sizes[train]))), sums)
        spread = -1 - group.column("g")[0].as_py() % SPREAD
        parts = [(p, at.tobytes(), half(sums.emit[here]).tobytes()) for p, (here, at) in own.items()] + [(spread, None, sums.shared())]
        return pa.table({"p": pa.array([x[0] for x in parts], pa.int32()), "at": pa.array([x[1] for x in parts], pa.binary()), "s": pa.array([x[2] for x in parts], pa.binary())})

    def add(batches):
        """Streams the sums of one block (or of the shared symbols)."""
        key, base, shared, w = None, None, 0.0, np.zeros((0, states))
        for batch in batches:
            for p, at, s, c in zip(*(batch.column(n) for n in ("p", "at", "s", "c"))):
                key = p.as_py()
                if c.is_valid:
                    c = _array(c, np.int64)
                    base = PRIOR * vocab.p(c[c >= OWN])
                elif at.is_valid:
                    at = _array(at, np.int32)
                    if len(at) and at.max() >= len(w):
                        w = np.concatenate((w, np.zeros((at.max() + 1 - len(w), states))))
                    w[at] += whole(_array(s, np.uint16)).reshape(-1, states)
                else:
                    shared = shared + _array(s, np.float64)
        if key < 0:
            yield from _weights(key, None, shared).to_batches()
        else:
            out = np.repeat(base[:, None], states, 1)
            out[: len(w)] += w
            yield from _weights(key, out).to_batches()

    rows = texts.select("g", "held", "sizes", "symbols", "own")
    sums = rows.groupBy("g").cogroup(looked_up(refs, model).groupBy("g")).applyInArrow(expect, "p int, at binary, s binary")
    null = F.lit(None).cast("binary")
    parts = sums.withColumn("c", null).unionByName(blocks.select("p", null.alias("at"), null.alias("s"), "c"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from add(batches)

    words = stage(parts.groupBy("p").applyInArrow(summed, WEIGHTS), "weights")
    total, got = _collected(words, states)
    share, start, moves, shared = np.split(got, [states, 2 * states, 2 * states + states * states])
    shared = shared.reshape(2, states) + PRIOR * vocab.shared[:, None]
    move, norm = moves.reshape(states, states) + 0.1, total + shared.sum(0)
    start, share = start + 0.1, share + 0.1
    return Model(start / start.sum(), share / share.sum(), move / move.sum(1, keepdims=True), shared / norm, norm, words)


def score(texts: DataFrame, refs: DataFrame, model: Model, vocab: Vocabulary) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text."""
    head = Model(model.start, model.anywhere, model.move, model.shared, model.norm, None)

    def run(group: pa.Table, found: pa.Table) -> pa.Table:
        sizes = _array(group.column("sizes")[0], np.int64)
        local, _ = _local(head, group, found, True)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        return pa.table({
            "doc_id": group.column("ids")[0].values, "held_out": group.column("held")[0].values, "n_tokens": pa.array(sizes),
            "n_known": pa.array(_array(group.column("known")[0], np.int64)),
            "train_tokens": pa.array(np.full(len(sizes), vocab.total, np.int64)), "base_score": pa.array(_array(group.column("base")[0], np.float64)),
            "score": pa.array(local.log10(unplanes(group.column("symbols")[0]), offsets) + _array(group.column("rest")[0], np.float64)),
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("g").cogroup(looked_up(refs, model, True).groupBy("g")).applyInArrow(run, schema)


def score_digest(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    spark, bucket = docs.sparkSession, split_bucket()
    train_rows = docs.where(bucket != 0)
    ends = train_rows.count()
    counts = stage(word_counts(train_rows.select("text")), "words")
    vocab = vocabulary(counts, ends)
    n = max(1, -(-vocab.distinct // block_words))
    blocks = word_blocks(counts, n)
    before = {k: spark.conf.get(k) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        rows = encoded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (bucket == 0).alias("held_out"), "text"), n)
        texts = prepared(rows, blocks, vocab)
        drop_stage(rows)
        refs = stage_by(texts.select("g", F.explode("own").alias("r")).select("g", "r.p", "r.at"), "p", "refs")
        model = fresh_model(blocks, vocab)
        for _ in range(ROUNDS if ends else 0):
            last, model = model, next_model(texts, refs, blocks, model, vocab)
            drop_stage(last.words)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return score(texts, refs, model, vocab)
