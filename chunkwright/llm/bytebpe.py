"""Operator 12: byte-level byte-pair encoding of overlapping chunks, and
decoding.

A text longer than a chunk and its overlap is cut into chunks of ``CHUNK``
characters, each followed by the first ``OVERLAP`` characters of the next, and
chunks are dealt over the cluster by (document, number). A task pre-tokenises
its chunks from their first character, which may lie inside a pre-token, and
reports the boundaries it finds in its head (the overlap that belongs to the
chunk before as well) and in its tail. A boundary is reported only if no text
after the chunk's end can move it (it lies at least ``MARGIN`` characters
before the end). Matching looks at nothing before its start, so from the first
boundary that the tail of one chunk and the head of the next have in common
both agree: that is where the two are stitched. Each chunk's pre-tokens from
its entry to its exit are then encoded, again in parallel, and a document's
ids are put together in chunk order. A document with an overlap without a
common boundary (one pre-token covers it) is encoded as one chunk, and so is a
text that fits in one.

Encoding a pre-token: if it is in the vocabulary, its id. Otherwise the
neighbouring parts whose bytes together have the lowest rank merge, the
leftmost of equal ones first, until none do. All new pre-tokens of a batch are
merged at once in numpy, one merge of each a round; those over ``WIDE`` bytes
by a heap. Decoding concatenates the tokens' raw bytes.

Edge cases: a null or empty text has no tokens; repeated rows and ids are
encoded alike, each by itself; very long texts and pre-tokens are whole; no
string is a special token; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkwright.llm.common import in_buckets

CHUNK = 1 << 14  # characters
OVERLAP = 512
MARGIN = 3  # the longest look ahead: a contraction of three characters
GROUP_CHARS = 2 << 20  # texts are encoded in groups of about this many
CACHE_PIECES = 300_000
WIDE = 64
NONE = np.int64(1) << 40  # above every rank


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Splitter:
    """The vocabulary's pre-token pattern. It asks of a character only whether
    it is a letter, a number, white space or none of them (and which ASCII
    character), so a text is matched as a string of the same length in which a
    character beyond U+00FF is replaced by one of its class."""

    def __init__(self):
        group = lambda c: "".join(re.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i))[0] == c)
        letter, number, space = group("L"), group("N"), "\\x09-\\x0D\\x20\\x85\\xA0"
        self.find = re.compile(f"'(?:[stmd]|re|ve|ll)| ?(?:[{letter}]+|[{number}]+|[^{space}{letter}{number}]+)|[{space}]+(?![^{space}])|[{space}]+").findall

        import regex

        kinds = [(regex.compile(p).match, c) for p, c in ((r"\p{L}", "\xaa"), (r"\p{N}", "\xb2"), (r"\s", "\xa0"), (r".|\n", "\xac"))]

        class Classes(dict):
            def __missing__(self, code):
                out = self[code] = chr(code) if code < 256 else next(c for match, c in kinds if match(chr(code)))
                return out

        self.classes = Classes()

    def lengths(self, text: str) -> list[int]:
        """Length of each match, in order; they cover the text."""
        return list(map(len, self.find(text if text.isascii() else text.translate(self.classes))))

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or max(text) <= "\xff":
            return self.find(text)
        return self.cut(text, self.lengths(text))

    @staticmethod
    def cut(text: str, lengths) -> list[str]:
        out, at = [], 0
        for n in lengths:
            out.append(text[at : at + n])
            at += n
        return out


class ByteBpe:
    """Ranks of a vocabulary file (base64 bytes and rank a line) and the
    encoder of pre-tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.split = Splitter()
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        get, pairs = self.ranks.get, {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.cache: dict[str, bytes] = {}

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of two tokens' joined bytes, NONE where they are no token."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge_all(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; a round does the first merge of every piece."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(pieces)
        tokens = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        of = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        rank = np.full(len(tokens), NONE)
        if len(tokens) > 1:
            same = of[:-1] == of[1:]
            rank[:-1] = np.where(same, self._pair(tokens[:-1], tokens[1:]), NONE)
        while len(tokens):
            start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            best = np.minimum.reduceat(rank << 22 | np.arange(len(rank)), start)
            least, at = best >> 22, best & ((1 << 22) - 1)
            open_ = least < NONE
            done = np.flatnonzero(~open_)
            ends = np.append(start[1:], len(tokens))
            ids = tokens.astype("<u4")
            for i, a, b in zip(of[start[done]].tolist(), start[done].tolist(), ends[done].tolist()):
                out[i] = ids[a:b]
            at, least = at[open_], least[open_]
            tokens[at] = least
            keep = np.repeat(open_, ends - start)
            keep[at + 1] = False
            spot = np.cumsum(keep)[at] - 1
            tokens, of, rank = tokens[keep], of[keep], rank[keep]
            for left in (spot[spot > 0] - 1, spot):  # the two pairs the new token is in
                right = np.minimum(left + 1, len(tokens) - 1)
                mates = (of[left] == of[right]) & (left < right)
                rank[left] = np.where(mates, self._pair(tokens[left], tokens[right]), NONE)
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: a heap of ranks over a linked list of parts."""
        get, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n - 1))
        live = [True] * n
        heap = []

        def offer(a: int) -> None:
            b = end[a]
            if b < n and (rank := get(piece[a : end[b]])) is not None:
                heapq.heappush(heap, (rank, a, end[b]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, a, stop = heapq.heappop(heap)
            if not live[a] or end[a] >= n or end[end[a]] != stop:
                continue
            live[end[a]] = False
            end[a] = stop
            if stop < n:
                before[stop] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        out, at = [], 0
        while at < n:
            out.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return np.array(out, "<u4")

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of texts given as pre-tokens."""
        cache = self.cache
        new = {p for pieces in texts for p in pieces if p not in cache}
        if len(cache) + len(new) > CACHE_PIECES:
            cache.clear()
            new = {p for pieces in texts for p in pieces}
        hard = []
        for p in new:
            raw = p.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                cache[p] = rank.to_bytes(4, "little")
            elif len(raw) > WIDE:
                cache[p] = self.merge_long(raw).tobytes()
            else:
                hard.append((p, raw))
        step = (1 << 22) // WIDE  # positions must fit in 22 bits
        for i in range(0, len(hard), step):
            part = hard[i : i + step]
            for (p, _), ids in zip(part, self.merge_all([raw for _, raw in part])):
                cache[p] = ids.tobytes()
        return [b"".join([cache[p] for p in pieces]) for pieces in texts]

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return b""
        sizes = self.sizes[tokens]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1]) + np.repeat(self.starts[tokens] - (ends - sizes), sizes)].tobytes()


def _grouped(sizes: list[int]):
    """(first, after the last) of runs of rows of about GROUP_CHARS in all."""
    row = 0
    while row < len(sizes):
        upto, total = row, 0
        while upto < len(sizes) and (upto == row or total + sizes[upto] <= GROUP_CHARS):
            total += sizes[upto]
            upto += 1
        yield row, upto
        row = upto


def _whole(texts: DataFrame, path: str) -> DataFrame:
    """(id, ids) of texts (id, text), each as one chunk."""

    def run(batches):
        bpe = ByteBpe(path)
        for batch in batches:
            column = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _grouped(list(map(len, column))):
                ids = bpe.encode([bpe.split.pieces(t) for t in column[a:b]])
                yield pa.RecordBatch.from_pydict({"id": batch.column(0).slice(a, b - a), "ids": pa.array(ids, pa.binary())})

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, ids binary")


def _cut(long_texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, no, id, last, body) of the chunks of texts (key, id, text)."""

    def run(batches):
        for batch in batches:
            for row, text in enumerate(batch.column(2)):
                text = text.as_py()
                n = max(1, -(-(len(text) - overlap) // chunk))
                for a in range(0, n, 64):
                    no = range(a, min(a + 64, n))
                    at = pa.array([row] * len(no))
                    yield pa.RecordBatch.from_pydict({
                        "key": batch.column(0).take(at), "no": pa.array(no, pa.int32()), "id": batch.column(1).take(at), "last": [i == n - 1 for i in no],
                        "body": [text[i * chunk : (i + 1) * chunk + overlap] if i < n - 1 else text[i * chunk :] for i in no],
                    })

    kind = long_texts.schema["id"].dataType.simpleString()
    return long_texts.mapInArrow(run, f"key long, no int, id {kind}, last boolean, body string")


def _pretokenised(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """chunks with the lengths of their pre-tokens (unsigned 32-bit) and the
    boundaries in head and tail, both counted from the head's start."""

    def run(batches):
        split = Splitter()
        for batch in batches:
            lengths, heads, tails = [], [], []
            for last, body in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                sizes = np.array(split.lengths(body), "<u4")
                ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
                lengths.append(sizes.tobytes())
                heads.append(ends[ends <= overlap - MARGIN])
                tails.append(ends[:0] if last else ends[(ends >= chunk) & (ends <= chunk + overlap - MARGIN)] - chunk)
            lists = {k: pa.array(v, pa.list_(pa.int32())) for k, v in (("head", heads), ("tail", tails))}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths, pa.binary()), *lists.values()], [*batch.schema.names, "lengths", *lists])

    kind = chunks.schema["id"].dataType.simpleString()
    return chunks.mapInArrow(run, f"key long, no int, id {kind}, last boolean, body string, lengths binary, head array<int>, tail array<int>")


def stitched(pieces: DataFrame, chunk: int) -> DataFrame:
    """(key, no, entry, leave, sound) for every chunk: its pre-tokens from
    entry to leave are the document's; sound is false for all chunks of a
    document in which two neighbours have no boundary in common."""
    order = Window.partitionBy("key").orderBy("no")
    narrow = pieces.select("key", "no", "head", "tail").withColumn("before", F.lag("tail").over(order))
    entry = F.when(F.col("no") == 0, 0).otherwise(F.array_min(F.array_intersect("head", "before")))
    spans = narrow.select("key", "no", entry.alias("entry"))
    sound = F.min(F.col("entry").isNotNull()).over(Window.partitionBy("key"))
    return spans.select("key", "no", "entry", (F.lead("entry").over(order) + chunk).alias("leave"), sound.alias("sound"))


def _encoded_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """(key, no, id, ids) of chunks (key, no, id, body, lengths, entry, leave)."""

    def run(batches):
        bpe = ByteBpe(path)
        for batch in batches:
            rows = []
            for body, raw, a, b in zip(*[batch.column(i).to_pylist() for i in range(3, 7)]):
                sizes = np.frombuffer(raw, "<u4")
                ends = np.cumsum(sizes, dtype=np.int64)
                b = len(body) if b is None else b
                mine = sizes[(ends > a) & (ends <= b)]
                rows.append(Splitter.cut(body[a:b], mine.tolist()))
            for a, b in _grouped([sum(map(len, r)) for r in rows]):
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(a, b - a) for i in range(3)], pa.array(bpe.encode(rows[a:b]), pa.binary())], ["key", "no", "id", "ids"])

    kind = chunks.schema["id"].dataType.simpleString()
    return chunks.select("key", "no", "id", "body", "lengths", "entry", "leave").mapInArrow(run, f"key long, no int, id {kind}, ids binary")


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: id, ids (binary, little-endian unsigned 32-bit)."""
    path = path or vocabulary_path()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.char_length("text") > chunk + overlap, F.lit(False))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = _cut(rows.where(is_long).select(F.monotonically_increasing_id().alias("key"), "id", "text"), chunk, overlap)
    pieces = in_buckets(_pretokenised(chunks.repartition(n, "key", "no"), chunk, overlap), n, ["key", "no"], "pretokens")
    spans = stitched(pieces, chunk)
    parts = _encoded_chunks(pieces.join(spans.where("sound"), ["key", "no"]), path)
    joined = parts.groupBy("key").agg(F.any_value("id").alias("id"), F.expr("listagg(ids, X'') within group (order by no)").alias("ids"))
    unsound = spans.where("not sound and no = 0").select("key")
    own = F.when(F.col("last"), F.col("body")).otherwise(F.substring("body", 1, chunk))
    again = pieces.join(unsound, "key", "left_semi").select("key", "no", "id", own.alias("body"))
    again = again.groupBy("key").agg(F.any_value("id").alias("id"), F.expr("listagg(body, '') within group (order by no)").alias("text"))
    return _whole(rows.where(~is_long).unionByName(again.select("id", "text")), path).unionByName(joined.select("id", "ids"))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded (id, ids) with the bytes the ids stand for, ``decoded``."""
    path = path or vocabulary_path()

    def run(batches):
        bpe = ByteBpe(path)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            for a, b in _grouped([len(i) for i in ids]):
                decoded = pa.array([bpe.decode(i) for i in ids[a:b]], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), decoded], ["id", "ids", "decoded"])

    return encoded.mapInArrow(run, f"id {encoded.schema['id'].dataType.simpleString()}, ids binary, decoded binary")


def byte_digest(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    encoded = encode_documents(docs.withColumn("doc_id", F.col("doc_id").cast("long")), path, chunk=chunk, overlap=overlap)
    return decode_documents(encoded, path).select(
        F.col("id").alias("doc_id"), F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
