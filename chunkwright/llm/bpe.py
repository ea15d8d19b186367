"""Operator 9: byte-pair encoding and decoding by a prefix-sharing trie.

A known property of byte-pair encoding is used: the encoding of a prefix of a
word ends in one token, and the encoding of the prefix before that token is
the rest. So a trie node (a prefix) needs one state, its last token; the state
of a child is the longest-matching vocabulary token that ends there and is
compatible with the last token of the node where it starts. Two neighbouring
tokens are compatible when merging their bytes by rank leaves exactly these
two.

The distinct words of a batch are sorted, so going through them is a
depth-first walk of their trie: the states of the prefix shared with the word
before stay on the stack and are computed once. Only the lengths that tokens
with the same last ``SUFFIX`` bytes have are tried, the longest first.

Edge cases: a null or empty text has no tokens; the special token's string in
a text is that token, as in the library; very long texts and words are whole;
repeated rows are encoded alike; an empty table gives an empty result. Between
batches a bounded cache of word encodings is kept; when it is full, only the
words of the batch at hand stay.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 300_000
PAIRS = 500_000  # compatibility results kept
SUFFIX = 3  # bytes
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed: the vocabulary's pre-tokeniser


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file:
    printable Latin-1 bytes stand for themselves, the others follow U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in plain}, 0
    for b in range(256):
        if chr(b) not in out:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class Bpe:
    """Vocabulary, ranks and the encoder. path: a tokenizer file."""

    def __init__(self, path: str):
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        letters = {ord(c): b for c, b in _byte_letters().items()}
        raw = lambda s: s.translate(letters).encode("latin-1")
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for t, i in self.ids.items():
            self.bytes[i] = t
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        # merge (left, right) -> (rank, id), and how each token was made
        self.merge, self.halves = {}, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (pair if isinstance(pair, list) else pair.split(" "))
            a, b = raw(a), raw(b)
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.merge[left, right] = (rank, whole)
            self.halves.setdefault(whole, (left, right, rank))
        self.sizes = self._sizes()
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.pieces = regex.compile(PATTERN).findall
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, bytes] = {}

    def _sizes(self) -> dict[bytes, tuple[int, ...]]:
        """By the last bytes of a prefix (up to SUFFIX of them), the lengths of
        the tokens that can end there, longest first."""
        sizes: dict[bytes, set[int]] = {}
        for token in self.ids:
            sizes.setdefault(token[-SUFFIX:], set()).add(len(token))
        for end in sorted(sizes, key=len):
            if len(end) > 1:  # and those of the tokens inside the suffix
                sizes[end] |= next((sizes[end[i:]] for i in range(1, len(end)) if end[i:] in sizes), set())
        return {end: tuple(sorted(n, reverse=True)) for end, n in sizes.items()}

    def compatible(self, left: int, right: int) -> bool:
        """Does byte-pair merging of the two tokens' bytes give these two? The
        merges inside each are undone from the highest rank down; a merge that
        crosses the border and comes earlier than the next one undone would
        have happened instead."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        limit = 1 << 60  # rank of the merge undone last
        while True:
            cross = self.merge.get((a, b))
            if cross is not None and cross[0] < limit:
                return False
            ha, hb = self.halves.get(a), self.halves.get(b)
            if ha is None and hb is None:
                return True
            ra, rb = (ha[2] if ha else -1), (hb[2] if hb else -1)
            # at equal rank the left one is merged first, so it is undone last
            if ra > rb:
                a, limit = ha[1], ra
            else:
                b, limit = hb[0], rb
                # a crossing merge of the same rank lies to the left of b's own
                limit += 1

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Encodings of distinct words, by a depth-first walk of their trie."""
        ids, sizes, pairs, compatible = self.ids.get, self.sizes.get, self.pairs.get, self.compatible
        lengths = self.lengths.tolist()
        last: list[int] = [-1]  # last token of each prefix of the current path
        out, before = {}, b""
        for word in sorted(words):
            n, shared = len(word), 0
            limit = min(n, len(before))
            while shared < limit and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, n + 1):
                low = end - SUFFIX if end > SUFFIX else 0
                tried = sizes(word[low:end])
                while tried is None:
                    low += 1
                    tried = sizes(word[low:end])
                for size in tried:
                    start = end - size
                    if start < 0 or (token := ids(word[start:end])) is None:
                        continue
                    if start == 0:
                        break
                    left = last[start]
                    fits = pairs((left, token))
                    if fits or (fits is None and compatible(left, token)):
                        break
                last.append(token)
            tokens, at = [], n
            while at:
                t = last[at]
                tokens.append(t)
                at -= lengths[t]
            tokens.reverse()
            out[word], before = tokens, word
        return out

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids (uint32) of each text."""
        cache, split = self.cache, []
        for text in texts:
            parts = self.splitter.split(text) if self.splitter and any(s in text for s in self.special) else [text]
            split.append([p for i, part in enumerate(parts) for p in ([part] if i % 2 else self.pieces(part))])
        special = {s: np.uint32(i).tobytes() for s, i in self.special.items()}
        here = set().union(*split)
        new = here - cache.keys()
        if len(cache) + len(new) > CACHE_WORDS:
            kept = {p: cache[p] for p in here - new}
            cache.clear()
            cache.update(kept)
        new -= special.keys()
        for word, tokens in self.encode_words(p.encode() for p in new).items():
            cache[word.decode()] = array("I", tokens).tobytes()
        cache.update(special)
        return [np.frombuffer(b"".join(map(cache.__getitem__, pieces)), "<u4") for pieces in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of token ids; bytes that are no UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.flat[at].tobytes().decode("utf-8", "replace")


GROUP_CHARS = 2 << 20


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (list of int) and decoded text."""

    def run(batches):
        bpe = Bpe(path)
        for ids, tokens, decoded in _encoded(bpe, batches):
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids, "ids": pa.array([t.astype(np.int32) for t in tokens], pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string()),
            })

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>, decoded string")


def _encoded(bpe: Bpe, batches):
    for batch in batches:
        texts, row = batch.column(1).to_pylist(), 0
        while row < len(texts):
            upto, chars = row, 0
            while upto < len(texts) and (upto == row or chars + len(texts[upto] or "") <= GROUP_CHARS):
                chars += len(texts[upto] or "")
                upto += 1
            tokens = bpe.encode_texts([t or "" for t in texts[row:upto]])
            yield batch.column(0).slice(row, upto - row), tokens, [bpe.decode(t) for t in tokens]
            row = upto


def bpe_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256. The
    digests are taken where the ids are made, so no id list is written."""
    path = path or vocabulary_path()
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches):
        bpe = Bpe(path)
        for ids, tokens, decoded in _encoded(bpe, batches):
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids, "n_tokens": pa.array([len(t) for t in tokens], pa.int64()),
                "ids_sha256": [sha(t.tobytes()) for t in tokens], "decoded_sha256": [sha(t.encode()) for t in decoded],
            })

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
