"""Operator 6: quality rules as a short-circuit cascade.

Every rule has the features it needs. Cost (seconds a row) and selectivity
(share rejected) of each rule are measured on a bounded sample; rules are then
ordered by rejection per cost, and each rule sees only the rows that all rules
before it let pass. Order decides the work, never the verdict: a row is kept
if no rule rejects it.

The sample is about ``SAMPLE`` rows drawn over the table and is used for the
order alone.

Edge cases: a null or empty text has no words and is rejected (too few);
very long texts are handled whole, in groups bounded in bytes; repeated rows
are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.words import Words, doc_windows, mix64, sums_by_doc, word_groups

SAMPLE = 512
MIN_WORDS = 10
REPEAT_WIDTH = 5
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"


# ------------------------------------------------------------- features --
def n_words(w: Words, n: int) -> np.ndarray:
    return w.counts.astype(np.int64)


def word_chars(w: Words, n: int) -> np.ndarray:
    """Code points inside words: bytes that do not continue a character."""
    head = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum((w.data & 0xC0) != 0x80, out=head[1:])
    return sums_by_doc(head[w.end] - head[w.start], w.doc, n).astype(np.int64)


def n_symbols(w: Words, n: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in SYMBOLS]] = True
    at = np.flatnonzero(table[w.data])  # symbols are never white space, so each is in a word
    word = np.searchsorted(w.start, at, "right") - 1
    return sums_by_doc(np.ones(len(at)), w.doc[word], n).astype(np.int64)


def _marked_repeats(keys: np.ndarray, later_only: bool) -> np.ndarray:
    """Which keys occur more than once (or, later_only, occurred before)."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    out = np.empty(len(k), bool)
    out[order] = same[:-1] if later_only else same[:-1] | same[1:]
    return out


def _with_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix64(h + mix64(doc.astype(np.uint64) + np.uint64(1)))


def n_repeat_words(w: Words, n: int) -> np.ndarray:
    """Words inside 5-word windows that are found twice or more in the text."""
    at, h = doc_windows(w, REPEAT_WIDTH)
    if not len(at):
        return np.zeros(n, np.int64)
    at = at[_marked_repeats(_with_doc(h, w.doc[at]), False)]
    size = len(w.hash) + 1
    cover = np.bincount(at, minlength=size) - np.bincount(at + REPEAT_WIDTH, minlength=size)
    return sums_by_doc(np.cumsum(cover[:-1]) > 0, w.doc, n).astype(np.int64)


def n_dup_lines(w: Words, n: int) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text, byte for byte."""
    if not len(w.start):
        return np.zeros(n, np.int64)
    feeds = np.flatnonzero(w.data == 10)
    line = np.searchsorted(feeds, w.start, "right")  # feeds before the word
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])
    first = np.flatnonzero(new)
    doc = w.doc[first]
    bounds = np.concatenate(([-1], feeds, [len(w.data)]))
    top = w.offsets
    a = np.maximum(bounds[line[first]] + 1, top[doc])
    b = np.minimum(bounds[line[first] + 1], top[doc + 1])
    seen: dict[tuple[int, bytes], None] = {}
    out, data = np.zeros(n, np.int64), w.data.tobytes()
    for d, s, e in zip(doc.tolist(), a.tolist(), b.tolist()):
        key = (d, data[s:e])
        if key in seen:
            out[d] += 1
        else:
            seen[key] = None
    return out


FEATURES: dict[str, Callable[[Words, int], np.ndarray]] = {
    "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
}


# ---------------------------------------------------------------- rules --
@dataclass(frozen=True)
class Rule:
    """rejects(features) -> boolean array; ``needs`` names its features."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[dict[str, np.ndarray]], np.ndarray]


RULES = (
    Rule("too_few_words", ("n_words",), lambda f: f["n_words"] < MIN_WORDS),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda f: 100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"]),
    Rule("mostly_symbols", ("n_words", "n_symbols"), lambda f: f["n_symbols"] > f["n_words"]),
    Rule("word_length", ("n_words", "word_chars"), lambda f: (f["word_chars"] < 2 * f["n_words"]) | (f["word_chars"] > 30 * f["n_words"])),
    Rule("repeated_lines", ("n_words", "n_dup_lines"), lambda f: 4 * f["n_dup_lines"] > f["n_words"]),
)
BASE_RULES = ("too_few_words", "repeated_words")


def rule_order(texts: pa.Array, rules=RULES) -> list[str]:
    """Rule names by falling rejection per second, measured on the texts. A
    rule that rejects none of them goes by its cost, after the others."""
    scores = []
    for i, rule in enumerate(rules):
        rejected, rows, spent = 0, 0, 0.0
        for a, b, w in word_groups(texts):
            began = time.perf_counter()
            bad = rule.rejects({k: FEATURES[k](w, b - a) for k in rule.needs})
            spent += time.perf_counter() - began
            rejected, rows = rejected + int(bad.sum()), rows + b - a
        cost = max(spent, 1e-9) / max(rows, 1)
        scores.append((-(rejected / max(rows, 1)) / cost, cost, i, rule.name))
    return [s[-1] for s in sorted(scores)]


def sampled_order(docs: DataFrame, text: str = "text", rules=RULES, sample: int = SAMPLE) -> list[str]:
    """rule_order on about ``sample`` rows drawn over the whole table; it runs
    in one task, and the driver gets the names alone."""
    rows = docs.count()
    few = docs.where(F.rand(1) < F.lit(sample / max(rows, 1))).select(F.col(text).alias("text")).repartition(1)

    def measure(batches):
        texts = pa.concat_arrays([pa.array(b.column(0)).cast(pa.large_string()) for b in batches] or [pa.array([], pa.large_string())])
        yield pa.RecordBatch.from_pydict({"name": pa.array(rule_order(texts, rules), pa.string())})

    names = [r[0] for r in few.mapInArrow(measure, "name string").collect()]
    return names or [r.name for r in rules]


def cascade(w: Words, n: int, rules: list[Rule]) -> np.ndarray:
    """Index of the first rule that rejects each text, -1 if none does. A rule
    and its features are evaluated for the texts still alive only."""
    verdict, alive, have = np.full(n, -1), np.arange(n), {}
    for i, rule in enumerate(rules):
        if not len(alive):
            break
        for k in rule.needs:
            if k not in have:
                have[k] = FEATURES[k](w, len(alive))
        bad = rule.rejects(have)
        if bad.any():
            verdict[alive[bad]] = i
            left = np.flatnonzero(~bad)
            alive, have = alive[left], {k: v[left] for k, v in have.items()}
            w = w.take(left)
    return verdict


def ordered(names: list[str], rules=RULES) -> list[Rule]:
    return sorted(rules, key=lambda r: names.index(r.name))


def quality_digest(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept. The base features are
    wanted for all documents; the cascade runs on those the base rules pass."""
    order = [r for r in ordered(sampled_order(docs, rules=rules), rules) if r.name not in BASE_RULES]
    base = [r for r in rules if r.name in BASE_RULES]
    names = list(FEATURES)
    schema = "doc_id long, " + ", ".join(f"{k} long" for k in names) + ", base_failed boolean, kept boolean"

    def judge(batches):
        for batch in batches:
            for a, b, w in word_groups(batch.column("text")):
                n = b - a
                f = {k: FEATURES[k](w, n) for k in names}
                failed = np.logical_or.reduce([r.rejects(f) for r in base])
                passed = np.flatnonzero(~failed)
                kept = np.zeros(n, bool)
                kept[passed] = cascade(w.take(passed) if len(passed) < n else w, len(passed), order) < 0
                out = {"doc_id": batch.column("doc_id").slice(a, n), **{k: pa.array(f[k], pa.int64()) for k in names}}
                yield pa.RecordBatch.from_pydict(out | {"base_failed": pa.array(failed), "kept": pa.array(kept)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judge, schema)


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """docs without the rows a rule rejects; all columns as they are."""
    order = ordered(sampled_order(docs, text, rules), rules)
    at = docs.columns.index(text)

    def judge(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for a, b, w in word_groups(batch.column(at)):
                keep[a:b] = cascade(w, b - a, order) < 0
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(judge, docs.schema)


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
g AS (SELECT doc_id, len(ws) AS n, i, array_to_string(ws[i:i+4], ' ') AS win FROM w, unnest(range(1, len(ws) - 3)) AS t(i)),
p AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM g) WHERE c >= 2),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM p, unnest([0, 1, 2, 3, 4]) AS t(k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
u AS (SELECT doc_id, sum(c - 1) AS n_dup_lines FROM (SELECT doc_id, line, count(*) AS c FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
f AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN r USING (doc_id) LEFT JOIN u USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT *, NOT (base_failed OR n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 30 * n_words OR 4 * n_dup_lines > n_words) AS kept FROM b
"""
