"""Token counts and token windows from a user tokenizer (H1).

The tokenizer is loaded once per task (not per row or batch) by the user's
`load()` function. For counts it returns a callable text -> tokens; for
windows a pair (encode, decode): text -> tokens, tokens -> text. Tokens may be
a list or any iterable that can be made again from the text: an iterator is
read window by window, so a long text's tokens need not be held at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _size(tokens: Iterable) -> int:
    return len(tokens) if hasattr(tokens, "__len__") else sum(1 for _ in tokens)


def token_count_udf(load: Callable[[], Callable[[str], Iterable]]):
    """Build a pandas UDF that counts tokens with the tokenizer `load()`
    returns; pass it as `tokenizer=` to summarize / annotate / with_budget."""

    @F.pandas_udf(T.LongType())
    def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = load()
        for s in batches:
            yield s.map(lambda t: None if t is None else _size(tok(t))).astype("Int64")

    return count_tokens


WINDOW_ROWS = 256  # windows handed on at once


def token_windows(files: DataFrame, n: int, load: Callable[[], tuple[Callable, Callable]], carry=()) -> DataFrame:
    """(rel_path, *carry, n_chunks, chunk_no, chunk_text): every n tokens of a
    text, decoded. Memory per text is its tokens at most, or one window where
    encode returns an iterator (then it is read twice: for the number of
    windows, and for the windows). Empty and NULL texts have no window."""
    kept = files.select("rel_path", *carry, "text").where(F.length("text") > 0)
    cols = len(kept.columns) - 1
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:cols]] + ["n_chunks bigint", "chunk_no bigint", "chunk_text string"])

    def run(batches):
        encode, decode = load()
        for batch in batches:
            for row, text in enumerate(batch.column(cols)):
                text = text.as_py()
                tokens = encode(text)
                total = -(-_size(tokens) // n)
                stream = iter(tokens if hasattr(tokens, "__len__") else encode(text))
                for first in range(0, total, WINDOW_ROWS):
                    no = range(first, min(first + WINDOW_ROWS, total))
                    out = [batch.column(i).take(pa.array([row] * len(no))) for i in range(cols)]
                    out += [pa.array([total] * len(no), pa.int64()), pa.array(no, pa.int64()), pa.array([decode(list(islice(stream, n))) for _ in no], pa.string())]
                    yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[:cols], "n_chunks", "chunk_no", "chunk_text"])

    return kept.mapInArrow(run, schema)


SPACED_WORD = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"


def spaced_words(text: str) -> Iterator[str]:
    """A plain tokenizer: words with the white space after them, as a stream."""
    return (m[0] for m in re.finditer(SPACED_WORD, text))


def load_spaced_words() -> tuple[Callable, Callable]:
    return spaced_words, "".join
