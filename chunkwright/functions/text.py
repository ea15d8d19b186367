"""Text expressions: Python-compatible strip, samples, token ratio, chunk patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkwright import params as P

# Python's str.strip() removes every character for which str.isspace() is
# true; the set is taken from the running Python (29 characters), and Spark's
# btrim removes exactly those from both ends without scanning the middle.
PY_SPACES = "".join(c for c in map(chr, range(0x110000)) if c.isspace())

# Pre-tokens of a byte-pair tokenizer's splitting step (letters, digits,
# other symbols, each with one optional leading space; runs of white space).
PRETOKEN_RE = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(col) -> Column:
    """Strip leading and trailing white space exactly as Python's str.strip()."""
    return F.btrim(_c(col), F.lit(PY_SPACES))


def py_rstrip(col) -> Column:
    return F.rtrim(_c(col), F.lit(PY_SPACES))


_SPACE = f"(?:[{re.escape(PY_SPACES)}]|\\\\(?:[tnfr]|u00(?:0[Bb]|1[C-Fc-f])))"
_INNER = rf'(?:[^"\\{re.escape(PY_SPACES)}]++|\\(?![tnfr]|u00(?:0[Bb]|1[C-Fc-f])).)'
_STRING = r'"(?:[^"\\]++|\\.)*+"'


def strip_in_json(col) -> Column:
    """Compact JSON text with the string values at every depth stripped, names
    kept: first what leads, then what trails; other strings pass as a whole."""
    led = F.regexp_replace(_c(col), f'({_STRING}:)|(")(?:{_SPACE})++({_STRING[1:]})|({_STRING})', "$1$2$3$4")
    return F.regexp_replace(led, f'({_STRING}:)|("(?:{_SPACE}*+{_INNER})*+){_SPACE}*+(")', "$1$2$3")


def is_none_like(stripped) -> Column:
    """True for an empty, 'none' or 'n/a' value (already stripped), any case."""
    return F.lower(_c(stripped)).isin(*P.NONE_LIKE)


def normalise_newlines(col) -> Column:
    """Text-mode reading: CR LF and lone CR become LF."""
    return F.regexp_replace(_c(col), F.lit("\r\n?"), F.lit("\n"))


def head_sample(text, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else _c(n)
    return F.substr(_c(text), F.lit(1), n)


def centre_sample(text, n: int) -> Column:
    """The whole text if it is short, else n characters around the middle."""
    t = _c(text)
    ln = F.length(t)
    start = F.floor(ln / 2) - F.lit(n // 2) + 1
    return F.when(ln <= n, t).otherwise(F.substr(t, start.cast("int"), F.lit(n)))


def pretokens(text) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(PRETOKEN_RE), 0)


def token_count(text) -> Column:
    """Number of pre-tokens, counted without building the token array."""
    return F.coalesce(F.regexp_count(_c(text), F.lit(PRETOKEN_RE)), F.lit(0)).cast("bigint")


def chars_per_token(sample, tokens) -> Column:
    """len(sample)/tokens * 0.75, or 2.5 when there are no tokens."""
    s, t = _c(sample), _c(tokens)
    return F.when(t == 0, F.lit(P.DEFAULT_CHARS_PER_TOKEN)).otherwise(
        (F.length(s).cast("double") / t.cast("double")) * F.lit(P.SAFETY_FACTOR)
    )


def chunk_chars(budget_tokens: int, ratio) -> Column:
    """int(budget * ratio), at least one character."""
    return F.greatest(F.floor(F.lit(float(budget_tokens)) * _c(ratio)).cast("bigint"), F.lit(1).cast("bigint"))


def word_chunk_pattern(max_chars) -> Column:
    """Chunks of at most M characters that end before a space or newline (the
    separator opens the next chunk); the last chunk takes the rest; a window
    with no separator is cut hard at M."""
    m = _c(max_chars).cast("string") if not isinstance(max_chars, int) else F.lit(str(max_chars))
    sep = "[" + P.CHUNK_SEPARATORS + "]"
    return F.concat(F.lit("(?s).{1,"), m, F.lit("}(?=" + sep + "|\\z)|(?s).{1,"), m, F.lit("}"))


def line_chunk_pattern(max_chars) -> Column:
    """Chunks of at most M characters cut after the last newline in the
    window (the newline closes the chunk), else cut hard at M."""
    if isinstance(max_chars, int):
        m, m1 = F.lit(str(max_chars)), F.lit(str(max_chars - 1))
    else:
        m = _c(max_chars).cast("string")
        m1 = (_c(max_chars) - 1).cast("string")
    return F.concat(
        F.lit("(?s).{1,"), m, F.lit("}\\z|(?s).{0,"), m1, F.lit("}\n|(?s).{1,"), m, F.lit("}")
    )
