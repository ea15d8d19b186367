"""Row filters and projections over file and chunk tables (section B)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.functions.paths import file_name
from chunkwright.functions.text import py_strip


def _with_name(files: DataFrame) -> DataFrame:
    if "file_name" in files.columns:
        return files
    return files.withColumn("file_name", file_name("rel_path"))


def python_files(files: DataFrame, suffix: str = P.SOURCE_SUFFIX) -> DataFrame:
    """Keep names ending in the suffix, case-sensitive."""
    return _with_name(files).where(F.col("file_name").endswith(suffix))


def non_test_files(files: DataFrame, word: str = P.EXCLUDE_NAME) -> DataFrame:
    """Drop files whose *name* contains the word in any case ('latest' too)."""
    return _with_name(files).where(~F.lower(F.col("file_name")).contains(word.lower()))


def source_files(files: DataFrame, suffix: str = P.SOURCE_SUFFIX, word: str = P.EXCLUDE_NAME) -> DataFrame:
    return non_test_files(python_files(files, suffix), word)


def gate_expr(text="chunk_text", min_chars: int = P.MIN_CHUNK_CHARS):
    """True when a chunk is not worth a model call: blank after strip, or
    shorter than min_chars before stripping."""
    t = F.col(text) if isinstance(text, str) else text
    return (F.length(py_strip(t)) == 0) | (F.length(t) < min_chars)


def chunk_gate(chunks: DataFrame, min_chars: int = P.MIN_CHUNK_CHARS) -> DataFrame:
    return chunks.withColumn("gated", gate_expr("chunk_text", min_chars))


def artifact_files(df: DataFrame, suffixes=P.ARTIFACT_SUFFIXES) -> DataFrame:
    """Keep artifact names ending in one of the suffixes."""
    cond = None
    for s in suffixes:
        c = F.col("rel_path").endswith(s)
        cond = c if cond is None else (cond | c)
    return df.where(cond)


def relative_paths(df: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """Path relative to the root folder (root given without a trailing '/')."""
    root = root.rstrip("/")
    p = F.col(path_col)
    return df.withColumn(
        "rel_path",
        F.when(p.startswith(root + "/"), F.substr(p, F.lit(len(root) + 2), F.length(p))).otherwise(p),
    )
