"""Table inputs: parquet tables and the `documents` corpus seen as a file tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.functions.paths import file_name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_rel_path(doc_id="doc_id", source="source", lang="lang"):
    """A deterministic file path per document: source/lang/<name><doc_id><suffix>.
    The names exercise the suffix case and 'test' rules (Test_, latest)."""
    d = F.col(doc_id)
    stem = F.when(d % 7 == 0, "Test_").when(d % 11 == 0, "latest").otherwise("doc_")
    suffix = F.when(d % 5 == 0, ".txt").when(d % 13 == 0, ".PY").otherwise(".py")
    return F.concat(F.col(source), F.lit("/"), F.col(lang), F.lit("/"), stem, d.cast("string"), suffix)


def documents_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """files(rel_path, file_name, text, n_chars, doc_id, source) from `documents`."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        documents_rel_path().alias("rel_path"),
        "text",
        F.length("text").cast("bigint").alias("n_chars"),
        "doc_id",
        "source",
    ).withColumn("file_name", file_name("rel_path"))
