"""Artifact tables: read an artifact tree back, and save artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.operators.filters import artifact_files
from chunkwright.operators.hierarchy import write_document  # noqa: F401  (re-export)
from chunkwright.sources.tree import decode_text, scan_tree, write_tree  # noqa: F401


def read_artifacts(spark: SparkSession, root, suffixes=P.ARTIFACT_SUFFIXES) -> DataFrame:
    """(rel_path, out_path, body) for every .txt or .py artifact: below a
    folder `root` (the suffix filter runs in the scan, so other files are
    never opened), or from an artifact table (rel_path, body)."""
    if isinstance(root, DataFrame):
        return artifact_files(root, suffixes).select("rel_path", F.col("rel_path").alias("out_path"), "body")
    scanned = decode_text(scan_tree(spark, root, tuple(suffixes)))
    return scanned.select("rel_path", F.col("rel_path").alias("out_path"), F.col("text").alias("body"))


def artifact_paths(spark: SparkSession, root: str, suffixes=P.ARTIFACT_SUFFIXES) -> DataFrame:
    """(out_path, n_bytes) of the artifacts below a folder, without opening
    them: the `paths` of save_document."""
    listed = scan_tree(spark, root, tuple(suffixes), list_only=True)
    return listed.where("error IS NULL").select(F.col("rel_path").alias("out_path"), "n_bytes")
