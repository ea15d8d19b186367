"""The linked document over an artifact table (summaries or annotated files)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.operators.hierarchy import document_fragments, file_fragments, page_structure, sort_key, write_pages
from chunkwright.session import configure, stage


FRAME_BYTES = 100  # a file's fragment without its body, about


def build_document(artifacts: DataFrame, title: str, escape: bool = True, path_col: str = "out_path") -> DataFrame:
    """(sort_key, body) fragments; sorted by sort_key they make one HTML page.
    The artifacts are staged once: folders, links and bodies come from there."""
    configure(artifacts.sparkSession)
    return document_fragments(stage(artifacts.select(path_col, "body"), "artifacts"), title, escape, path_col)


def save_document(artifacts: DataFrame, title: str, path: str, escape: bool = True, paths: DataFrame | None = None) -> None:
    """Write the page as ordered text part files under `path`. Structure and
    part ranges come from `paths` (out_path, n_bytes), e.g. a list-only scan
    of the artifact tree; bodies are read once, while their range is written.
    Without paths the artifacts are staged once and both come from there."""
    configure(artifacts.sparkSession)
    if paths is None:
        artifacts = stage(artifacts.select("out_path", "body"), "artifacts")
        paths = artifacts.select("out_path", F.octet_length("body").cast("bigint").alias("n_bytes"))
    else:
        paths = stage(paths.select("out_path", "n_bytes"), "paths")
    slots = paths.select(sort_key(F.col("out_path"), True).alias("sort_key"), (F.coalesce("n_bytes", F.lit(0)) + FRAME_BYTES).cast("bigint").alias("weight"))
    structure = stage(page_structure(paths, title), "structure")
    write_pages(structure, file_fragments(artifacts, escape), slots, path)
