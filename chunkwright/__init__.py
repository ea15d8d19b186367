"""chunkwright: corpus enrichment with a language model, as Spark DataFrame stages.

Public API:

    summarize(files_df, complete=fn | attempts=table, params=SummaryParams())
    annotate(files_df, complete=fn | attempts=table, params=CommentParams())
    build_document(artifacts_df, title) -> fragments (sort_key, body)
    scan_tree(spark, root, suffix=".py", exclude_name="test") -> (rel_path, content, n_bytes)
    decode_text(scanned) -> adds text (strict UTF-8, newlines normalised)
    write_tree(artifacts, root) / read_artifacts(spark, root): artifact trees
"""

from chunkwright.params import CommentParams, SummaryParams  # noqa: F401
from chunkwright.plans.annotate import annotate  # noqa: F401
from chunkwright.plans.document import build_document, save_document  # noqa: F401
from chunkwright.plans.summarize import summarize  # noqa: F401
from chunkwright.session import configure, local_session  # noqa: F401
from chunkwright.sources.artifacts import read_artifacts  # noqa: F401
from chunkwright.sources.tree import decode_text, scan_tree, write_tree  # noqa: F401

__all__ = [
    "SummaryParams",
    "CommentParams",
    "summarize",
    "annotate",
    "build_document",
    "save_document",
    "scan_tree",
    "decode_text",
    "write_tree",
    "read_artifacts",
    "configure",
    "local_session",
]
