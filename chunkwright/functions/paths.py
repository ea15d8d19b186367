"""Path and markup expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_name(path) -> Column:
    return F.substring_index(_c(path), "/", -1)


def replace_extension(path, new_ext: str) -> Column:
    """os.path.splitext semantics: drop the last '.suffix' of the final part
    unless the name starts with it ('a/.py' keeps its name), then add new_ext."""
    stem = F.regexp_replace(_c(path), F.lit(r"^((?:.*/)?\.*[^/.][^/]*)\.[^./]*$"), F.lit("$1"))
    return F.concat(stem, F.lit(new_ext))


def html_escape(col) -> Column:
    """Escape &, < and > for an HTML text node."""
    c = F.replace(_c(col), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))
