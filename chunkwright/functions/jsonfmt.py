"""Artifact formatting: JSON indented by two spaces with non-ASCII escaped,
the format of Python's json.dumps(obj, indent=2).

An Arrow-batched pandas UDF at the output edge (one value per file): exact
formatting of arbitrarily nested JSON is not expressible in SQL.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.params import JSON_INDENT


def _indented(text: str | None) -> str | None:
    """A text that Python can't read (a number of over 4300 digits, very deep
    nesting) is kept as it is: one value must not fail the job."""
    try:
        return None if text is None else json.dumps(json.loads(text), indent=JSON_INDENT)
    except (ValueError, RecursionError):
        return text


@F.pandas_udf(T.StringType())
def json_indent2(texts: pd.Series) -> pd.Series:
    return texts.map(_indented)
