"""JSON answer expressions: extract, strict decode, validate, incomplete tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkwright import params as P
from chunkwright.functions.text import py_rstrip, py_strip

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def extract_json(response) -> Column:
    """First '{' to last '}' across lines; '' when there is none."""
    return F.regexp_extract(_c(response), P.JSON_SPAN, 0)


def strict_json_map(json_text) -> Column:
    """Decode one JSON object strictly into MAP<STRING, VARIANT>, in one parse.

    The text is read as the first element of a list whose second is a mark
    made from the text's own hash. A tail after the object can close the list
    early, add an element or break it, but it can't hold the mark, so trailing
    text and a second object are refused. Single quotes and NaN are refused by
    option. Duplicate keys keep the last value (session LAST_WIN policy).
    Anything else, including '', gives NULL.
    """
    j = _c(json_text)
    mark = F.hex(F.xxhash64(j))
    both = F.from_json(F.concat(F.lit("["), j, F.lit(',{"'), mark, F.lit('":0}]')), "array<map<string,variant>>", _STRICT)
    whole = (F.size(both) == 2) & F.coalesce(F.map_contains_key(F.get(both, 1), mark), F.lit(False))
    return F.when(whole, F.map_from_entries(F.map_entries(F.get(both, 0))))


def value_kind(v) -> Column:
    """'STRING', 'OBJECT...' or another variant type name (NULL -> 'NULL')."""
    return F.coalesce(F.schema_of_variant(_c(v)), F.lit("NULL"))


def value_kinds(m) -> Column:
    """The kind of each value of a decoded map, by key and in its order."""
    return F.transform_values(_c(m), lambda k, v: value_kind(v))


def response_status(kinds) -> Column:
    """valid / empty / bad_keys / bad_types from the kinds of a summary's
    values. Unknown keys are reported before wrong value types."""
    kk = _c(kinds)
    keys = F.array(*[F.lit(k) for k in P.SECTIONS])
    bad_key = F.size(F.array_except(F.map_keys(kk), keys)) > 0
    bad_type = F.exists(F.map_values(kk), lambda v: ~v.rlike("^(STRING|OBJECT)"))
    return (
        F.when(kk.isNull() | (F.size(kk) == 0), F.lit("empty"))
        .when(bad_key, F.lit("bad_keys"))
        .when(bad_type, F.lit("bad_types"))
        .otherwise(F.lit("valid"))
    )


def object_keys(kinds) -> Column:
    """Keys whose value is an object."""
    return F.map_keys(F.map_filter(_c(kinds), lambda k, v: v.startswith("OBJECT")))


def json_incomplete(response) -> Column:
    """Does a (stripped) JSON answer look cut off? Empty: no. Last character
    not '}': yes. Otherwise: yes when '{' and '}' counts differ.

    The rule first deletes white space after '}' and before '{'. That step
    cannot change the outcome (it removes no brace, cannot empty a stripped
    non-empty text, and never removes its last, non-space character), so it
    is skipped; the oracle SQL keeps it as an independent check."""
    r = _c(response)
    last = F.right(py_rstrip(r), F.lit(1))
    n_open = F.length(r) - F.length(F.replace(r, F.lit("{"), F.lit("")))
    n_close = F.length(r) - F.length(F.replace(r, F.lit("}"), F.lit("")))
    return (
        F.when(r.isNull(), F.lit(None).cast("boolean"))
        .when(last == "", F.lit(False))
        .when(last != "}", F.lit(True))
        .otherwise(n_open != n_close)
    )


def prose_incomplete(response) -> Column:
    """A prose answer is complete only when it ends in '.', '!' or '?'."""
    r = py_strip(_c(response))
    return F.when(_c(response).isNull(), F.lit(None).cast("boolean")).otherwise(
        (r != "") & ~F.right(r, F.lit(1)).isin(".", "!", "?")
    )
