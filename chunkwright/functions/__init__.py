"""Column-expression building blocks (all JVM-side Catalyst expressions)."""

from chunkwright.functions.text import (  # noqa: F401
    centre_sample,
    chars_per_token,
    chunk_chars,
    head_sample,
    is_none_like,
    line_chunk_pattern,
    normalise_newlines,
    pretokens,
    py_strip,
    token_count,
    word_chunk_pattern,
)
from chunkwright.functions.jsontext import (  # noqa: F401
    extract_json,
    json_incomplete,
    prose_incomplete,
    response_status,
    strict_json_map,
)
from chunkwright.functions.paths import (  # noqa: F401
    file_name,
    html_escape,
    replace_extension,
)
