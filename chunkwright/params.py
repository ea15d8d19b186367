"""Job parameters and the fixed values of the summary data contract.

The section names, the None-like words and the numeric defaults below must
equal the original job's values for identical results, so they are kept here
together, as plain text, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original job exactly)
# ---------------------------------------------------------------------------

# The twelve top-level sections a chunk summary may hold, in prompt order.
SECTIONS = (
    "Overall Summary",
    "Module/Library Name",
    "ETL Processes",
    "Classes",
    "Functions/Methods",
    "Variables",
    "Data Structures",
    "Interfaces/APIs",
    "Configuration/Environment Variables",
    "Error Handling/Logging",
    "Data Inputs",
    "Data Outputs",
)

# Sections merged as text (joined with ", ", fragments de-duplicated).
TEXT_SECTIONS = (
    "Overall Summary",
    "Module/Library Name",
    "Data Inputs",
    "Data Outputs",
    "Data Structures",
    "Interfaces/APIs",
    "Error Handling/Logging",
)

# Sections merged item by item (first chunk wins).
MAP_SECTIONS = ("Classes", "Functions/Methods", "Configuration/Environment Variables")

# Keys of a merged many-chunk record, in record order (ETL Processes and
# Variables are not part of it).
MERGED_SECTIONS = (
    "Overall Summary",
    "Module/Library Name",
    "Classes",
    "Functions/Methods",
    "Data Structures",
    "Interfaces/APIs",
    "Configuration/Environment Variables",
    "Error Handling/Logging",
    "Data Inputs",
    "Data Outputs",
)

# Values that count as "no value" after stripping, compared lower-case.
NONE_LIKE = ("none", "n/a", "")

# Patterns and formats.
JSON_SPAN = r"(?s)\{.*\}"       # the answer's JSON: first '{' to last '}', across lines
CHUNK_SEPARATORS = " \n"          # a word chunk ends before one of these
TEXT_JOIN = ", "                  # text sections are joined, split and de-duplicated on it
COMMENT_JOIN = "\n"               # chunk answers of one file, in chunk order
ANNOTATION_SEPARATOR = "\n\n"     # between the answers and the original text
SUMMARY_EXTENSION = ".txt"        # replaces the source file's last extension
JSON_INDENT = 2                   # summary files: indented JSON, non-ASCII escaped

# Numeric defaults.
CONTEXT_TOKENS = 128_000
RESPONSE_TOKENS = 2_000
SUMMARY_CHUNK_TOKENS = CONTEXT_TOKENS - RESPONSE_TOKENS  # 126,000
SUMMARY_SAMPLE_CHARS = 2_500
COMMENT_CHUNK_TOKENS = 2_500
COMMENT_SAMPLE_CHARS = 5_000
COMMENT_RESPONSE_TOKENS = 2_500
DEFAULT_CHARS_PER_TOKEN = 2.5
SAFETY_FACTOR = 0.75
MIN_CHUNK_CHARS = 10
SUMMARY_ATTEMPTS = 5
COMMENT_ATTEMPTS = 3
BUDGET_STEP = 100
TEMPERATURE = 0.5
BACKOFF_BASE_SEC = 1.0
BACKOFF_FACTOR = 2.0
JITTER_LOW = 0.5
JITTER_HIGH = 1.5
SOURCE_SUFFIX = ".py"
EXCLUDE_NAME = "test"
ARTIFACT_SUFFIXES = (".txt", ".py")

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SummaryParams:
    """Parameters of the summary job (defaults as in the original job)."""

    model: str = "chat-model"
    response_tokens: int = RESPONSE_TOKENS
    chunk_tokens: int = SUMMARY_CHUNK_TOKENS
    sample_chars: int = SUMMARY_SAMPLE_CHARS
    max_attempts: int = SUMMARY_ATTEMPTS
    budget_step: int = BUDGET_STEP
    temperature: float = TEMPERATURE
    min_chunk_chars: int = MIN_CHUNK_CHARS
    # A fixed chunk size in characters; None derives it from the token ratio.
    chunk_chars: int | None = None
    keep_all_sections: bool = False
    strict_merge: bool = False

    def with_(self, **kw) -> "SummaryParams":
        return replace(self, **kw)


@dataclass(frozen=True)
class CommentParams:
    """Parameters of the comment (annotation) job."""

    model: str = "chat-model"
    response_tokens: int = COMMENT_RESPONSE_TOKENS
    chunk_tokens: int = COMMENT_CHUNK_TOKENS
    sample_chars: int = COMMENT_SAMPLE_CHARS
    max_attempts: int = COMMENT_ATTEMPTS
    temperature: float = TEMPERATURE
    min_chunk_chars: int = MIN_CHUNK_CHARS
    chunk_chars: int | None = None
    backoff: tuple = field(default=(BACKOFF_BASE_SEC, BACKOFF_FACTOR, JITTER_LOW, JITTER_HIGH))

    def with_(self, **kw) -> "CommentParams":
        return replace(self, **kw)
