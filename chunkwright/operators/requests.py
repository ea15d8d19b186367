"""Model request tables (D1-D3) and planned back-off waits (D14)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright import params as P

SUMMARY_SYSTEM = "Answer with a single JSON object and nothing else."

# What goes under each top-level key (the keys are the data contract): a value
# to show the shape, and what it should tell.
_GUIDE = {
    "Overall Summary": ("Loads daily orders and writes one total a shop.", "why this code exists, in at most three sentences"),
    "Module/Library Name": ("daily_totals", "the name others import it by"),
    "Data Inputs": ("orders.csv, one row an order", "what is read, from where and in which format"),
    "Data Outputs": ("totals table, one row a shop", "what is written or returned, where to and in which format"),
    "ETL Processes": ({"read": "orders.csv, header skipped", "change": "amounts summed by shop", "write": "totals, replaced as a whole"},
                      "one entry a step that moves or reshapes data"),
    "Classes": ({"ShopTotals": "keeps the sums; add() takes an order, rows() gives the result"}, "one entry a class: its part and its calls"),
    "Functions/Methods": ({"load(path)": "yields orders; raises ValueError on a bad row"}, "one entry a function: arguments, result, side effects"),
    "Variables": ({"MAX_ROWS": "int, orders read at most"}, "one entry a name that steers the code"),
    "Configuration/Environment Variables": ({"ORDERS_DIR": "folder of the input"}, "one entry a setting that is read"),
    "Data Structures": ("dict of shop to amount", "the containers that matter and what links them"),
    "Interfaces/APIs": ("command line: totals DATE", "what other programs can call, and how"),
    "Error Handling/Logging": ("bad rows are counted and logged as a warning", "what can fail, who notices and how"),
}

SUMMARY_PREFIX = (
    "Read the source text below and describe it for a colleague who will work on it tomorrow.\n\n"
    "Your answer is one JSON object. Its keys, and what each is about:\n"
    + "".join(f"- {json.dumps(key)}: {about}\n" for key, (_, about) in _GUIDE.items())
    + "\nFor a small script the object might be:\n"
    + json.dumps({key: shown for key, (shown, _) in _GUIDE.items()}, indent=1)
    + "\n\n--- source text ---\n"
)
SUMMARY_SUFFIX = (
    "\n--- end of source text ---\n"
    "All twelve keys must be there; leave a value empty where the text has nothing to say. "
    "Paraphrase, don't copy code."
)

COMMENT_SYSTEM = "You document source code."
COMMENT_PREFIX = (
    "Return the code below unchanged except for added docstrings: give every class, "
    "function and method a short docstring that states its purpose, its parameters "
    "and what it returns.\n\n"
)
COMMENT_SUFFIX = "\nReturn only the documented code, with no text before or after it."


def request_id(prompt="prompt"):
    return F.sha2(
        F.concat_ws("|", F.col("rel_path"), F.col("chunk_no").cast("string"), F.col(prompt)), 256
    )


def _requests(chunks: DataFrame, system, prefix, suffix, model, max_tokens, temperature, carry) -> DataFrame:
    """Request rows for chunks. A `max_tokens` column on the chunks (a later
    try with a grown budget) wins over the default; an `attempt` column is
    kept."""
    prompt = F.concat(F.lit(prefix), F.col("chunk_text"), F.lit(suffix))
    extra = [c for c in ("attempt", "max_tokens") if c in chunks.columns]
    budget = F.col("max_tokens").cast("int") if "max_tokens" in extra else F.lit(int(max_tokens)).cast("int")
    return (
        chunks.select("rel_path", "chunk_no", *carry, *extra, prompt.alias("prompt"))
        .withColumn("request_id", request_id())
        .select(
            "request_id",
            "rel_path",
            "chunk_no",
            *carry,
            *[c for c in extra if c != "max_tokens"],
            F.lit(system).alias("system"),
            "prompt",
            F.lit(model).alias("model"),
            budget.alias("max_tokens"),
            F.lit(float(temperature)).cast("double").alias("temperature"),
            F.lit(1).cast("int").alias("n"),
        )
    )


def summary_requests(chunks: DataFrame, params: P.SummaryParams = P.SummaryParams(), carry=()) -> DataFrame:
    """One request per chunk that passed the gate (chunks carry `gated`)."""
    asked = chunks.where(~F.col("gated")) if "gated" in chunks.columns else chunks
    return _requests(
        asked, SUMMARY_SYSTEM, SUMMARY_PREFIX, SUMMARY_SUFFIX, params.model, params.response_tokens, params.temperature, carry
    )


def comment_requests(chunks: DataFrame, params: P.CommentParams = P.CommentParams(), carry=()) -> DataFrame:
    asked = chunks.where(~F.col("gated")) if "gated" in chunks.columns else chunks
    base, factor, lo, hi = params.backoff
    out = _requests(
        asked, COMMENT_SYSTEM, COMMENT_PREFIX, COMMENT_SUFFIX, params.model, params.response_tokens, params.temperature, carry
    )
    # Planned waits after a failed try k (k = 1 .. max-1): base * factor^(k-1)
    # times a jitter in [lo, hi]; nothing after the last try.
    waits = F.transform(
        F.sequence(F.lit(1), F.lit(params.max_attempts - 1)),
        lambda k: F.struct(
            k.cast("int").alias("after_try"),
            (F.lit(base) * F.pow(F.lit(factor), k - 1) * lo).alias("min_wait_sec"),
            (F.lit(base) * F.pow(F.lit(factor), k - 1) * hi).alias("max_wait_sec"),
        ),
    )
    return out.withColumn("waits", waits)
