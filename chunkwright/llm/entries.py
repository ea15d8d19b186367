"""The registered queries of this subpackage and their DuckDB twins.

Each query runs one operator, with production parameters, over the whole
``documents`` table (``embeddings`` for the whitening) and derives the digest
columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chunkwright.llm import bpe, bytebpe, exact, hmm, langid, lines, mixing, near, periodic, quality, sharding, substrings, whitening
from chunkwright.llm.common import documents, embeddings

_DIGESTS = {
    "op1_mix_sources": (mixing.mix_digest, mixing.ORACLE),
    "op2_hmm_score": (hmm.score_digest, None),
    "op3_line_dedup": (lines.line_digest, lines.ORACLE),
    "op4_ngram_join": (near.near_digest, near.ORACLE),
    "op5_exact_dedup": (exact.duplicate_classes, exact.ORACLE),
    "op6_quality_rules": (quality.quality_digest, quality.ORACLE),
    "op7_language_id": (langid.language_digest, None),
    "op8_substring_dedup": (substrings.substring_digest, substrings.ORACLE),
    "op9_bpe_codec": (bpe.bpe_digest, None),
    "op10_feistel_shards": (sharding.shard_documents, None),
    "op12_byte_bpe": (bytebpe.byte_digest, None),
    "op13_periodic_runs": (periodic.run_digest, None),
}


def _query(digest: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _query(digest) for name, (digest, _) in _DIGESTS.items()}
    return out | {"op11_whiten": lambda spark, sf_dir: whitening.whiten_digest(embeddings(spark, sf_dir))}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _DIGESTS.items() if sql is not None}
