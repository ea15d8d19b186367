"""The corpus pipeline: quality rules, exact de-duplication, near-duplicate
removal, mixing and BPE encoding, each on all that the stage before kept.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last keep the columns of ``documents``. ``run`` writes each stage to
the shared work folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunkwright.llm import bpe, exact, mixing, near, quality
from chunkwright.llm.common import documents, stage

# The encoder's ids and the mixture of a measured cascade can't be stated in SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that a rule rejects go."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of equal texts one row stays."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near copies stays."""
    return near.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents as often as their source's weight asks for."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one row per emitted document with its token digests."""
    return bpe.bpe_digest(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix),
    ("bpe_encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
