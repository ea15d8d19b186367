"""Failure isolation and the run report (section G).

Failures are rows, not exceptions: every stage adds (rel_path, stage,
status, reason) rows to one audit table; the quarantine is its failed rows.
The reason of a file that was not read travels with its row from the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright import params as P

AUDIT_COLS = ["rel_path", "stage", "status", "reason"]


def selection_audit(all_files: DataFrame, suffix: str = P.SOURCE_SUFFIX, word: str = P.EXCLUDE_NAME) -> DataFrame:
    """kept / skipped rows by name. A folder that could not be listed is no
    file: it is reported by the scan."""
    if "reason" in all_files.columns:
        all_files = all_files.where(F.col("reason").isNull())
    name = F.col("file_name")
    reason = F.when(~name.endswith(suffix), "suffix").when(F.lower(name).contains(word.lower()), "test_name")
    return all_files.select(
        "rel_path", F.lit("select").alias("stage"),
        F.when(reason.isNull(), "kept").otherwise("skipped").alias("status"), reason.alias("reason"),
    )


def unread_reason():
    """Why a file has no text: the scan's reason (io_error, not_listed), or
    bytes that are not UTF-8. Null for a file that was read."""
    return F.when(F.col("chunk_no").isNull() & F.col("n_chunks").isNull(), F.coalesce("reason", F.lit("not_utf8")))


def _file_audit(states: DataFrame, resolve=None) -> DataFrame:
    """Audit rows from one row a file: unread, fate and, with resolve, the
    status of its tries."""
    null = F.lit(None).cast("string")

    def row(stage, status, reason):
        return F.struct(stage.alias("stage"), status.alias("status"), reason.cast("string").alias("reason"))

    unread = F.array(row(F.when(F.col("unread") == "not_utf8", "decode").otherwise("scan"), F.lit("failed"), F.col("unread")))
    done = F.array(row(F.lit("complete"), F.when(F.col("fate").isNotNull(), "failed").otherwise("ok"), F.col("fate")))
    both = done if resolve is None else F.when(F.col("fate").isNotNull(), done).otherwise(F.concat(done, F.array(row(F.lit("resolve"), resolve, null))))
    rows = F.when(F.col("unread").isNotNull(), unread).otherwise(both)
    return states.select("rel_path", F.inline(rows))


def _with_reason(rows: DataFrame) -> DataFrame:
    return rows if "reason" in rows.columns else rows.withColumn("reason", F.lit(None).cast("string"))


def summary_audit(all_files: DataFrame, run) -> DataFrame:
    """select / scan / decode / complete / resolve rows for a summary run. All
    but the selection come from the run's chunk records, one aggregation by
    file; the source is not read again."""
    rows = _with_reason(run.chunk_records).select(
        "rel_path", unread_reason().alias("unread"), "fate",
        F.when(F.col("tried"), F.coalesce("win", F.lit(0))).alias("win"), (F.col("tried") & F.col("win").isNull()).alias("open"))
    if run.params.strict_merge:
        nested = run.lost.where(F.col("fate") == "nested_value").select("rel_path", "fate")
        rows = rows.unionByName(nested, allowMissingColumns=True)
    states = rows.groupBy("rel_path").agg(F.max("unread").alias("unread"), F.min("fate").alias("fate"), F.max("win").alias("win"), F.max("open").alias("open"))
    status = F.when(F.col("open"), "exhausted").when(F.col("win") > 1, "retried").otherwise("first_try")
    return selection_audit(all_files).unionByName(_file_audit(states, status))


def quarantine(audit: DataFrame) -> DataFrame:
    return audit.where(F.col("status") == "failed").select("rel_path", "stage", "reason")


def run_report(audit: DataFrame) -> DataFrame:
    """Counts per stage and status, with stage totals and a grand total."""
    return audit.rollup("stage", "status").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def annotate_audit(all_files: DataFrame, run) -> DataFrame:
    """select / scan / decode / complete rows for a comment (annotate) run,
    from one aggregation by file over its chunk rows and answers."""
    asked = F.col("chunk_no").isNotNull() & ~F.coalesce("gated", F.lit(False))
    rows = _with_reason(run.chunk_rows).select("rel_path", unread_reason().alias("unread"), asked.cast("int").alias("open"), F.lit(0).alias("failed"))
    tried = run.resolved.select("rel_path", F.lit(None).cast("string").alias("unread"), F.lit(-1).alias("open"), F.col("failed").cast("int").alias("failed"))
    g = rows.unionByName(tried).groupBy("rel_path").agg(F.max("unread").alias("unread"), F.sum("open").alias("open"), F.max("failed").alias("failed"))
    fate = F.when(F.col("failed") == 1, "call_error").when(F.col("open") > 0, "no_answer")
    return selection_audit(all_files).unionByName(_file_audit(g.select("rel_path", "unread", fate.alias("fate"))))
