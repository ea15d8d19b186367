"""Operator 1: mixing sources to target weights.

Tokens are summed per source, target shares become repetition rates, and each
document is emitted floor(rate) times plus one more copy when a hash of the
seed and its id falls below the rate's fraction.

Edge cases: a null text has size 0; a null source is a source of its own and
comes last; a source of size 0 has target 0 and is not taken; repeated rows
and equal ids share one decision (it depends on the id only); a null id is
hashed as an empty string; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import WORD, fresh, join_groups, numbered, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # all targets together, as a share of all sizes
CAP = 2  # most copies of a document
SEED = "mix-1"


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(id_col: str, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) from the first 52 bits of an md5."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, n_docs, source_size, target). Weighted shares of
    ``share`` times all sizes; a target above ``cap`` times its source's size
    stops there, and the excess is shared by weight among the others, round by
    round until none is above. Each round is one aggregate over the source
    table (the driver sees two sums), so the number of sources is not bounded."""
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(size).cast("long").alias("source_size"))
    ranked = numbered(per, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    src = stage(ranked.withColumn("w", weight.cast("double")), "sources")
    total = share * float(src.agg(F.sum("source_size")).first()[0] or 0)
    limit = (F.col("source_size") * cap).cast("double")
    free_total, free_weight = total, float(src.agg(F.sum("w")).first()[0] or 0)
    while free_weight > 0:
        level = F.lit(free_total) * F.col("w") / F.lit(free_weight)
        capped, w = src.agg(F.sum(F.when(level >= limit, limit)), F.sum(F.when(level < limit, F.col("w")))).first()
        t, w = total - (capped or 0.0), w or 0.0
        if w == free_weight:
            break
        free_total, free_weight = t, w
    target = limit if free_weight <= 0 else F.least(limit, F.lit(free_total) * F.col("w") / F.lit(free_weight))
    return src.select("source", "n_docs", "source_size", target.alias("target"))


def mix_plan(sizes: DataFrame, targets: DataFrame, id_col: str = "doc_id", seed: str = SEED) -> DataFrame:
    """Each row of sizes (id, source, size, ...) with its source's size and
    target and the number of copies to emit."""
    n = targets.agg(F.sum("n_docs")).first()[0] or 0
    rows = join_groups(sizes, targets, ["source"], "n_docs", int(n))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(CAP)))).otherwise(0.0)
    extra = F.when(draw(id_col, seed) < rate - F.floor(rate), 1).otherwise(0)
    return rows.withColumn("copies", (F.floor(rate) + extra).cast("int")).drop("n_docs")


def mix_digest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    sizes = stage(docs.select("doc_id", "source", token_count().alias("size")), "sizes")
    plan = mix_plan(sizes, source_targets(sizes))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", seed: str = SEED) -> DataFrame:
    """The mixture itself: docs' rows and columns, each row as often as taken.
    Only rows of sources below the hot share are shuffled."""
    a, b, c, k = fresh(docs, "_size", "_rate", "_copies", "_copy")
    sizes = stage(docs.select(F.col(source).alias("source"), token_count(text).alias("size")), "sizes")
    targets = source_targets(sizes)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(CAP)))).otherwise(0.0)
    g = targets.select(F.col("source").alias(source), F.col("n_docs").alias(a), rate.alias(b))
    rows = join_groups(docs, g, [source], a, int(targets.agg(F.sum("n_docs")).first()[0] or 0))
    copies = F.floor(F.col(b)) + F.when(draw(id_col, seed) < F.col(b) - F.floor(F.col(b)), 1).otherwise(0)
    rows = rows.withColumn(c, copies.cast("int")).where(F.col(c) > 0)
    return rows.withColumn(k, F.explode(F.sequence(F.lit(1), F.col(c)))).select(*docs.columns)


ORACLE = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT source, source_size, rank, CAST([3, 1, 2][(rank % 3) + 1] AS DOUBLE) AS w, CAST(2 * source_size AS DOUBLE) AS lim, 1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE AS total FROM r),
o AS (SELECT *, coalesce(sum(lim) OVER k, 0) AS before, sum(w) OVER f AS rest FROM w
      WINDOW k AS (ORDER BY lim / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (ORDER BY lim / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT arg_min(total - before, lim / w) AS free_total, arg_min(rest, lim / w) AS free_weight FROM o WHERE (total - before) * w / rest < lim),
t AS (SELECT w.source, w.source_size, CASE WHEN l.free_weight IS NULL THEN w.lim ELSE least(w.lim, l.free_total * w.w / l.free_weight) END AS target FROM w CROSS JOIN l),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 2.0::DOUBLE) ELSE 0.0 END AS rate,
        CAST(concat('0x', substr(md5(concat('mix-1:', coalesce(CAST(d.doc_id AS VARCHAR), ''))), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies FROM q)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM c
"""
