"""Operator 3 [native]: line de-duplication over levelled sorted runs.

The index of line keys (two 64-bit hashes) is a set of runs, written in buckets
of the key and sorted by it to the shared folder. Documents come in batches of
falling id. A batch is reduced to one sorted row per key and merge-anti-joined
with the runs, which takes out the keys already settled (found in ``min_docs``
documents; their keeper is the largest id and stays). What is left takes over
the counts and keepers of the runs' open keys and is added as a run of level 0.
Before a batch, ``FANOUT`` runs of a level are compacted into one of the next.
Settled keys then lose their lines everywhere but in their keeper. Between
batch and runs, and between runs, nothing is shuffled or sorted again.

Edge cases: a null or empty text is one empty line; a document is a doc_id, so
rows of one id count once and all keep a key they hold as the largest id; a
null id counts as the smallest; all lines dropped give an empty text; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import HOT_SHARE, STRIP, ascii_lower, drop_stage, fresh, in_buckets, join_groups, stage, text_or_empty

MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 20, 3, 4, 2
NO_ID = -(1 << 63)
KEY = ["h1", "h2"]
SORTED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def split_lines(text: str = "text") -> Column:
    return F.split(text_or_empty(text), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(STRIP)))


def line_table(docs: DataFrame, id_col: str, text: str, min_chars: int) -> DataFrame:
    """(doc, text_hash, pos, h1, h2): the lines long enough, from 0."""
    lines = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_or_empty(text)).alias("text_hash"),
        F.posexplode(split_lines(text)).alias("pos", "line"),
    )
    keyed = lines.select("doc", "text_hash", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("doc", "text_hash", "pos", F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))


class LineRuns:
    """Levelled sorted runs of (h1, h2, docs, keeper): tables in buckets of the
    key, sorted by it, so that all joins here merge files as they lie. A row
    holds in how many documents its key was found up to that batch, and the
    largest of them; the row of a later run replaces those of earlier ones. A
    key found in min_docs documents is settled: the anti-join takes it out of
    every later batch, so it settles in one run only."""

    def __init__(self, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.min_docs, self.fanout, self.levels = min_docs, fanout, {}

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels.values() for r in level]

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """The keys of a batch that no run has settled."""
        for run in self.runs():
            batch = batch.join(run.where(F.col("docs") >= self.min_docs).select(*KEY).hint("merge"), KEY, "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """batch: a sorted run with one row per key of documents with smaller ids
        than all before (h1, h2, docs, keeper)."""
        self.compact()
        rows = self.unsettled(batch)
        was, first = F.lit(0).cast("long"), F.lit(None).cast("long")
        for i, run in enumerate(self.runs()):
            earlier = run.where(F.col("docs") < self.min_docs).select(*KEY, F.col("docs").alias(f"docs{i}"), F.col("keeper").alias(f"keeper{i}"))
            rows = rows.join(earlier.hint("merge"), KEY, "left")
            was, first = F.greatest(was, f"docs{i}"), F.coalesce(first, f"keeper{i}")
        run = rows.select(*KEY, (F.col("docs") + was).alias("docs"), F.coalesce(first, "keeper").alias("keeper"))
        self.levels.setdefault(0, []).append(sorted_run(run, "lines-L0"))

    def compact(self) -> None:
        """Merges the runs of every full level into one of the next."""
        for level in range(len(self.levels)):
            held = self.levels[level]
            if len(held) >= self.fanout:
                self.levels[level] = []
                self.levels.setdefault(level + 1, []).append(sorted_run(reduce(self.merged, held), f"lines-L{level + 1}"))
                for run in held:
                    drop_stage(run)

    @staticmethod
    def merged(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnsRenamed({"docs": "docs_b", "keeper": "keeper_b"}).hint("merge")
        return a.join(b, KEY, "full").select(*KEY, F.greatest("docs", "docs_b").alias("docs"), F.coalesce("keeper", "keeper_b").alias("keeper"))

    def settled(self) -> DataFrame:
        """(h1, h2, keeper) of the keys in at least min_docs documents."""
        return reduce(DataFrame.unionByName, [r.where(F.col("docs") >= self.min_docs).select(*KEY, "keeper") for r in self.runs()])


def sorted_run(df: DataFrame, name: str) -> DataFrame:
    return in_buckets(df, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), KEY, name, sort=True)


def repeated_keys(lines: DataFrame, min_docs: int, batches: int = BATCHES, fanout: int = FANOUT) -> tuple[DataFrame, int]:
    """(h1, h2, rows, keeper) of the keys in at least min_docs documents, and
    the least rows of a hot key. rows counts the batches in which the key was
    hot, and is 0 for the others."""
    spark = lines.sparkSession
    shares = [i / batches for i in range(1, batches)] or [1.0]
    cuts, total = lines.agg(F.percentile_approx("doc", shares), F.count(F.lit(1))).first()
    edges = [None, *(sorted(set(cuts or [])) if batches > 1 else []), None]
    least = max(1, total // (HOT_SHARE * batches))
    runs, parts = LineRuns(min_docs, fanout), []
    before = spark.conf.get(SORTED_SCAN, "false")
    spark.conf.set(SORTED_SCAN, "true")  # a bucket is one file, sorted as it was written
    try:
        for low, high in reversed(list(zip(edges, edges[1:]))):
            part = lines
            part = part if low is None else part.where(F.col("doc") > low)
            part = part if high is None else part.where(F.col("doc") <= high)
            per_doc = part.groupBy(*KEY, "doc").agg(F.count(F.lit(1)).alias("rows"))
            per_key = per_doc.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.sum("rows").alias("rows"), F.max("doc").alias("keeper"))
            parts.append(sorted_run(per_key, "batch"))
            runs.add(parts[-1].drop("rows"))
    finally:
        spark.conf.set(SORTED_SCAN, before)
    hot = reduce(DataFrame.unionByName, [p.where(F.col("rows") >= least).select(*KEY, "rows") for p in parts]).groupBy(*KEY).agg(F.sum("rows").alias("rows"))
    keys = runs.settled().join(F.broadcast(hot), KEY, "left")  # at most HOT_SHARE * batches rows
    return keys.select(*KEY, F.coalesce("rows", F.lit(0)).alias("rows"), "keeper"), least


def without_positions(lines: Column, dropped: Column) -> Column:
    """The array without its elements at the sorted positions (from 0): the
    slices between one dropped element and the next, in linear time."""
    n = F.size(lines)
    marks = F.concat(F.array(F.lit(-1)), dropped, F.array(n))
    parts = F.transform(
        F.sequence(F.lit(1), F.size(marks) - 1),
        lambda i: F.slice(lines, F.element_at(marks, i) + 2, F.element_at(marks, i + 1) - F.element_at(marks, i) - 1),
    )
    return F.flatten(parts)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """docs with three more columns: n_lines, n_dropped and kept_text."""
    lines = stage(line_table(docs, id_col, text, min_chars), "lines")
    repeated, least = repeated_keys(lines, min_docs, batches, fanout)
    found = join_groups(lines, stage(repeated, "repeated"), KEY, "rows", least * HOT_SHARE).where(F.col("doc") != F.col("keeper"))
    d, h, pos, ls = fresh(docs, "_doc", "_text_hash", "_dropped", "_lines")
    drops = found.groupBy(F.col("doc").alias(d), F.col("text_hash").alias(h)).agg(F.array_sort(F.collect_set("pos")).alias(pos))
    rows = docs.withColumns({d: F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), h: F.xxhash64(text_or_empty(text))})
    rows = rows.join(drops, [d, h], "left").withColumn(ls, split_lines(text))
    kept = F.when(F.col(pos).isNull(), text_or_empty(text)).otherwise(F.array_join(without_positions(F.col(ls), F.col(pos)), "\n"))
    return rows.select(
        *docs.columns, F.size(ls).cast("long").alias("n_lines"), F.coalesce(F.size(pos), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"),
    )


def line_digest(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS dropped FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""
