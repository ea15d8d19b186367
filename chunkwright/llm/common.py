"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.session import scratch_path, ship_code, stage

SPACE = "\\x20\\x09-\\x0D"  # inside a character class
WORD = f"[^{SPACE}]+"
STRIP = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOT_SHARE = 1000  # a group with at least 1/1000 of all rows is hot: there are at most 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code()
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code()
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only. Pure ASCII strings take the byte-wise path."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with none of df's (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def stage_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``stage``, but in buckets of ``key``: later joins on it shuffle
    only their other side. The table's entry is of this session alone, its
    files lie with the other stages."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(n, key).write.bucketBy(n, key).saveAsTable(table, format="parquet", path=path)
    return spark.read.table(table)


def drop_stage(df: DataFrame) -> None:
    """Removes the files of a table made by ``stage`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if f"chunkwright-{spark.sparkContext.applicationId}/" in folder:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def in_buckets(df: DataFrame, n: int, keys: list[str], name: str, sort: bool = False) -> DataFrame:
    """Rows already dealt by hash of the keys into n partitions, written as n
    buckets (sorted by the keys if asked for) and read back: a join or
    co-grouping on the keys doesn't shuffle them again."""
    path = scratch_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    out = df.write.bucketBy(n, *keys)
    (out.sortBy(*keys) if sort else out).saveAsTable(table, format="parquet", path=path)
    return df.sparkSession.read.table(table)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """rows inner-joined to a table with one row per group, where a few groups
    may hold most rows. Hot groups (at least total/HOT_SHARE rows, so at most
    HOT_SHARE of them) are broadcast; the rows of all others meet their group
    in an ordinary shuffle join whose largest key is below that share.
    Null keys match null keys."""
    least = max(1, total // HOT_SHARE)
    hot = groups.where(F.col(size) >= least)
    cold = groups.where(F.col(size) < least)

    def on(a: DataFrame, b: DataFrame) -> Column:
        cond = F.lit(True)
        for k in keys:
            cond = cond & a[k].eqNullSafe(b[f"_g_{k}"])
        return cond

    def renamed(g: DataFrame) -> DataFrame:
        return g.withColumnsRenamed({k: f"_g_{k}" for k in keys})

    h, c = renamed(hot), renamed(cold)
    names = h.select([f"_g_{k}" for k in keys])
    drop = [f"_g_{k}" for k in keys]
    first = rows.join(F.broadcast(h), on(rows, h)).drop(*drop)
    rest = rows.join(F.broadcast(names), on(rows, names), "left_anti")
    return first.unionByName(rest.join(c, on(rest, c)).drop(*drop))


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """df with a gapless global row number from 0 in the given order: a range
    sort, an index inside each partition, and the partitions' offsets (one
    row for each partition, so a small broadcast). The sorted rows are staged
    once, which fixes the partitions."""
    (tag,) = fresh(df, "_tag")
    rows = stage(df.orderBy(*order).withColumn(tag, F.monotonically_increasing_id()), "sorted")
    part = F.shiftright(F.col(tag), 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.selectExpr("_part", "coalesce(sum(_n) over (order by _part rows between unbounded preceding and 1 preceding), 0L) as _before")
    at = F.col("_before") + F.col(tag).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(offsets), part == F.col("_part")).withColumn(name, at).drop(tag, "_part", "_before")


__all__ = ["SPACE", "WORD", "STRIP", "UPPER", "LOWER", "documents", "embeddings", "text_or_empty", "ascii_lower", "drop_stage", "fresh", "in_buckets", "join_groups", "numbered", "stage", "stage_by"]
