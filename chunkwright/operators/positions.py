"""Gapless positions inside groups of any size (F2, E5, E8, E9).

``row_number`` over a window gives one task a whole group. Here the rows are
sorted into ranges of (group, order), so a large group lies in several
partitions; each task numbers the groups inside its own partition as it
writes it. Only the group that a partition starts with can have begun before
it, so what is missing is one offset a partition: a table of as many rows as
there are partitions, broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.session import stage


def _starts(columns: list) -> np.ndarray:
    """Whether a row's group differs from the row's before (nulls are equal);
    the first row counts as different."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    out[:1] = True
    for c in columns:
        a, b = c.slice(1), c.slice(0, n - 1)
        other = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        out[1:] |= other.to_numpy(zero_copy_only=False)
    return out


def _numbered(group: list[str]):
    """Adds task and the place inside the group's stretch in this task."""

    def run(batches):
        task, last, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(batch.schema.get_field_index(g)) for g in group]
            new = _starts(columns)
            key = [c[0].as_py() for c in columns]
            new[0] = last is None or key != last
            at = np.arange(n)
            begin = np.maximum.accumulate(np.where(new, at, -1))
            local = np.where(begin >= 0, at - begin, at + place)
            last, place = [c[n - 1].as_py() for c in columns], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, task, np.int32)), pa.array(local, pa.int64())], [*batch.schema.names, "_task", "_place"])

    return run


def positions(df: DataFrame, group: list[str], order: list[str], name: str = "position") -> DataFrame:
    """df with a gapless position from 0 inside each group, in the given
    order. Rows of a group that tie in the order get their positions in any
    order. The input is staged first, as finding ranges reads it twice."""
    rows = stage(df, "ungrouped")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *group, *order).sortWithinPartitions(*group, *order)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + ["_task int", "_place bigint"])
    placed = stage(ranged.mapInArrow(_numbered(group), schema), "numbered")
    key = F.struct(*group)
    # a partition's rows were written in order, but may be read in any: its
    # first group is its least, its last the greatest
    ends = placed.groupBy("_task").agg(F.min(key).alias("first"), F.max(F.struct(key.alias("k"), F.col("_place").alias("p"))).alias("last")).orderBy("_task").collect()
    offsets, carried, before = [], 0, None
    for r in ends:
        continues = before is not None and before == r["first"]
        offsets.append((r["_task"], *r["first"], carried if continues else 0))
        # the last group goes on from the offset only if it is the first as well
        carried = r["last"]["p"] + 1 + (carried if continues and r["last"]["k"] == r["first"] else 0)
        before = r["last"]["k"]
    names = [f"_first{i}" for i in range(len(group))]
    kinds = ", ".join(f"{a} {df.schema[g].dataType.simpleString()}" for a, g in zip(names, group))
    table = df.sparkSession.createDataFrame(offsets, f"_task int, {kinds}, _offset bigint")  # one row a partition
    same = F.lit(True)
    for a, g in zip(names, group):
        same = same & F.col(a).eqNullSafe(F.col(g))
    out = placed.join(F.broadcast(table), "_task")
    return out.withColumn(name, F.col("_place") + F.when(same, F.col("_offset")).otherwise(0)).select(*df.columns, name)


def child_rows(nodes: DataFrame) -> DataFrame:
    """(path, kind, position, name): the entries of every folder as rows, in
    name order, folders and files counted apart."""
    rows = nodes.select(F.col("parent").alias("path"), "kind", "name")
    return positions(rows, ["path", "kind"], ["name"]).select("path", "kind", "position", "name")
