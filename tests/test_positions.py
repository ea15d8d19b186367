"""Positions inside groups, over several partitions a group."""

import random

import pytest
from pyspark.sql import functions as F

from chunkwright.operators.positions import child_rows, positions
from chunkwright.session import stage


def _check(got, rows):
    by = {}
    for g, h, o in rows:
        by.setdefault((g, h), []).append(o)
    want = sorted(((g, h, i, o) for (g, h), os in by.items() for i, o in enumerate(sorted(os))), key=str)
    assert sorted(((r.g, r.h, r.position, r.o) for r in got), key=str) == want


@pytest.mark.parametrize("seed", range(4))
def test_random_groups(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "b", None, "c" * 3]), rnd.choice([1, 2, None]) if seed else 1, o) for o in rnd.sample(range(10**6), 400)]
    df = spark.createDataFrame(rows, "g string, h int, o long").repartition(3)
    _check(positions(df, ["g", "h"], ["o"]).collect(), rows)


def test_one_group_over_all_partitions(spark):
    rows = [("only", 1, o) for o in range(5000)] + [("z", 1, 1)]
    df = spark.createDataFrame(rows, "g string, h int, o long")
    out = stage(positions(df, ["g", "h"], ["o"]).withColumn("part", F.spark_partition_id()), "positions")
    _check(out.collect(), rows)
    assert out.where("g = 'only'").select("part").distinct().count() > 1
    assert positions(df.where("o < 0"), ["g", "h"], ["o"]).collect() == []


def test_a_large_folder_is_rows_of_many_tasks(spark):
    nodes = spark.range(20000).selectExpr("'big' AS parent", "concat('f', lpad(id, 6, '0')) AS name", "if(id % 10 = 0, 'dir', 'file') AS kind")
    out = child_rows(nodes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan
    rows = out.where("kind = 'file'").orderBy("position").collect()
    assert [r.position for r in rows] == list(range(18000)) and [r.name for r in rows] == sorted(r.name for r in rows)
