"""Connected components of a table of links, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root): for every node of a link the smallest
    node it is connected with. A round takes the smallest label among a node
    and its neighbours, then that node's own label (pointer jumping); rounds
    stop when none changed. The minimum is summed up before each shuffle, so
    a node with very many links is no hot group."""
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        took = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("up"))
        jump = labels.select(F.col("node").alias("up"), F.col("root").alias("above"))
        step = stage(took.join(jump, "up").select("node", F.least("up", "above").alias("root"), "old"), "labels")
        labels = step.select("node", "root")
        if step.where("root <> old").isEmpty():
            return labels
