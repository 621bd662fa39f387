"""Connected components of a graph of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwine.plans.durable import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of `edges` (a, b) the least node it is connected with.

    Labels spread to neighbours and jump along labels until none changes, each round over the edges only;
    every round is written to the shared checkpoint folder.
    """
    both = durable(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")))
    while True:
        spread = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        nxt = labels.join(spread, "node").join(jump, "root", "left").select("node", F.least("root", "near", "far").alias("new"), "root")
        nxt = durable(nxt)
        if nxt.where("new <> root").isEmpty():
            return labels
        labels = nxt.select("node", F.col("new").alias("root"))
