"""Connected components by joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Columns node, root (the smallest node reachable) for every node of `edges` (a bigint, b bigint).

    Each round a node takes the smallest label around it and then that label's own label, so that chains
    shrink by doubling. Labels are written to the shared folder between rounds; the driver sees a count.
    A hub's rows meet in joins that AQE can split and in partial minima.
    """
    both = written(edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    while True:
        around = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("low"))
        lower = labels.join(around, labels.node == around.a, "left").select(
            "node", F.col("root").alias("old"), F.least("root", "low").alias("root")
        )
        lower = written(lower, "labels")
        # a root's own label: nodes that are their own root need no row
        far = lower.where("root != node").select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        jumped = lower.join(far, lower.root == far.n2, "left").select(
            "node", "old", F.coalesce("r2", "root").alias("root")
        )
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "root")
        if jumped.where("root != old").isEmpty():
            return labels
