"""Connected components by joins; each step is staged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.sources.staging import stage, stage_and_measure


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node reachable.

    Every node takes the least label among its own and its neighbours', then its
    label's label, until nothing changes; the second step halves the way to go. A node
    with very many edges is merged from partial minima, and joins on it are split by
    the adaptive skew join.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.filter("a != b").distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        offered = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("offer"))
        nearer = labels.join(offered, labels.node == offered.a).select("node", F.col("root").alias("was"), F.least("root", "offer").alias("root"))
        nearer = stage(nearer, "labels")
        above = nearer.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = nearer.join(above, "root").select("node", "was", F.col("top").alias("root"))
        jumped, seen = stage_and_measure(jumped, "labels", changed=F.count_if(F.col("root") != F.col("was")))
        labels = jumped.select("node", "root")
        if not seen["changed"]:
            return labels
