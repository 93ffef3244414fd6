"""Connected components of a graph given as a table of links, by Spark joins.

Every node takes the smallest label among itself and its neighbours, then the
label of its label (so labels travel along paths in doubling steps), until no
label changes.  Each round is a stored table in the shared folder: lineage
stays short and a lost executor re-reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) from links ``a, b``."""
    pairs = links.select("a", "b").filter("a <> b")
    edges = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    if edges.isEmpty():
        return labels.withColumnRenamed("label", "component")
    while True:
        near = (edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        low = (labels.join(near, "node")
               .select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = stored(low.join(jump, "label")
                      .select("node", "was", F.least("label", "further").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.filter("was <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")
