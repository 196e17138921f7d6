"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medstar.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node of ``links``: label is the smallest
    node of its component.

    Rounds of "smallest label among the neighbours" followed by pointer
    jumping; the labels of a round are written to shared storage, so lineage
    stays short.  Every aggregate is a combinable ``min``; links of a hub are
    spread by the join's skew handling, no group is ever collected.
    """
    edges = cut(links.select(F.col(a).alias("src"), F.col(b).alias("dst"))
                .union(links.select(F.col(b).alias("src"), F.col(a).alias("dst")))
                .filter("src is not null and dst is not null and src != dst").distinct(),
                "edges")
    labels = cut(edges.groupBy(F.col("src").alias("node"))
                 .agg(F.min("dst").alias("near"))
                 .select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = (edges.join(labels, edges.dst == labels.node)
                .groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near")))
        hop = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        over = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        new = cut(hop.join(over, hop.label == over.via)
                  .select("node", "old", F.least("label", "far").alias("label")), "labels")
        changed = new.filter("old != label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
