"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest reachable node) for every node of ``a, b``.

    Minimum labels travel along the links and then jump to their label's label,
    so chains halve each round. Every round is written, so a lost executor
    never replays earlier ones; it ends when no label changes.
    """
    pairs = links.select("a", "b").where("a <> b")
    edges = materialise(pairs.union(pairs.select("b", "a")).distinct().toDF("node", "other"), "edges")
    labels = materialise(edges.groupBy("node").agg(F.min("other").alias("m"))
                         .select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        around = (edges.join(labels.toDF("other", "c"), "other").groupBy("node").agg(F.min("c").alias("c")))
        hooked = labels.join(around, "node").select("node", "component", F.least("component", "c").alias("c"))
        jump = labels.toDF("c", "cc")
        labels_next = materialise(
            hooked.join(jump, "c").select("node", F.col("component").alias("old"), F.least("c", "cc").alias("component")),
            "labels")
        labels = labels_next.select("node", "component")
        if labels_next.where("old <> component").isEmpty():
            return labels
