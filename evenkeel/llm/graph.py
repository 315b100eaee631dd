"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.scratch import discard, save


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``.

    The component is the smallest node that can be reached. Each round hands the
    smallest label to all neighbours and then follows labels of labels, so the
    number of rounds grows with the logarithm of a chain's length. All steps are
    joins and combined minima; no neighbour list is ever gathered, and each
    round starts from a written table.
    """
    both = save(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    labels = save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
                  .select("node", F.least("node", "other").alias("component")), "labels")
    while True:
        offered = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("offer"))
        )
        lowered = labels.join(offered, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "offer").alias("component")
        )
        stepped = save(lowered, "lowered")
        target = stepped.select(F.col("node").alias("component"), F.col("component").alias("root"))
        following = save(
            stepped.join(target, "component").select("node", "before", F.col("root").alias("component")),
            "labels",
        )
        discard(stepped)
        discard(labels)
        labels = following.select("node", "component")
        if following.where("component <> before").isEmpty():
            discard(both)
            return labels
