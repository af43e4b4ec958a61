"""Connected components of a large edge list, by contraction, in DataFrame rounds.

Every node points to its smallest neighbour (itself included). Pointers are followed twice,
edges are redrawn between the ends reached, loops and repeats go, and the next round works on
what is left; random labels leave a fraction of the nodes each round. Each round is cut by
tables written to the shared folder, so that a lost executor costs one round at most. Only
whether edges remain reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every node of (src, dst): one root, itself a node, for each component.

    The result's table belongs to ``scratch``; those of earlier rounds are removed on the way.
    """
    keeper, labelled = scratch or Scratch(), Scratch()
    part = Scratch()
    left = part.written(edges.select("src", "dst").filter("src <> dst").distinct())
    labels: DataFrame | None = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        up = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).select("node", F.least("node", "low").alias("up"))
        for _ in range(2):
            above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            up = up.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
        up = part.written(up)
        if labels is None:
            labels = up.withColumnRenamed("up", "root")
        else:
            moved = up.select(F.col("node").alias("root"), "up")
            labels = labels.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        newer = Scratch()
        labels = newer.written(labels)
        labelled.drop()
        labelled = newer
        ends = up.select(F.col("node").alias("src"), F.col("up").alias("a"))
        other = up.select(F.col("node").alias("dst"), F.col("up").alias("b"))
        redrawn = left.join(ends, "src").join(other, "dst").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
        newer = Scratch()
        left = newer.written(redrawn.filter("src <> dst").distinct())
        part.drop()
        part = newer
    if labels is None:
        keeper.adopt(part)
        return left.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    part.drop()
    keeper.adopt(labelled)
    return labels
