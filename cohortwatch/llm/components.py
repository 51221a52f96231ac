"""Connected components of an edge table by minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwatch.session import cut_lineage


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b: long).

    Each round a node takes the least label among its own and its neighbours', then the
    label of that label (pointer jumping), so long paths shrink by powers of two. Labels
    are minima, combined before the shuffle; a node with very many neighbours is a
    skewed join key, which adaptive execution splits. Rounds are cut by checkpoints. Self
    links and repeated edges do no harm; no edges give no rows.
    """
    both = edges.select("a", "b").where("a <> b")
    both = cut_lineage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component"))
    labels = cut_lineage(labels)
    for _ in range(max_rounds):
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        taken = labels.join(near, labels.node == near.a).select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("jump"))
        moved = taken.join(jump, "next").select("node", F.least("next", "jump").alias("component"), (F.least("next", "jump") < F.col("component")).alias("moved"))
        moved = cut_lineage(moved)
        labels = moved.select("node", "component")
        if moved.where("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
