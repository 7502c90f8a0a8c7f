"""Connected components of a link table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.session import cut_lineage

MOST_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node reaches, for every node of the links.

    Rounds of two steps: every node takes the smallest label among itself and its neighbours, then the label of its
    label, so a chain of n nodes needs about log n rounds. Labels are combined before each shuffle, so a node with very
    many links is reduced map-side; each round is cut from its lineage. Null ends are left out, self-links only name a
    node, repeated links change nothing, no links give no nodes.
    """
    ends = links.select(F.col(f"`{a}`").alias("node"), F.col(f"`{b}`").alias("other")).dropna()
    edges = cut_lineage(ends.unionByName(ends.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = cut_lineage(edges.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("component")))
    for _ in range(MOST_ROUNDS):
        near = edges.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(F.min("component").alias("near"))
        hop = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("component").alias("root"))
        after = cut_lineage(hop.join(jump, "new", "left").select("node", "component", F.least("new", "root").alias("next")))
        moved = not after.filter(F.col("next") < F.col("component")).isEmpty()
        labels = after.select("node", F.col("next").alias("component"))
        if not moved:
            return labels
    raise RuntimeError(f"labels still move after {MOST_ROUNDS} rounds")
