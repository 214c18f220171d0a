"""Connected components of an undirected edge table, by tables alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): every end of an edge with the smallest node that it
    reaches. edges: (a, b). Labels fall to the least among neighbours, then to
    their label's own label, until none changes; each round is written, so a
    round's cost doesn't grow with their number. Minima are combined before
    rows are exchanged, so a hub needs one row per task."""
    both = scratch.keep(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    if both.isEmpty():
        return both.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels, path = scratch.write(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        offered = both.join(labels, both.a == labels.node).groupBy("b").agg(F.min("component").alias("offer"))
        lower = labels.join(offered, labels.node == offered.b, "left").select("node", F.col("component").alias("old"), F.least("component", F.coalesce("offer", "component")).alias("component"))
        lower, lower_path = scratch.write(lower)
        root = lower.select(F.col("node").alias("root"), F.col("component").alias("further"))
        jumped = lower.join(root, lower.component == root.root, "left").select("node", "old", F.least("component", F.coalesce("further", "component")).alias("component"))
        jumped, new_path = scratch.write(jumped)
        changed = not jumped.filter("component <> old").isEmpty()
        scratch.drop(path)
        scratch.drop(lower_path)
        labels, path = jumped.select("node", "component"), new_path
        if not changed:
            return labels
