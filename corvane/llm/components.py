"""Connected components of a table of edges, by passing on the smallest label and jumping along it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_KEYS, Workspace, attach


def components(edges: DataFrame, ws: Workspace, name: str = "components") -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node that links reach.

    Each round gives a node the smallest label among its own and its neighbours', then the label of that label. Labels are
    written to the shared folder after each round and stay distributed; rounds follow the logarithm of the longest chain.
    Nodes with a great share of all edges, and labels of a great share of all nodes, are met by broadcast.
    """
    both = ws.write(edges.select("a", "b").where("a <> b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct(), f"{name}-edges")
    degrees = both.groupBy("b").agg(F.count("*").alias("n"))
    hubs = ws.write(degrees.where(F.col("n") * HOT_KEYS > both.count()).select("b"), f"{name}-hubs")
    labels, n = ws.write(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), f"{name}-0"), 0
    nodes = labels.count()
    while True:
        seen = attach(both, labels.withColumnRenamed("node", "b"), ["b"], hubs).groupBy("a").agg(F.min("component").alias("near")).withColumnRenamed("a", "node")
        near = ws.write(labels.join(seen, "node").select("node", "component", F.least("component", "near").alias("near")), f"{name}-near")
        large = near.groupBy("near").agg(F.count("*").alias("n")).where(F.col("n") * HOT_KEYS > nodes)
        jump = attach(near, labels.select(F.col("node").alias("near"), F.col("component").alias("far")), ["near"], large, "left")
        n += 1
        least = F.least("near", F.coalesce("far", "near"))
        after = ws.write(jump.select("node", least.alias("component"), (least < F.col("component")).alias("moved")), f"{name}-{n}")
        moved = not after.where("moved").isEmpty()
        ws.drop(f"{name}-{n - 1}")
        labels = after.select("node", "component")
        if not moved:
            ws.drop(f"{name}-edges", f"{name}-near", f"{name}-hubs")
            return labels
