"""Connected components of an edge table by contraction, all on the executors.

Every round points each node to its smallest neighbour (or itself), replaces the ends of the edges by what they
point to, and drops the loops; pointers are composed as they come. Rounds end when no edge is left; their number
grows with the logarithm of the longest chain of falling ids. A round's tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, staged


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b. node, component for every node of an edge; component is the least id that is connected.

    Null ends are dropped, loops link nothing, repeated edges count once; no edges give an empty table."""
    e = staged(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = staged(e.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "cc-labels")
    while not e.isEmpty():
        # a < b in every edge, so only b can have a smaller neighbour through it
        point = staged(e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")), "cc-point")
        to = lambda x, c: x.join(point.select(F.col("node").alias(c), F.col("to").alias(f"_{c}")), c, "left").withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
        moved = to(to(e, "a"), "b").filter("a <> b")
        then = staged(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
        next_labels = staged(to(labels, "component").select("node", "component"), "cc-labels")
        drop_staged(e, labels, point)
        e, labels = then, next_labels
    # a pointer's end may itself have been moved in the same round: follow to the fixed point
    while True:
        roots = labels.select(F.col("node").alias("component"), F.col("component").alias("_root")).filter("component <> _root")
        deeper = labels.join(roots, "component", "left")
        if labels.join(roots, "component", "left_semi").isEmpty():
            return labels
        then = staged(deeper.select("node", F.coalesce("_root", "component").alias("component")), "cc-labels")
        drop_staged(labels)
        labels = then
