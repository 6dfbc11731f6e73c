"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (u long, v long) that is not the smallest of its component.

    Each round hooks every node with a smaller neighbour to its smallest one, shortens the
    resulting trees to their roots by pointer doubling, and contracts the links to roots.
    A round leaves only local minima, so at most half of the linked nodes remain; the
    loop ends when no link is left.  Nothing but an emptiness test reaches the driver."""
    node = lambda c: F.col(c).cast("long")
    edges = cut_lineage(links.select(F.greatest(node("u"), node("v")).alias("hi"),
                                     F.least(node("u"), node("v")).alias("lo")).filter("hi <> lo").distinct())
    labels = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).limit(0)
    while not edges.isEmpty():
        tree = cut_lineage(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")))
        while True:
            up = tree.select(F.col("node").alias("root"), F.col("root").alias("above"))
            tree = cut_lineage(tree.join(up, "root", "left")
                               .select("node", F.coalesce("above", "root").alias("root"),
                                       F.col("above").isNotNull().alias("moved")))
            if tree.filter("moved").isEmpty():
                break
            tree = tree.drop("moved")
        tree = tree.drop("moved")
        up = tree.select(F.col("node").alias("root"), F.col("root").alias("above"))
        labels = cut_lineage(labels.join(up, "root", "left")
                             .select("node", F.coalesce("above", "root").alias("root"))
                             .unionByName(tree))
        hi = tree.select(F.col("node").alias("hi"), F.col("root").alias("hi_root"))
        lo = tree.select(F.col("node").alias("lo"), F.col("root").alias("lo_root"))
        moved = (edges.join(hi, "hi", "left").join(lo, "lo", "left")
                 .select(F.coalesce("hi_root", "hi").alias("a"), F.coalesce("lo_root", "lo").alias("b")))
        edges = cut_lineage(moved.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                            .filter("hi <> lo").distinct())
    return labels
