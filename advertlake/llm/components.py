"""Connected components of a table of links, as a few joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advertlake.session import stage


def connected(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` of every node of ``links`` (``a, b``); the root is some node of the component, the same for all.

    Every round each node points to its smallest neighbour, pointers are followed to their end, and the links between
    the ends go on to the next round. A round at least halves the nodes of every component, so their number grows with
    the logarithm of the largest one. Links to itself and nulls are ignored.
    """
    edges = stage(links.select("a", "b").filter("a <> b").distinct(), label)
    roots: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("b"))
        pointers = stage(near.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), label)
        while True:
            ends = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
            followed = stage(pointers.join(ends, "root").select("node", F.col("next").alias("root"), (F.col("root") != F.col("next")).alias("moved")), label)
            pointers = followed.select("node", "root")
            if followed.filter("moved").isEmpty():
                break
        if roots is None:
            roots = pointers
        else:
            up = pointers.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            roots = stage(roots.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), label)
        ends_a = pointers.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        ends_b = pointers.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = edges.join(ends_a, "a").join(ends_b, "b").filter("ra <> rb")
        edges = stage(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), label)
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return roots
