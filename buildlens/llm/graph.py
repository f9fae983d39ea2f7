"""Connected components of a graph that is spread over the cluster.

Hubs and large components make keys that many rows share. Every join here is one of written tables, with
no aggregate on its key, so that adaptive execution can deal the rows of such a key to many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved

def _ends(pointers: DataFrame) -> DataFrame:
    """(node, parent): where each chain of pointers to smaller nodes ends. Each written round leaves a third of a chain's steps."""
    while True:
        above = pointers.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        once = pointers.join(above, "parent").select("node", F.col("parent").alias("was"), F.col("above").alias("parent"))
        new = saved(once.join(above, "parent").select("node", "was", F.col("above").alias("parent")))
        if new.filter("was <> parent").isEmpty():
            return new.select("node", "parent")
        pointers = new.select("node", "parent")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all ends of the links (a, b): component is the smallest node reachable.

    In a round every node points to its least neighbour, if that is smaller; chains of pointers are followed
    to their ends by doubling, and the graph is contracted: each link joins the ends of its own ends, links
    within one end go. Every tree has two nodes at least, so the nodes that are left at least halve, and
    each round works on what is left only.
    """
    least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = saved(links.filter("a <> b").select(least, most).distinct())
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = _ends(saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("near", "node").alias("parent"))))
        if labels is None:
            labels = ends.select("node", F.col("parent").alias("component"))
        else:
            labels = saved(labels.join(ends.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("parent", "component").alias("component")))
        for end, other in (("a", "b"), ("b", "a")):
            edges = edges.join(ends.select(F.col("node").alias(end), F.col("parent").alias("end")), end).select(F.col("end").alias(end), other)
        edges = saved(edges.filter("a <> b").select(least, most).distinct())
    return labels
