"""Connected components of a large graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgauge.llm.workspace import Workspace


def connected_components(links: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """(id, component) for every id that occurs in ``links`` (a, b: long): the smallest id it reaches.

    Each round gives every node its smallest neighbour as parent (a larger node is never a parent, so
    parents form a forest), shortens the paths to the roots by doubling, and replaces links by those
    between roots. Every node that has a link gets merged, so a round at least halves what is left.
    Neighbour minima are combined before the shuffle; joins are between stored tables, which lets
    Spark split nodes with very many links. Only counts reach the driver.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = links.select("a", "b").where("a <> b").distinct()
    edges = work.table(edges, f"{name}-links-0")
    known = None
    for turn in range(1, 100):
        parents = both(edges).groupBy("a").agg(F.min("b").alias("b"))
        parents = parents.select(F.col("a").alias("id"), F.least("a", "b").alias("root"))
        parents = work.table(parents, f"{name}-parents-{turn}-0")
        for step in range(1, 64):
            up = parents.select(F.col("id").alias("root"), F.col("root").alias("above"))
            longer = parents.join(up, "root").select("id", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved"))
            longer = work.table(longer, f"{name}-parents-{turn}-{step}")
            parents = longer.select("id", "root")
            if longer.where("moved").isEmpty():
                break
        roots = parents.select("id", "root")
        if known is None:
            known = roots.select("id", F.col("root").alias("component"))
        else:
            above = roots.select(F.col("id").alias("component"), "root")
            known = known.join(above, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
            known = work.table(known, f"{name}-known-{turn}")
        a = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        edges = edges.join(a, "a").select("ra", "b").where("ra <> b").distinct().join(b, "b").where("ra <> rb")
        edges = edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        edges = work.table(edges, f"{name}-links-{turn}")
        if edges.isEmpty():
            break
    return known
