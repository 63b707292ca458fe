"""Connected components of a distributed edge table, by hooking to the least neighbour and jumping to the root."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.workspace import stored


def flattened(parents: DataFrame) -> DataFrame:
    """``node``, ``root`` for a forest of ``node``, ``root``: a row per node that has a parent, which is less than the node.

    Each round takes every node to its parent's parent, so that rounds grow with the logarithm of the depth.
    """
    parents = parents.select("node", "root")
    while True:
        above = parents.toDF("root", "above").hint("merge")
        deep = F.col("above").isNotNull().alias("deep")
        jumped = stored(parents.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"), deep), "edges")
        parents = jumped.select("node", "root")
        if not jumped.where("deep").count():
            return parents


def _renamed(table: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """``table``, with the roots that ``found`` has for the nodes in ``column``."""
    found = found.toDF(column, "new_root").hint("merge")
    return table.join(found, column, "left").withColumn(column, F.coalesce("new_root", column)).drop("new_root")


def merged(edges: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``u``, ``v``) and ``found`` but the roots, stored.

    The root is the least node of the component.  ``found`` has the same form, for other edges.

    Each round hooks every node to its least neighbour, if that is less, flattens the trees, and leaves
    the edges between different trees, as edges of their roots, to the next round.  Every edge hooks one of
    its ends at least.  Rounds are written to the shared folder.  A node with very many neighbours is reduced
    by a minimum with map-side combine, and the joins are ones whose large side Spark can split.  No side
    is broadcast: that would take every round through the driver.
    """
    rest = edges.select("u", "v")
    new = found
    while True:
        if new is not None:
            rest = _renamed(_renamed(rest, "u", new), "v", new)
        rest = rest.where(F.col("u") != F.col("v"))
        if new is not None:
            rest = stored(rest, "edges")
            if not rest.count():
                return found
        both = rest.unionByName(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).where(F.col("root") < F.col("node"))
        new = flattened(stored(least, "edges"))
        found = new if found is None else stored(_renamed(found, "root", new).select("node", "root").unionByName(new), "components")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``u``, ``v``): the root is the least node of its component."""
    found = merged(edges)
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
