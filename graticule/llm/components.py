"""Connected components of a graph of links, by joins and small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.session import cut_lineage

FEW = 1000  # links up to which one task looks at them


def _renamed(links: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``links`` with the nodes of a column by their roots, where they have one."""
    called = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return links.join(called, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Nodes of ``links`` (a, b: long) with the smallest node that they reach: node, root.

    Every round gives a node the smallest root among itself and its neighbours and then
    the root of that root, so chains shorten by halves. Rounds are checkpointed; only
    the number of changed nodes comes to the driver. A node with very many links is
    pre-aggregated before the shuffle. ``known`` are the components of earlier links: new links
    join their roots, and the earlier ones are not looked at again.
    """
    if known is not None:
        links = cut_lineage(_renamed(_renamed(links.select("a", "b"), "a", known), "b", known))
        fresh = components(links)
        return cut_lineage(_renamed(known, "root", fresh).unionByName(fresh.join(known.select("node"), "node", "left_anti")))
    both = cut_lineage(links.where("a <> b").select("a", "b").unionByName(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    if both.count() <= 2 * FEW:
        both = both.coalesce(1)
    roots = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        stepped = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        above = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
        stepped = cut_lineage(stepped.join(above, "root", "left").select("node", "old", F.least("root", F.coalesce("above", "root")).alias("root")))
        changed = stepped.where("root <> old").limit(1).count()
        roots = stepped.select("node", "root")
        if not changed:
            return roots
