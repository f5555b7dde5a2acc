"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _lowest(links: DataFrame) -> DataFrame:
    """For each node ``u`` of the directed links (u, v): the least of u and its neighbours.

    Stored, so that joining it back is a plain shuffle join, in which a node that holds a
    large part of all links can be split.
    """
    return stored(links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b of one orderable type); root is its component's least node.

    Alternating large-star and small-star rounds, each a grouped minimum and a join back;
    the number of rounds grows with the logarithm of the component size. Every round is
    written to the shared folder, so a lost executor costs one round. Links to itself are
    allowed; nulls are not. A node that only links to itself is its own root.
    """
    links = links.select("a", "b").distinct()
    loops = links.where("a = b").select(F.col("a").alias("node"))
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        both = edges.union(edges.select("v", "u"))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = _lowest(large)
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "links")
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    alone = loops.join(found.select("node").union(roots.select("node")), "node", "left_anti")
    return found.union(roots).union(alone.select("node", F.col("node").alias("root")))
