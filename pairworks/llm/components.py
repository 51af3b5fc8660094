"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `links` (a, b), the component being its smallest node.

    Large-star and small-star rounds: neighbours larger than a node are attached to its smallest neighbour, then smaller ones
    are, until nothing changes; the number of rounds grows with the logarithm of the longest path.  A hub is a hot key of an
    aggregate and of a join, never a list.  Each round is written to the shared folder.  Links to itself and repeated links
    do no harm; null ends are left out.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("a is not null and b is not null and a <> b").distinct(), "links")
    for _ in range(most_rounds):
        # done when all links are stars: each node has one link down, to a node that has none
        ups = edges.groupBy("u").agg(F.count("*").alias("c"))
        if ups.where("c > 1").isEmpty() and edges.join(ups.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.union(low).distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().join(edges.select(F.col("u").alias("node")), "node", "left_anti")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
