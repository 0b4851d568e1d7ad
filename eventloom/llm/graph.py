"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import staged, unstaged


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for each node of ``links(a, b)``; a component is named by its smallest node.

    Large-star and small-star in turn, until a round changes no link: each node hands its larger
    neighbours to its smallest one, then its smaller ones. Links never grow in number, a node's
    neighbours are aggregated and not collected, and the number of rounds follows the logarithm of
    the number of nodes. Each round is a written table, which goes when the next one stands. A null end is no link; repeated
    links count once, and no links give an empty table.
    """
    edges = staged(links.select("a", "b").filter("a <> b").dropDuplicates(), "links")
    settled = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).dropDuplicates()
        large = staged(large, "links")
        old = edges
        # each node's smaller neighbours, all linked to the smallest of them
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small_least.select("a", F.col("m").alias("b")))
        edges = staged(small.filter("a <> b").dropDuplicates(), "links")
        unstaged(old, large)
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (row["n"], row["h"]) == settled:
            break
        settled = (row["n"], row["h"])
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).dropDuplicates()
