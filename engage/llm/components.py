"""Connected components of an edge table by alternating stars.

Large-star links every larger neighbour of a node to the smallest node of its
neighbourhood, small-star does so for the smaller ones; repeated until nothing
changes, every node points to the smallest node it can reach.  Each round is
written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm.common import staged


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node ``u``; staged, so that the join with the
    edges has a plain shuffle on either side and a hub's edges can be split."""
    return staged(edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "cc-least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    j = both.filter("v > u").join(least, F.col("u") == F.col("w"))
    return j.select(F.col("v").alias("u"), F.least("m", "w").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    j = edges.join(least, F.col("u") == F.col("w")).filter("v <> m")
    return (j.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct())


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; root is the smallest
    node of its component.  Nodes without a link are not listed."""
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                                 F.least("a", "b").alias("v")).distinct(), "cc-edges")
    before = _state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges = staged(_small_star(staged(_large_star(edges), "cc-large")), "cc-small")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
