"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for every node that has a link.

    ``edges`` has (a, b). A large-star step hangs the larger neighbours of a node on its
    smallest one, a small-star step the smaller ones; the links shrink to stars in a
    number of rounds that grows with the logarithm of the largest component. Each round
    is stored, so its lineage stays short and a lost executor costs one round. A node
    with very many links is folded by partial aggregation and split by the join.
    """
    links = edges.select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    ).filter("node <> root")
    links = stored(links.distinct(), "components")
    state = _digest(links)
    while state[0]:
        links = stored(_small_star(_large_star(links)), "components")
        after = _digest(links)
        if after == state:
            break
        state = after
    return links


def _digest(links: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), digest).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node, linked to the smallest of the node's surroundings."""
    both = links.select("node", "root").unionAll(
        links.select(F.col("root").alias("node"), F.col("node").alias("root"))
    )
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    return (
        both.filter("root > node").join(least, "node")
        .select(F.col("root").alias("node"), F.col("least").alias("root"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, linked to the smallest of them."""
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    moved = links.join(least, "node").filter("root <> least").select(
        F.col("root").alias("node"), F.col("least").alias("root")
    )
    return moved.unionAll(least.select("node", F.col("least").alias("root"))).distinct()
