"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_join
from .common import written

# Rounds double the reach of the smallest node, so real graphs need a handful.
MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) from links (a, b): the smallest node that each linked node reaches.

    Alternates two steps until nothing changes: every larger neighbour is linked to the
    smallest neighbour, then every smaller one (large and small stars). Smallest neighbours
    are folded before the shuffle and the joins can be split, so a node with very many
    links lands in no single task. Only the number of links and a checksum come to the driver.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        found = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
        now = tuple(found.first())
        if now == before or not now[0]:
            break
        before = now
        edges = written(_small_star(_large_star(edges)), "edges")
    else:
        raise RuntimeError(f"components not found in {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every neighbour larger than a node to the node's smallest neighbour, or to the node."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.filter("b > a")
    return split_join(larger, least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = split_join(edges, least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
