"""Paths over several relationships, by rounds of frontier expansion."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .graph import EDGE, NODE, no_props, of_type
from .joins import split_join


def _ends(edges: DataFrame, both_ways: bool) -> DataFrame:
    """(at_label, at_key, to_label, to_key, edge): every step that can be taken."""
    edge = F.struct(*EDGE).alias("edge")
    step = lambda a, b: edges.select(
        F.col(f"{a}_label").alias("at_label"),
        F.col(f"{a}_key").alias("at_key"),
        F.col(f"{b}_label").alias("to_label"),
        F.col(f"{b}_key").alias("to_key"),
        edge,
    )
    if not both_ways:
        return step("src", "dst")
    # A relationship from a node to itself is one step, not two.
    loop = (F.col("src_label") == F.col("dst_label")) & (F.col("src_key") == F.col("dst_key"))
    back = edges.filter(~loop)
    there = step("src", "dst")
    return there.union(
        back.select(
            F.col("dst_label").alias("at_label"),
            F.col("dst_key").alias("at_key"),
            F.col("src_label").alias("to_label"),
            F.col("src_key").alias("to_key"),
            edge,
        )
    )


def match_paths(
    sources: DataFrame, edges: DataFrame, rels: Sequence[str], least: int, most: int, both_ways: bool = False
) -> DataFrame:
    """(nodes, edges) of every path of `least` to `most` relationships of the given types.

    `sources` (label, key) are the nodes where paths begin; `nodes` is an array of (label, key) in
    their order, one more than `edges`. No relationship is used twice in a path, a node may be. With
    `both_ways` relationships are followed against their direction too. A path of length 0 is its source.

    Each round joins the ends of the paths found so far to the steps from there and is written; a hub, where many
    paths end or many steps begin, is split over tasks. Paths are as many as they are: bound
    `most`, and take few sources.
    """
    if not 0 <= least <= most:
        raise ValueError(f"no path has {least} to {most} relationships")
    empty = F.array().cast(f"array<struct<{', '.join(f'{c}: string' for c in EDGE)}>>")
    node = F.struct("label", "key")
    started = sources.select(*NODE).distinct()
    paths = started.select(F.array(node).alias("nodes"), empty.alias("edges"), F.col("label").alias("at_label"), F.col("key").alias("at_key"))
    steps = _ends(of_type(edges, rels), both_ways)
    rounds = [paths]
    for _ in range(most):
        # Only what begins where some path ends is made distinct; the others are passed over where they are read.
        ends = rounds[-1].select("at_label", "at_key").distinct()
        onward = split_join(steps, ends, ["at_label", "at_key"], "left_semi").distinct()
        longer = split_join(rounds[-1], onward, ["at_label", "at_key"]).filter(~F.array_contains("edges", F.col("edge")))
        longer = longer.select(
            F.array_append("nodes", F.struct(F.col("to_label").alias("label"), F.col("to_key").alias("key"))).alias("nodes"),
            F.array_append("edges", F.col("edge")).alias("edges"),
            F.col("to_label").alias("at_label"),
            F.col("to_key").alias("at_key"),
        )
        rounds.append(stored(longer, "paths"))
    wanted = [r.select("nodes", "edges") for r in rounds[least:]]
    return reduce(DataFrame.union, wanted)


def path_id(edges: Column, nodes: Column) -> Column:
    return F.sha2(F.to_json(F.struct(nodes, edges)), 256)


def with_properties(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """The same paths, each node with its properties: `nodes` becomes an array of (label, key, props).

    Only names of paths and nodes are shuffled with the properties; a node on very many paths is split.
    """
    named = paths.withColumn("_path", path_id(F.col("edges"), F.col("nodes")))
    steps = named.select("_path", F.posexplode("nodes").alias("_at", "_n")).select("_path", "_at", "_n.*")
    props = nodes.select(*NODE, "props")
    found = split_join(steps, props, NODE, "left")
    one = F.struct("_at", F.struct(*NODE, F.coalesce("props", no_props()).alias("props")).alias("node"))
    back = found.groupBy("_path").agg(F.array_sort(F.collect_list(one), _by_place).alias("_steps"))
    joined = split_join(named.drop("nodes"), back, "_path")
    return joined.select(F.transform("_steps", lambda s: s["node"]).alias("nodes"), "edges")


def _by_place(a: Column, b: Column) -> Column:
    return a["_at"] - b["_at"]
