"""Answers to pattern questions over the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import catalogue_line, schema_line
from ..operators.aggregates import property_catalogue, schema_summary
from ..operators.graph import EDGE, match_nodes, match_pattern
from ..operators.views import hop_nodes, subgraph_edges, subgraph_nodes


def ask(
    nodes: DataFrame,
    edges: DataFrame,
    src_label: str,
    rel: str,
    dst_label: str,
    prop: str,
    value: str,
    mode: str = "contains",
) -> DataFrame:
    """(source)-[rel]->(target) for sources whose property matches."""
    return match_pattern(match_nodes(nodes, src_label, prop, value, mode), edges, rel, nodes, src_label, dst_label)


def answer_graph(hops: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The answer as drawable nodes and edges; `nodes` are the graph's."""
    found = hop_nodes(hops, nodes)
    return subgraph_nodes(found), subgraph_edges(hops.select(*EDGE), found)


def schema_text(edges: DataFrame) -> DataFrame:
    """One line per kind of edge."""
    triples = schema_summary(edges)
    return triples.select(schema_line(F.col("from"), F.col("rel_type"), F.col("to")).alias("line"))


def catalogue_text(nodes: DataFrame) -> DataFrame:
    """One line of property names per label."""
    return property_catalogue(nodes).select(catalogue_line(F.col("label"), F.col("properties")).alias("line"))
