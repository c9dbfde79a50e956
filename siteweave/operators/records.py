"""Query records whose values are scalars, nodes, relationships and paths, mixed in one VARIANT column.

A record is an object: a value per returned name. Nodes, relationships and paths are objects that
say so in `_is`; any other value is a scalar, a list or a map of the asker's own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import EDGE, NODE
from .views import subgraph_edges, subgraph_nodes

KIND = "_is"
_NODE_TYPE = "struct<label: string, key: string, props: map<string, string>>"
_EDGE_TYPE = f"struct<{', '.join(f'{c}: string' for c in EDGE)}>"


def node_value(label: Column, key: Column, props: Column) -> Column:
    return F.to_variant_object(F.struct(F.lit("node").alias(KIND), label.alias("label"), key.alias("key"), props.alias("props")))


def relationship_value(edge: Column) -> Column:
    """From a struct with the columns of an edge."""
    return F.to_variant_object(F.struct(F.lit("relationship").alias(KIND), *[edge[c].alias(c) for c in EDGE]))


def path_value(nodes: Column, edges: Column) -> Column:
    """From an array of node structs and an array of edge structs."""
    return F.to_variant_object(F.struct(F.lit("path").alias(KIND), nodes.alias("nodes"), edges.alias("edges")))


def record(values: Mapping[str, Column]) -> Column:
    """One record of named values, each a VARIANT or something that can be cast to one."""
    return F.to_variant_object(F.struct(*[value.cast("variant").alias(name) for name, value in values.items()]))


def record_values(records: DataFrame, col: str = "record") -> DataFrame:
    """One row per value: the other columns, `name`, `kind` (scalar, node, relationship, path) and `value`.

    A record that is null or no object has no values; a null value is a scalar.
    """
    walked = records.lateralJoin(records.sparkSession.tvf.variant_explode(F.col(col).outer()))
    rest = [c for c in records.columns if c != col]
    told = F.try_variant_get("value", f"$.{KIND}", "string")
    kind = F.when(told.isin("node", "relationship", "path"), told).otherwise("scalar")
    named = walked.filter(F.col("key").isNotNull())
    return named.select(*rest, F.col("key").alias("name"), kind.alias("kind"), "value")


def record_nodes(values: DataFrame) -> DataFrame:
    """All nodes of `record_values`, those of paths included: (label, key, props), repeated as they are."""
    own = F.when(F.col("kind") == "node", F.array(F.try_variant_get("value", "$", _NODE_TYPE)))
    along = F.when(F.col("kind") == "path", F.try_variant_get("value", "$.nodes", f"array<{_NODE_TYPE}>"))
    return values.select(F.explode(F.coalesce(own, along)).alias("_n")).select("_n.*").filter("key IS NOT NULL")


def record_edges(values: DataFrame) -> DataFrame:
    """All relationships, those of paths included; a relationship that is there twice stays so."""
    own = F.when(F.col("kind") == "relationship", F.array(F.try_variant_get("value", "$", _EDGE_TYPE)))
    along = F.when(F.col("kind") == "path", F.try_variant_get("value", "$.edges", f"array<{_EDGE_TYPE}>"))
    return values.select(F.explode(F.coalesce(own, along)).alias("_e")).select("_e.*")


def flat_values(values: DataFrame) -> DataFrame:
    """The values as text: the properties of a node as JSON, anything else as it prints."""
    props = F.to_json(F.coalesce(F.try_variant_get("value", "$.props", "map<string, string>"), F.create_map().cast("map<string, string>")))
    text = F.when(F.col("kind") == "node", props).otherwise(F.col("value").cast("string"))
    return values.select(*[c for c in values.columns if c not in ("kind", "value")], text.alias("text"))


def draw_records(records: DataFrame, col: str = "record") -> tuple[DataFrame, DataFrame]:
    """The drawable nodes and edges of mixed records, whatever kind of value they come in.

    A node is drawn once, with the properties it has in the records; copies that differ
    are told apart by their text, so that the choice is the same in every run. A relationship
    is drawn if both its ends are among the nodes.
    """
    values = record_values(records, col)
    text = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("props"))))
    found = record_nodes(values).groupBy(*NODE).agg(F.max_by("props", F.coalesce(text, F.lit(""))).alias("props"))
    return subgraph_nodes(found), subgraph_edges(record_edges(values).select(*EDGE), found)
