"""What a graph page shows: subgraph, flat rows, tiles, schema graph."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..functions import display_label, has_text, json_object, thumb_url, tooltip
from .aggregates import schema_summary
from .graph import EDGE, NODE, whole_props
from .ranking import colour_index


def hop_nodes(hops: DataFrame, nodes: DataFrame) -> DataFrame:
    """The distinct nodes of `match_pattern` rows, fetched by key.

    Only keys are made distinct and shuffled with the hops; properties come from the
    nodes, once each.
    """
    ends = F.array(
        F.struct(F.col("src_label").alias("label"), F.col("src_key").alias("key")),
        F.struct(F.col("dst_label").alias("label"), F.col("dst_key").alias("key")),
    )
    keys = hops.select(F.explode(ends).alias("_n")).select("_n.*").distinct()
    return nodes.join(keys, NODE, "left_semi")


def distinct_nodes(found: DataFrame) -> DataFrame:
    """One row per node; all copies of a node carry the same properties."""
    return found.dropDuplicates(NODE)


def path_nodes(paths: DataFrame, col: str = "nodes") -> DataFrame:
    """All nodes of array-of-node paths."""
    return paths.select(F.explode(col).alias("_n")).select(*[f"_n.{c}" for c in (*NODE, "props")])


def path_edges(paths: DataFrame, col: str = "edges") -> DataFrame:
    return paths.select(F.explode(col).alias("_e")).select(*[f"_e.{c}" for c in EDGE])


def _node_id(label: Column | str, key: Column | str) -> Column:
    return F.concat(label, F.lit(":"), key)


def subgraph_nodes(found: DataFrame) -> DataFrame:
    """Distinct nodes as drawn: id, label, group, tooltip and colour; the key is shown as a property."""
    found = found.select("label", "key", whole_props())
    # Colours are one row per label, so this side is as small as the schema.
    coloured = found.join(F.broadcast(colour_index(found, "label")), "label")
    return coloured.select(
        _node_id("label", "key").alias("id"),
        display_label(F.col("props"), F.col("label")).alias("label"),
        F.coalesce(F.nullif("label", F.lit("")), F.lit("Node")).alias("group"),
        tooltip(F.col("props")).alias("title"),
        "colour",
    )


def subgraph_edges(found_edges: DataFrame, found_nodes: DataFrame) -> DataFrame:
    """Edges whose two ends are among the distinct nodes; repeated relationships stay repeated."""
    ids = found_nodes.select(_node_id("label", "key").alias("id"))
    drawn = found_edges.select(
        _node_id("src_label", "src_key").alias("source"),
        _node_id("dst_label", "dst_key").alias("target"),
        F.col("rel_type").alias("label"),
    )
    return drawn.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(
        ids.withColumnRenamed("id", "target"), "target", "left_semi"
    )


def flatten_records(records: DataFrame) -> DataFrame:
    """Every column as text: nodes and relationships as JSON, the rest as strings."""

    def flat(field) -> Column:
        if isinstance(field.dataType, (MapType, StructType, ArrayType)):
            return F.to_json(field.name).alias(field.name)
        return F.col(field.name).cast("string").alias(field.name)

    return records.select(*[flat(f) for f in records.schema.fields])


def tiles(records: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct (name, thumb) of all JSON objects that have a name and box art.

    Text that is no JSON object is passed over.
    """
    blobs = F.explode(F.array(*[json_object(F.col(c)) for c in (cols or records.columns)]))
    name = F.try_element_at("_b", F.lit("name"))
    art = F.try_element_at("_b", F.lit("box_art_url"))
    return (
        records.select(blobs.alias("_b"))
        .filter(name.isNotNull() & art.isNotNull())
        .select(name.alias("name"), thumb_url(art).alias("thumb"))
        .distinct()
    )


def schema_graph(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Label nodes with colours, and one edge per (from, rel_type, to)."""
    triples = schema_summary(edges)
    labels = reduce(
        DataFrame.unionByName, [triples.select(F.col(end).alias("label")) for end in ("from", "to")]
    )
    return colour_index(labels.filter(has_text(F.col("label"))), "label"), triples
