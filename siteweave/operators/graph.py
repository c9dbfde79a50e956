"""A property graph as two DataFrames, and the statements that change it.

nodes(label, key, props map<string,string>)   one row per (label, key)
edges(src_label, src_key, rel_type, dst_label, dst_key)   no duplicates

A null property is a missing one, so `props` never holds nulls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_key, fixed
from .joins import split_join
from .ranking import dedupe_first

NODE = ["label", "key"]
EDGE = ["src_label", "src_key", "rel_type", "dst_label", "dst_key"]


# --- building rows -----------------------------------------------------------


def as_nodes(df: DataFrame, label: str, key: Column | str, props: Sequence[str] = ()) -> DataFrame:
    """Typed rows as graph nodes; rows without a key make no node."""
    key = as_key(F.col(key) if isinstance(key, str) else key)
    return df.select(F.lit(label).alias("label"), key.alias("key"), props_map(props)).filter("key IS NOT NULL")


def no_props() -> Column:
    return F.create_map().cast("map<string,string>")


def props_map(names: Sequence[str]) -> Column:
    if not names:
        return no_props().alias("props")
    pairs = [part for name in names for part in (F.lit(name), F.col(name).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("props")


def as_edges(
    df: DataFrame, src_label: str, src_key: Column | str, rel: str, dst_label: str, dst_key: Column | str
) -> DataFrame:
    """Distinct candidate edges between two key columns."""
    src = as_key(F.col(src_key) if isinstance(src_key, str) else src_key)
    dst = as_key(F.col(dst_key) if isinstance(dst_key, str) else dst_key)
    pairs = df.select(src.alias("src_key"), dst.alias("dst_key"))
    return (
        pairs.filter("src_key IS NOT NULL AND dst_key IS NOT NULL")
        .distinct()
        .select(
            F.lit(src_label).alias("src_label"),
            "src_key",
            F.lit(rel).alias("rel_type"),
            F.lit(dst_label).alias("dst_label"),
            "dst_key",
        )
    )


# --- nodes -------------------------------------------------------------------


def merge_nodes(
    nodes: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    set_cols: Sequence[str],
    order_by: Sequence[Column | str],
) -> DataFrame:
    """Insert missing keys; for known keys overwrite `set_cols`, null included.

    Rows without a key make no node. Of several incoming rows per key the first in `order_by` counts; order by the
    latest first for last-write-wins.
    """
    keys = list(key)
    fresh = dedupe_first(incoming.dropna(subset=keys), keys, order_by).select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in set_cols], F.lit(True).alias("_hit")
    )
    merged = nodes.join(fresh, keys, "full_outer")
    return merged.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
            for c in nodes.columns
        ]
    )


def assign_props(df: DataFrame, label: str, key: Column | str, props: Sequence[str] = ()) -> DataFrame:
    """Incoming nodes that set the named properties; a null among them removes the property."""
    return as_nodes(df, label, key, props).withColumn("sets", F.array(*[F.lit(p) for p in props]).cast("array<string>"))


def merge_props(nodes: DataFrame, incoming: DataFrame, labels: Sequence[str]) -> DataFrame:
    """`merge_nodes` on the long form, for rows of `assign_props`, one per node.

    `labels` are those of the incoming rows, which go in together: one join serves
    the whole pass, and nodes of other labels are passed on without a shuffle.
    """
    touched = F.col("label").isin(*labels)
    fresh = incoming.select(*NODE, F.col("props").alias("_new"), "sets")
    kept = F.map_filter(F.coalesce("props", no_props()), lambda k, _: ~F.array_contains("sets", k))
    props = F.when(F.col("_new").isNull(), F.col("props")).otherwise(F.map_concat(kept, "_new"))
    merged = nodes.filter(touched).join(fresh, NODE, "full_outer").select(*NODE, props.alias("props"))
    return merged.unionByName(nodes.filter(~touched))


def match_set(
    nodes: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    set_cols: Sequence[str],
    order_by: Sequence[Column | str],
) -> DataFrame:
    """Set columns of known keys, null included; unknown keys are ignored."""
    keys = list(key)
    fresh = dedupe_first(updates, keys, order_by).select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in set_cols], F.lit(True).alias("_hit")
    )
    known = [c for c in nodes.columns if c not in set_cols]
    current = {c: (F.col(c) if c in nodes.columns else F.lit(None)) for c in set_cols}
    return nodes.join(fresh, keys, "left").select(
        *known,
        *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(current[c]).alias(c) for c in set_cols],
    )


def create_nodes(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Append, always."""
    return nodes.unionByName(rows)


# --- edges -------------------------------------------------------------------


def with_endpoints(candidates: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate edges whose two ends exist."""
    src = nodes.select(F.col("label").alias("src_label"), F.col("key").alias("src_key"))
    dst = nodes.select(F.col("label").alias("dst_label"), F.col("key").alias("dst_key"))
    started = split_join(candidates, src, ["src_label", "src_key"], "left_semi")
    return split_join(started, dst, ["dst_label", "dst_key"], "left_semi").select(*EDGE)


def of_type(edges: DataFrame, rels: Sequence[str]) -> DataFrame:
    return edges.filter(F.col("rel_type").isin(*rels)).select(*EDGE)


def new_edges(edges: DataFrame, added: DataFrame, rels: Sequence[str]) -> DataFrame:
    """Distinct rows of `added` that the graph does not hold yet; `rels` are their types.

    These can be appended to the stored edges. Of the graph only the edges of these
    types are probed: few added edges are broadcast to them, and nothing is shuffled.
    """
    fresh = added.select(*EDGE).distinct()
    held = of_type(edges, rels).join(fresh, EDGE, "left_semi")
    return fresh.join(held, EDGE, "left_anti")


def add_edges(edges: DataFrame, added: DataFrame, rels: Sequence[str]) -> DataFrame:
    """The graph's edges and the new ones among `added`; an edge is never there twice."""
    return edges.select(*EDGE).unionByName(new_edges(edges, added, rels))


def merge_edges(edges: DataFrame, candidates: DataFrame, nodes: DataFrame, rels: Sequence[str]) -> DataFrame:
    """Add those candidates whose two ends exist."""
    return add_edges(edges, with_endpoints(candidates.select(*EDGE).distinct(), nodes), rels)


def replace_edges(edges: DataFrame, new: DataFrame, rel: str) -> DataFrame:
    """Detach the sources' old edges of the type, then attach the new ones."""
    replaced = new.select("src_label", "src_key").distinct()
    kept = split_join(of_type(edges, [rel]), replaced, ["src_label", "src_key"], "left_anti")
    others = edges.filter(F.col("rel_type") != rel)
    return others.select(*EDGE).unionByName(kept.select(*EDGE)).unionByName(new.select(*EDGE).distinct())


def detached(before: DataFrame, new: DataFrame, rel: str) -> DataFrame:
    """Targets that the sources of `new` pointed to before, as (label, key)."""
    replaced = new.select("src_label", "src_key").distinct()
    old = split_join(of_type(before, [rel]), replaced, ["src_label", "src_key"], "left_semi")
    return old.select(F.col("dst_label").alias("label"), F.col("dst_key").alias("key")).distinct()


def drop_orphans(nodes: DataFrame, edges: DataFrame, candidates: DataFrame, rel: str, label: str) -> DataFrame:
    """Delete those candidate nodes of the label that no edge of the type points to any more."""
    pointed = of_type(edges, [rel]).select(F.col("dst_label").alias("label"), F.col("dst_key").alias("key"))
    orphans = candidates.join(pointed.distinct(), NODE, "left_anti")
    left = nodes.filter(F.col("label") == label).join(orphans, NODE, "left_anti")
    return left.unionByName(nodes.filter(F.col("label") != label))


# --- reading -----------------------------------------------------------------


def whole_props(key_property: Mapping[str, str] = fixed.KEY_PROPERTY) -> Column:
    """The properties of a node with its key among them, under the name that it has for the label.

    The key is stored once, in its own column, so no statement can remove or change it.
    """
    props = F.coalesce("props", no_props())
    if not key_property:
        return props.alias("props")
    named = F.try_element_at(F.create_map(*[F.lit(x) for item in key_property.items() for x in item]), F.col("label"))
    others = F.map_filter(props, lambda k, _: k != named)
    whole = F.map_concat(others, F.create_map(named, F.col("key")))
    return F.when(named.isNull() | F.col("key").isNull(), props).otherwise(whole).alias("props")


def match_nodes(
    nodes: DataFrame,
    label: str,
    prop: str,
    value: str,
    mode: str = "exact",
    key_property: Mapping[str, str] = fixed.KEY_PROPERTY,
) -> DataFrame:
    """Nodes whose property equals the value, or holds it as a substring; the key is a property too."""
    found = F.col("key") if key_property.get(label) == prop else F.try_element_at("props", F.lit(prop))
    test = {"exact": found == value, "contains": found.contains(value)}[mode]
    return nodes.filter((F.col("label") == label) & test)


def match_pattern(
    sources: DataFrame, edges: DataFrame, rel: str, targets: DataFrame, src_label: str, dst_label: str
) -> DataFrame:
    """(source)-[rel]->(target), one row per edge, with both nodes' properties."""
    hops = edges.filter(
        (F.col("rel_type") == rel) & (F.col("src_label") == src_label) & (F.col("dst_label") == dst_label)
    )
    src = sources.filter(F.col("label") == src_label).select(
        F.col("key").alias("src_key"), F.col("props").alias("src_props")
    )
    dst = targets.filter(F.col("label") == dst_label).select(
        F.col("key").alias("dst_key"), F.col("props").alias("dst_props")
    )
    started = split_join(hops, src, "src_key")
    return split_join(started, dst, "dst_key").select(*EDGE, "src_props", "dst_props")
