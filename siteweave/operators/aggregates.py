"""Group-by work over tables and graphs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import WORD, fixed, has_text
from .graph import whole_props
from .joins import split_join


def avg_over_edges(
    edges: DataFrame,
    sources: DataFrame,
    targets: DataFrame,
    src_key: str,
    dst_key: str,
    group_col: str,
    value_col: str,
    alias: str = "average",
) -> DataFrame:
    """Average of a target value per source group, over (source)->(target) edges.

    Sources with the same group value pool their targets. Values are summed per
    source first, so the join to the groups sees one row per source, not per edge.
    Groups without any value are dropped; an average of 0 is kept.
    """
    state = sums_over_edges(edges, sources, targets, src_key, dst_key, group_col, value_col)
    return averages_of(state, group_col, alias)


def averages_of(state: DataFrame, group_col: str, alias: str = "average") -> DataFrame:
    """(group, average) of the groups with any value, from their sums and counts."""
    return state.filter("values > 0").select(group_col, (F.col("total") / F.col("values")).alias(alias))


def merged_sums(states: Sequence[DataFrame], group_col: str) -> DataFrame:
    """(group, total, values) of several states together, folded before the shuffle."""
    pooled = reduce(DataFrame.unionByName, [s.select(group_col, "total", "values") for s in states])
    return pooled.groupBy(group_col).agg(F.sum("total").alias("total"), F.sum("values").alias("values"))


def negative(state: DataFrame) -> DataFrame:
    """What merging takes away again, as for values that have changed."""
    return state.withColumns({"total": -F.col("total"), "values": -F.col("values")})


def sums_over_edges(
    edges: DataFrame,
    sources: DataFrame,
    targets: DataFrame,
    src_key: str,
    dst_key: str,
    group_col: str,
    value_col: str,
) -> DataFrame:
    """(group, total, values): sum and number of the target values per source group.

    States of different edges add up, so a table of them is kept up by the new edges alone.
    """
    per_source = (
        split_join(
            edges.select(src_key, dst_key), targets.select(dst_key, F.col(value_col).alias("_value")), dst_key
        )
        .groupBy(src_key)
        .agg(F.sum("_value").alias("_sum"), F.count("_value").alias("_count"))
    )
    pooled = (
        per_source.join(sources.select(src_key, group_col), src_key)
        .groupBy(group_col)
        .agg(F.sum("_sum").alias("total"), F.sum("_count").alias("values"))
    )
    return pooled


def count_by(df: DataFrame, keys: Sequence[str], alias: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def assemble_pages(
    pages: DataFrame,
    doc: str,
    page_no: str,
    text: str,
    pages_per_part: int = 1000,
    separator: str = "\n",
) -> DataFrame:
    """Document text from its non-empty pages in order: (doc, text), one row per document.

    Runs of pages are joined first, each by a task of its own, and then the runs of a
    document; the row of a document is the only thing that grows with it.
    """

    def joined(place: str):
        entries = F.array_sort(F.collect_list(F.struct(place, text)))
        return F.array_join(F.transform(entries, lambda e: e[text]), separator).alias(text)

    part = F.floor(F.col(page_no) / pages_per_part).cast("long").alias("_part")
    parts = pages.filter(has_text(F.col(text))).groupBy(doc, part).agg(joined(page_no))
    return parts.groupBy(doc).agg(joined("_part"))


def schema_summary(edges: DataFrame) -> DataFrame:
    """Distinct (from, rel_type, to); incomplete triples are dropped."""
    return (
        edges.select(F.col("src_label").alias("from"), "rel_type", F.col("dst_label").alias("to"))
        .distinct()
        .filter(has_text(F.col("from")) & has_text(F.col("rel_type")) & has_text(F.col("to")))
    )


def property_catalogue(nodes: DataFrame, key_property: Mapping[str, str] = fixed.KEY_PROPERTY) -> DataFrame:
    """Property names per label, the key's among them; the lists are as long as the schema, not the data."""
    whole = nodes.select("label", whole_props(key_property))
    names = whole.select("label", F.explode(F.map_keys("props")).alias("property")).distinct()
    return names.groupBy("label").agg(F.array_sort(F.collect_list("property")).alias("properties"))


def schema_spelling(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: `spelling`, a map from the lower-cased names of the graph's labels, relationships and properties.

    A spelling shared by several kinds goes to the last kind, as if the kinds were replaced in turn.
    """
    triples = schema_summary(edges)
    labels = nodes.select("label").union(triples.select("from")).union(triples.select("to")).toDF("name")
    rels = triples.select(F.col("rel_type").alias("name"))
    props = property_catalogue(nodes).select(F.explode("properties").alias("name"))
    kinds = [kind.distinct().withColumn("kind", F.lit(i)) for i, kind in enumerate((labels, rels, props))]
    named = kinds[0].union(kinds[1]).union(kinds[2]).filter(has_text(F.col("name")))
    told = named.groupBy(F.lower("name").alias("lower")).agg(F.max(F.struct("kind", "name")).alias("last"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col("lower"), F.col("last.name").alias("name"))))
    return told.agg(F.map_from_entries(pairs).alias("spelling"))


def canonical_text(df: DataFrame, text_col: str, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows with the graph's own spelling of its names in the text, whole words, whatever their case.

    The names are looked up in the graph while the query runs: one row, as large as the schema.
    """
    spelt = df.withColumn("_spelling", schema_spelling(nodes, edges).scalar())
    parts = F.regexp_extract_all(F.col(text_col), F.lit(rf"({WORD}|[^\p{{L}}\p{{N}}_]+)"), F.lit(1))
    spell = lambda w: F.coalesce(F.try_element_at(F.col("_spelling"), F.lower(w)), w)
    return spelt.withColumn(text_col, F.array_join(F.transform(parts, spell), "")).drop("_spelling")


def latest(col: Column | str) -> Column:
    """Order spec: newest first, missing last."""
    return (F.col(col) if isinstance(col, str) else col).desc_nulls_last()
