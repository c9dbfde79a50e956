"""Graph rows from tagged tokens (doc, word, entity)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, tag_label
from .graph import as_edges, with_endpoints
from .joins import split_join


# Names of a document that meet those of the other kind together.
BLOCK_NAMES = 1000


def entity_nodes(tokens: DataFrame) -> DataFrame:
    """Distinct (label, name); the pieces of a longer name stay separate."""
    return (
        tokens.filter(F.col("word").isNotNull())
        .select(tag_label(F.col("entity")).alias("label"), F.col("word").alias("name"))
        .distinct()
    )


def cooccurrence(
    tokens: DataFrame, class_a: str = "ORG", class_b: str = "PRODUCT", rel: str = fixed.SELLS
) -> DataFrame:
    """Company-SELLS->Product for names tagged in the same document.

    Names are made distinct per document first, so a document that repeats them
    costs no more; every pair that is left is an edge of the result, if both ends are nodes. The
    names of a crowded document are dealt to blocks of `BLOCK_NAMES`, and every block meets every block
    by itself, so that such a document is many tasks; other documents are one block.
    """

    def named(tag: str, alias: str) -> DataFrame:
        return tokens.filter(F.col("entity").contains(tag) & F.col("word").isNotNull()).select(
            "doc", F.col("word").alias(alias)
        ).distinct()

    sides = {"src": named(class_a, "src"), "dst": named(class_b, "dst")}
    blocks = [
        side.groupBy("doc").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NAMES).cast("int").alias(f"{name}_blocks"))
        for name, side in sides.items()
    ]
    both = blocks[0].join(blocks[1], "doc")
    dealt = {}
    for name, other in (("src", "dst"), ("dst", "src")):
        own = F.pmod(F.xxhash64(name), F.col(f"{name}_blocks")).cast("int").alias(f"{name}_block")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        dealt[name] = split_join(sides[name], both, "doc").select("doc", name, own, every)
    pairs = split_join(dealt["src"], dealt["dst"], ["doc", "src_block", "dst_block"])
    edges = as_edges(pairs, fixed.COMPANY, "src", rel, fixed.PRODUCT, "dst")
    return with_endpoints(edges, entity_nodes(tokens).withColumnRenamed("name", "key"))
