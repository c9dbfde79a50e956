"""Tables that grow, are merged into, or are replaced by a new snapshot."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import dedupe_first
from ..session import stored
from .tables import net_new


def append(df: DataFrame, path: str) -> None:
    """Add all rows, also those a former run has written."""
    df.write.mode("append").parquet(path)


def append_new(
    df: DataFrame, path: str, key: str | Sequence[str], order_by: Sequence[Column | str] | None = None
) -> None:
    """Add only the rows whose key the table does not hold yet, one per key.

    Of several rows with one key the first in `order_by` is added, without an order any one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    df = dedupe_first(df, keys, order_by) if order_by else df.dropDuplicates(keys)
    try:
        seen = df.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return append(df, path)
    append(net_new(df, seen, key), path)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[Column | str],
) -> DataFrame:
    """Existing rows, with the first incoming row per key taking a key's place.

    The existing side is only probed by key: a small increment is broadcast to it
    and it is not shuffled. The increment is read twice, so pass a table rather than
    the end of a long plan.
    """
    keys = [key] if isinstance(key, str) else list(key)
    latest = dedupe_first(incoming, keys, order_by).select(*existing.columns)
    return net_new(existing, latest, keys).unionByName(latest)


# Folders that a table for upserts is dealt to by its key.
BUCKETS = 64
_BUCKET = "bucket__"


def upsert_table(
    incoming: DataFrame,
    path: str,
    key: str | Sequence[str],
    order_by: Sequence[Column | str],
    buckets: int = BUCKETS,
) -> None:
    """Merge rows into the table at `path`, as `upsert`, rewriting only the folders that hold their keys.

    The table is dealt into folders by a hash of the key; it is made where there is none, and keeps its
    number of folders from then on. Only the touched folders are read, merged and replaced; files of
    others stay as they are. What replaces them is complete in the shared folder before any is
    replaced. A run that was cut short can be run again. One writer at a time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark = incoming.sparkSession
    try:
        existing = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        dealt = dedupe_first(incoming, keys, order_by).withColumn(_BUCKET, _bucket(keys, buckets))
        return dealt.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(path)
    # The number of folders is part of their names.
    number = int(existing.select(_BUCKET).first()[0].rpartition("-")[2])
    dealt = incoming.withColumn(_BUCKET, _bucket(keys, number))
    # At most one row per folder.
    touched = dealt.select(_BUCKET).distinct()
    old = existing.join(F.broadcast(touched), _BUCKET, "left_semi").select(*incoming.columns)
    merged = stored(upsert(old, incoming, keys, order_by).withColumn(_BUCKET, _bucket(keys, number)), "merged")
    writer = merged.hint("rebalance", _BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(_BUCKET).parquet(path)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.format_string(f"%d-of-{buckets}", F.pmod(F.xxhash64(*keys), F.lit(buckets)))


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(_BUCKET)


def write_snapshot(df: DataFrame, folder: str) -> str:
    """Write a table under a new name, so that it may be computed from the one before it."""
    path = f"{folder.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str) -> str:
    """Write a new snapshot; the one it was computed from stays as it is.

    Rebalancing keeps few files per label and still splits a label that holds much
    of the graph over several tasks.
    """
    path = f"{folder.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    nodes.hint("rebalance", "label").write.partitionBy("label").parquet(f"{path}/nodes")
    edges.hint("rebalance", "rel_type").write.partitionBy("rel_type").parquet(f"{path}/edges")
    return path


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A snapshot's nodes and edges; the schema is given, for parts may be empty and labels look like numbers."""
    node = "label string, key string, props map<string, string>"
    edge = "src_label string, src_key string, rel_type string, dst_label string, dst_key string"
    nodes = spark.read.schema(node).parquet(f"{path}/nodes").select("label", "key", "props")
    edges = spark.read.schema(edge).parquet(f"{path}/edges")
    return nodes, edges.select("src_label", "src_key", "rel_type", "dst_label", "dst_key")
