"""Scans, landed documents and the lookups that stand in for remote calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import has_text
from ..operators.joins import split_join
from ..operators.ranking import dedupe_first
from ..operators.search import search_texts


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed files of one JSON document per line: (payload, landed_at).

    The lines stay text, so that a broken one can be rejected by itself. `landed_at`
    is the time of the file, the order in which documents replace each other.
    """
    return spark.read.text(path).select(
        F.col("value").alias("payload"), F.col("_metadata.file_modification_time").alias("landed_at")
    )


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out to all cores where a scan has fewer tasks than there are cores.

    For work that costs much per row. The scan of a large table stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_payload(df: DataFrame, json_col: str, schema, keep: bool = False) -> DataFrame:
    """Parse a JSON column, reading only the fields the schema names.

    Written as a generator of one row per row: later filters on the fields then stay
    above it, where a plain projection would be parsed again inside every such filter.
    """
    rest = [c for c in df.columns if keep or c != json_col]
    return df.select(*rest, F.inline(F.array(F.from_json(json_col, schema))))


def explode_list(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """One row per list element; a missing list counts as empty."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(col).alias(alias or col))


def lookup_by_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Documents of the known ids; ids without a document simply yield nothing."""
    return split_join(docs, ids.select(key).distinct(), key, "left_semi")


def net_new(source: DataFrame, seen: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Source rows whose key has not been ingested yet.

    The history is only probed: a small source is broadcast to it and it is not shuffled.
    The source is read twice, so pass a table rather than the end of a long plan.
    """
    keys = [key] if isinstance(key, str) else list(key)
    held = split_join(seen.select(*keys), source.select(*keys), keys, "left_semi").distinct()
    return split_join(source, held, keys, "left_anti")


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with why; `reason` is null for a good row."""
    judged = df.withColumn("reason", reason)
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")


def search_first(
    probes: DataFrame,
    docs: DataFrame,
    probe_col: str,
    text_col: str,
    order_by: Sequence[Column | str],
    mode: str = "equals",
) -> DataFrame:
    """For each distinct probe the first matching document; probes without a hit are dropped.

    `equals` compares whole strings, `contains` finds the probe anywhere in the text,
    `phrase` finds its words in a row, ignoring case. All are equi-joins, so no probe
    is held against every document: the last two go through an index of the grams that
    the probes have (`operators.search`) and leave the text itself out of the result.
    """
    if mode not in ("equals", "contains", "phrase"):
        raise KeyError(mode)
    if mode == "equals":
        wanted = probes.filter(has_text(F.col(probe_col))).select(probe_col).distinct()
        asked = wanted.withColumnRenamed(probe_col, text_col)
        first = dedupe_first(split_join(docs, asked, text_col, "left_semi"), [text_col], order_by)
        return wanted.join(first, F.col(probe_col) == F.col(text_col))
    found = dedupe_first(search_texts(probes, docs, probe_col, text_col, mode), ["_probe"], order_by)
    return found.select(F.col("_probe").alias(probe_col), *[c for c in docs.columns if c != text_col])
