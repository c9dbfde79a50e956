"""The nightly watch for net-new records as an incremental stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.sinks import append_new


def ingest_net_new(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    key: str | Sequence[str],
    order_by: Sequence[Column | str],
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Take in the files that arrived since the last run, then stop.

    Of several new rows with one key the first in `order_by` is kept.

    A batch that is run again after a failure appends nothing twice: the keys it
    has written are already in the target. `checkpoint` must lie on shared storage.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def write(batch: DataFrame, _: int) -> None:
        append_new(transform(batch), target, keys, order_by)

    return (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
