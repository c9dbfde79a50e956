"""The net-new watch over files that keep arriving."""

from pyspark.sql import functions as F

from siteweave.session import new_table_path
from siteweave.streaming import ingest_net_new

SCHEMA = "id int, v string, seq int"


def test_net_new_watch(spark, rows):
    source, target, state = (new_table_path(spark, n) for n in ("in", "out", "state"))

    def arrive(*values):
        spark.createDataFrame(values, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run():
        schema = spark.createDataFrame([], SCHEMA).schema
        ingest_net_new(spark, source, schema, target, "id", [F.col("seq").desc()], state).awaitTermination(120)
        return rows(spark.read.parquet(target), "id", "v")

    arrive((1, "a", 1), (2, "old", 1), (2, "b", 2))
    assert run() == [(1, "a"), (2, "b")]
    assert run() == [(1, "a"), (2, "b")]
    arrive((2, "late", 9), (3, "c", 1))
    assert run() == [(1, "a"), (2, "b"), (3, "c")]


def test_replayed_batch_appends_nothing(spark, rows):
    """Losing the stream's state means all files are read again; the keys are known by then."""
    source, target = new_table_path(spark, "in"), new_table_path(spark, "out")
    spark.createDataFrame([(1, "a", 1)], SCHEMA).write.parquet(source)
    schema = spark.createDataFrame([], SCHEMA).schema
    for _ in range(2):
        state = new_table_path(spark, "state")
        ingest_net_new(spark, source, schema, target, "id", ["seq"], state).awaitTermination(120)
    assert rows(spark.read.parquet(target), "id") == [(1,)]
