"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. Hot keys in joins are split by the
# adaptive skew rule, also where that costs one more exchange behind the join.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Tasks read this much at most, of shuffled rows and of files. Labels and types repeat in every edge and all but vanish when
# a shuffle is compressed, so that 1 MB of it is some 65,000 edges, which took 20 to 40 MB in the sorts and hash tables of
# a task: Spark's own 64 MB would be about 2 GB. Rows are folded where they are scanned, and two key columns are a small part
# of a wide table's bytes, so that 128 MB of a file took 672 MB in a task. A row group is not divided. A session that asks
# for smaller tasks keeps them.
TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SCAN_SIZE = "spark.sql.files.maxPartitionBytes"
TASK_BYTES = 16 << 20


def get_session(app: str = "siteweave", cpus: int | str = "*", partitions: int | None = None) -> SparkSession:
    """A session for local runs; on a cluster, pass the cluster's own to `tune`."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    for key in (TASK_SIZE, SCAN_SIZE):
        if _bytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, f"{TASK_BYTES}b")
    return spark


def _bytes(size: str) -> int:
    """A size as Spark's settings write it: 64m, 64MB, 67108864b, 67108864."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local-mode session may go without one; it gets a fresh folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        return folder
    if not context.getCheckpointDir():
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="siteweave-"))
    return os.path.dirname(context.getCheckpointDir().rstrip("/"))


def keep(df: DataFrame) -> DataFrame:
    """The rows as computed now, in the shared folder: read, not recomputed, from here on."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/siteweave-tables/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, of which each reader reads its own columns."""
    path = new_table_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
