"""One key holds a third of all rows: joins are split, folding comes before shuffles."""

import contextlib

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.functions import fixed
from siteweave.operators.aggregates import avg_over_edges
from siteweave.operators.graph import EDGE, as_edges, match_pattern, no_props, with_endpoints
from siteweave.operators.joins import split_join
from siteweave.operators.views import path_edges
from siteweave.plans.company import COMPANY, company_pages, stage_companies
from siteweave.session import SCAN_SIZE, TASK_BYTES, TASK_SIZE, tune
from siteweave.sources import net_new

N = 60_000


@pytest.fixture
def many_small_partitions(spark):
    """Joins shuffle, and partitions of a few kilobytes already count as large."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.shuffle.partitions": "16",
    }
    with contextlib.ExitStack() as stack:
        for key, value in changed.items():
            stack.callback(spark.conf.set, key, spark.conf.get(key))
            spark.conf.set(key, value)
        yield


@pytest.fixture
def hot(spark):
    """Rows of many map tasks, a third of them with key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(0, N, 1, 8).select("id", key.alias("k"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def keyed_nodes(df, label):
    return df.select(F.lit(label).alias("label"), F.col("k").cast("string").alias("key"), no_props().alias("props"))


def test_endpoint_check_is_split(hot, many_small_partitions):
    nodes = keyed_nodes(hot.select("k").distinct(), "B").unionByName(
        keyed_nodes(hot.select(F.col("id").alias("k")), "A")
    )
    edges = as_edges(hot, "A", "id", "R", "B", "k")
    checked = with_endpoints(edges, nodes)
    assert "skew=true" in final_plan(checked)
    assert checked.count() == N and checked.filter("dst_key = '0'").count() == N // 3


def test_pattern_is_split(hot, many_small_partitions):
    edges = as_edges(hot, "A", "id", "R", "B", "k")
    nodes = keyed_nodes(hot.select("k").distinct(), "B").unionByName(
        keyed_nodes(hot.select(F.col("id").alias("k")), "A")
    )
    hops = match_pattern(nodes, edges, "R", nodes, "A", "B")
    assert "skew=true" in final_plan(hops)
    assert hops.count() == N


def test_net_new_folds_the_seen_side(hot, many_small_partitions):
    fresh = net_new(hot, hot.filter("id % 3 != 1"), "k")
    plan = final_plan(fresh)
    assert "skew=true" in plan and "HashAggregate" in plan
    assert fresh.count() == N // 3


def test_key_types_must_agree(spark):
    with pytest.raises(TypeError):
        split_join(spark.range(3), spark.range(3).select(F.col("id").cast("int")), "id")


def test_average_folds_before_grouping(spark, hot, many_small_partitions):
    """Every source's values are summed before the hot group is formed."""
    edges = hot.select(F.col("id").alias("src"), F.col("id").alias("dst"))
    sources = hot.select(F.col("id").alias("src"), F.col("k").alias("grp"))
    targets = hot.select(F.col("id").alias("dst"), (F.col("id") % 7).cast("double").alias("v"))
    out = {r.grp: r.average for r in avg_over_edges(edges, sources, targets, "src", "dst", "grp", "v").collect()}
    third = range(0, N, 3)
    assert out[0] == sum(i % 7 for i in third) / len(third) and len(out) == N - N // 3 + 1


def test_hot_site_is_split(spark, hot, many_small_partitions):
    """One site with a third of the scrapes: the staging join is split, pages are folded."""
    scraped = hot.select(
        F.concat(F.lit("s"), F.col("k").cast("string")).alias("website"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("createdate"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("scrappeddata"),
        "id",
    )
    firms = scraped.select("website").distinct().select("website", *[F.lit("x").alias(c) for c in COMPANY[1:]])
    # Grouping by the key just before would have kept a plain join from being split.
    staging = [f(firms, scraped.select("website", "id"), "website") for f in (DataFrame.join, split_join)]
    assert ["skew=true" in final_plan(df) for df in staging] == [False, True]
    staged = stage_companies(firms, scraped, ["createdate", "id"])
    paged = company_pages(staged, scraped, ["createdate", "id"])
    assert "skew=true" in final_plan(paged)
    top = paged.agg(F.count(F.lit(1)), F.max("UID"), F.countDistinct("UID"), F.max("page_copies")).first()
    assert tuple(top) == (N, N, N, N // 3)
    assert paged.filter("website = 's0'").select("SCRAPPEDDATA").distinct().count() == 1
    assert fixed.EXCLUDED_INDUSTRY not in firms.first().industry


@pytest.mark.parametrize(
    "asked, left",
    [("64MB", f"{TASK_BYTES}b"), ("67108864b", f"{TASK_BYTES}b"), ("1g", f"{TASK_BYTES}b"), ("8m", "8m"), ("4k", "4k"), ("4096", "4096"), ("16m", "16m")],
)
def test_task_size_is_bounded(spark, asked, left):
    other = spark.newSession()
    other.conf.set(TASK_SIZE, asked)
    assert tune(other).conf.get(TASK_SIZE) == left


def test_more_rows_make_more_tasks(spark):
    """About 50 MB behind a shuffle are not one task's."""
    other = spark.newSession()
    other.conf.set(TASK_SIZE, "64m")
    other.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    other.conf.set("spark.sql.shuffle.partitions", "16")
    wide = tune(other).range(0, 700_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).distinct()
    assert wide.rdd.getNumPartitions() >= 3


def test_more_path_edges_make_more_tasks(spark):
    other = spark.newSession()
    other.conf.set(TASK_SIZE, "64m")
    other.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    other.conf.set("spark.sql.shuffle.partitions", "16")
    key = F.sha2(F.col("id").cast("string"), 256)
    edges = as_edges(tune(other).range(0, 500_000, 1, 8), "A", key, "R", "B", F.col("id") % 100)
    paths = edges.select(F.array(F.struct(*EDGE), F.struct(*EDGE)).alias("edges"))
    counted = path_edges(paths).groupBy(*EDGE).agg(F.count(F.lit(1)).alias("on_paths"))
    assert counted.rdd.getNumPartitions() >= 3
    assert counted.agg(F.count(F.lit(1)), F.min("on_paths"), F.max("on_paths")).first() == (500_000, 2, 2)


@pytest.mark.parametrize("asked, left", [("128MB", f"{TASK_BYTES}b"), ("134217728", f"{TASK_BYTES}b"), ("8m", "8m"), ("16m", "16m")])
def test_scan_size_is_bounded(spark, asked, left):
    other = spark.newSession()
    other.conf.set(SCAN_SIZE, asked)
    assert tune(other).conf.get(SCAN_SIZE) == left


def test_longer_files_are_folded_by_more_tasks(spark, tmp_path):
    """One file of some 45 MB in row groups of 1 MB, read where a few cores would make one task of it."""
    other = spark.newSession()
    other.conf.set("spark.sql.files.minPartitionNum", "1")
    lines = other.range(0, 350_000, 1, 1).select(
        F.col("id").alias("part"), (F.col("id") % 100).alias("supp"), F.sha2(F.col("id").cast("string"), 512).alias("rest")
    )
    lines.write.option("parquet.block.size", 1 << 20).option("compression", "none").parquet(str(tmp_path / "lines"))
    read = tune(other).read.parquet(str(tmp_path / "lines"))
    assert read.rdd.getNumPartitions() >= 3
    edges = as_edges(read, "A", "part", "R", "B", "supp")
    assert edges.agg(F.count(F.lit(1)), F.countDistinct("dst_key")).first() == (350_000, 100)
