"""Paths against plain recursion, and records of mixed values."""

import random

import pytest
from pyspark.sql import functions as F

from siteweave.operators import records as R
from siteweave.operators.paths import match_paths, with_properties

EDGES = "src_label string, src_key string, rel_type string, dst_label string, dst_key string"


def walk(starts, edges, least, most, both):
    out = []

    def go(nodes, used):
        if len(used) >= least:
            out.append((tuple(nodes), tuple(used)))
        if len(used) == most:
            return
        for e in edges:
            if e not in used:
                src, dst = e[:2], e[3:]
                if nodes[-1] == src:
                    go([*nodes, dst], [*used, e])
                if both and nodes[-1] == dst and src != dst:
                    go([*nodes, src], [*used, e])

    for s in starts:
        go([s], [])
    return sorted(out)


@pytest.mark.parametrize("least, most, both", [(0, 0, False), (0, 3, False), (2, 4, False), (1, 3, True)])
def test_paths(spark, least, most, both):
    draw = random.Random(least * 10 + most)
    edges = sorted({("A", str(draw.randrange(5)), draw.choice("rq"), "A", str(draw.randrange(5))) for _ in range(9)})
    starts = [("A", "0"), ("A", "3"), ("B", "0")]
    df = spark.createDataFrame([*edges, edges[0], ("A", "0", "other", "A", "1")], EDGES)
    sources = spark.createDataFrame([(*s, "x") for s in starts], "label string, key string, more string")
    got = match_paths(sources, df, ["r", "q"], least, most, both)
    told = sorted((tuple(map(tuple, r.nodes)), tuple(map(tuple, r.edges))) for r in got.collect())
    assert told == walk(starts, edges, least, most, both)


def test_a_hub_is_split(spark):
    """All paths meet in one node; the join there shuffles by itself, so that it can be split."""
    edges = [("A", str(i), "r", "H", "hub") for i in range(60)] + [("H", "hub", "r", "B", str(i)) for i in range(50)]
    df = spark.createDataFrame(edges, EDGES)
    sources = spark.createDataFrame([("A", str(i)) for i in range(60)], "label string, key string")
    paths = match_paths(sources, df, ["r"], 2, 2)
    assert paths.count() == 3000
    assert paths.filter("nodes[1].key = 'hub' AND size(nodes) = 3 AND size(edges) = 2").count() == 3000
    with pytest.raises(ValueError):
        match_paths(sources, df, ["r"], 3, 2)


def mixed(spark):
    rows = [
        (1, "node", "A", "1", {"name": "one"}),
        (2, "node", "A", "1", {"name": "one"}),
        (3, "rel", "A", "1", None),
        (4, "path", "A", "1", {"name": "one"}),
        (5, "scalar", "A", "7", None),
        (6, "null", None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, kind string, label string, key string, props map<string,string>")
    edge = F.struct(
        F.col("label").alias("src_label"), F.col("key").alias("src_key"), F.lit("r").alias("rel_type"),
        F.lit("B").alias("dst_label"), F.lit("2").alias("dst_key"),
    )
    nothing = F.create_map().cast("map<string,string>")
    nodes = F.array(F.struct("label", "key", F.coalesce("props", nothing).alias("props")), F.struct(F.lit("B").alias("label"), F.lit("2").alias("key"), F.create_map(F.lit("title"), F.lit("two")).alias("props")))
    value = (
        F.when(F.col("kind") == "node", R.node_value(F.col("label"), F.col("key"), F.col("props")))
        .when(F.col("kind") == "rel", R.relationship_value(edge))
        .when(F.col("kind") == "path", R.path_value(nodes, F.array(edge, edge)))
        .when(F.col("kind") == "scalar", F.col("key").cast("variant"))
    )
    return df.select("id", F.when(F.col("kind") != "null", R.record({"v": value, "n": F.col("id"), "gone": F.lit(None).cast("string")})).alias("record"))


def test_records_are_walked_by_kind(spark, rows):
    values = R.record_values(mixed(spark))
    kinds = rows(values.filter("name = 'v'"), "id", "kind")
    assert kinds == [(1, "node"), (2, "node"), (3, "relationship"), (4, "path"), (5, "scalar")]
    assert rows(values.filter("name = 'n'"), "kind") == [("scalar",)] * 5
    assert values.filter("id = 6").count() == 0
    assert rows(R.record_nodes(values), "label", "key") == [("A", "1")] * 3 + [("B", "2")]
    assert rows(R.record_edges(values), "src_key", "dst_key") == [("1", "2")] * 3
    texts = rows(R.flat_values(values).filter("name = 'v' AND id IN (1, 5)"), "id", "text")
    assert texts == [(1, '{"name":"one"}'), (5, "7")]


def test_records_are_drawn(spark, rows):
    nodes, edges = R.draw_records(mixed(spark))
    assert rows(nodes, "id", "label", "group") == [("A:1", "one", "A"), ("B:2", "two", "B")]
    assert rows(edges, "source", "target", "label") == [("A:1", "B:2", "r")] * 3
    nodes, edges = R.draw_records(mixed(spark).filter("id = 3"))
    assert nodes.count() == 0 and edges.count() == 0


def test_paths_with_properties(spark):
    edges = spark.createDataFrame([("A", "1", "r", "B", "2"), ("B", "2", "r", "A", "1")], EDGES)
    nodes = spark.createDataFrame([("A", "1", {"name": "x"}), ("C", "9", {})], "label string, key string, props map<string,string>")
    paths = with_properties(match_paths(nodes, edges, ["r"], 0, 2), nodes)
    told = sorted([(n.label, n.key, n.props) for n in r.nodes] for r in paths.collect())
    a, b, c = ("A", "1", {"name": "x"}), ("B", "2", {}), ("C", "9", {})
    assert told == [[a], [a, b], [a, b, a], [c]]
