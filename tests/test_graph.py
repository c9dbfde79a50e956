"""Graph statements and passes on hand-made rows."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from siteweave.operators import links as L
from siteweave.operators import entities
from siteweave.operators.aggregates import averages_of, canonical_text
from siteweave.operators.graph import (
    as_edges,
    as_nodes,
    assign_props,
    create_nodes,
    match_nodes,
    match_pattern,
    match_set,
    merge_edges,
    merge_nodes,
    merge_props,
)
from siteweave.operators.aggregates import property_catalogue, schema_summary
from siteweave.operators.views import (
    distinct_nodes,
    flatten_records,
    hop_nodes,
    path_edges,
    path_nodes,
    schema_graph,
    subgraph_edges,
    subgraph_nodes,
    tiles,
)
from siteweave.plans import games
from siteweave.plans.questions import answer_graph, ask, catalogue_text, schema_text

NODES = "label string, key string, props map<string,string>"
EDGES = "src_label string, src_key string, rel_type string, dst_label string, dst_key string"


def nodes_of(spark, *rows):
    return spark.createDataFrame([(l, k, p) for l, k, p in rows], NODES)


def edges_of(spark, *rows):
    return spark.createDataFrame(list(rows), EDGES)


def as_dict(nodes):
    return {(r.label, r.key): r.props for r in nodes.collect()}


def hops(edges, rel):
    return sorted((r.src_label, r.src_key, r.dst_key) for r in edges.filter(F.col("rel_type") == rel).collect())


def test_merge_nodes(spark, rows):
    base = spark.createDataFrame([("1", "a", 1.0), ("2", "b", 2.0)], "key string, name string, rating double")
    incoming = spark.createDataFrame(
        [("2", "x", None, 1), ("2", "old", 9.0, 0), ("3", "c", 3.0, 0)], "key string, name string, rating double, seq int"
    )
    merge = lambda nodes: merge_nodes(nodes, incoming, ["key"], ["rating"], [F.col("seq").desc()])
    once = merge(base)
    assert rows(once) == [("1", "a", 1.0), ("2", "b", None), ("3", None, 3.0)]
    assert rows(merge(once)) == rows(once)


def test_match_set(spark, rows):
    base = spark.createDataFrame([("1", "a"), ("2", "b")], "key string, name string")
    updates = spark.createDataFrame([("2", None, "s"), ("9", "z", "t")], "key string, name string, summary string")
    out = match_set(base, updates, ["key"], ["name", "summary"], ["key"])
    assert rows(out, "key", "name", "summary") == [("1", "a", None), ("2", None, "s")]


def test_merge_props(spark):
    base = nodes_of(spark, ("A", "1", {"x": "1", "y": "2"}), ("A", "2", {"x": "5"}), ("B", "1", {"x": "0"}))
    rows_in = spark.createDataFrame([("1", None, "n"), ("3", "7", None)], "k string, x string, z string")
    merged = merge_props(base, assign_props(rows_in, "A", "k", ["x", "z"]), ["A"])
    want = {("A", "1"): {"y": "2", "z": "n"}, ("A", "2"): {"x": "5"}, ("A", "3"): {"x": "7"}, ("B", "1"): {"x": "0"}}
    assert as_dict(merged) == want
    assert as_dict(merge_props(merged, assign_props(rows_in, "A", "k", ["x", "z"]), ["A"])) == want


def test_create_always_appends(spark):
    base = nodes_of(spark, ("S", "1", {}))
    assert create_nodes(create_nodes(base, base), base).count() == 3


def test_merge_edges_checks_both_ends(spark, rows):
    nodes = nodes_of(spark, ("A", "1", {}), ("A", "2", {}), ("B", "1", {}))
    have = edges_of(spark, ("A", "1", "R", "B", "1"))
    wanted = edges_of(
        spark,
        ("A", "1", "R", "B", "1"),
        ("A", "2", "R", "B", "1"),
        ("A", "2", "R", "B", "1"),
        ("A", "9", "R", "B", "1"),
        ("A", "1", "R", "B", "9"),
        ("B", "2", "R", "A", "1"),
    )
    once = merge_edges(have, wanted, nodes, ["R"])
    assert rows(once) == [("A", "1", "R", "B", "1"), ("A", "2", "R", "B", "1")]
    assert rows(merge_edges(once, wanted, nodes, ["R"])) == rows(once)


def test_keys_are_strings(spark):
    ids = spark.createDataFrame([(7, 8), (None, 1)], "a long, b long")
    assert [tuple(r) for r in as_edges(ids, "A", "a", "R", "B", "b").collect()] == [("A", "7", "R", "B", "8")]
    assert [r.key for r in as_nodes(ids, "A", "a").collect()] == ["7"]


def test_match(spark, rows):
    nodes = nodes_of(spark, ("G", "1", {"name": "Red Ring"}), ("G", "2", {"name": "red"}), ("H", "1", {"name": "red"}), ("G", "3", {}))
    assert rows(match_nodes(nodes, "G", "name", "red"), "key") == [("2",)]
    assert rows(match_nodes(nodes, "G", "name", "Ri", "contains"), "key") == [("1",)]
    edges = edges_of(spark, ("G", "1", "R", "H", "1"), ("G", "2", "Q", "H", "1"), ("G", "3", "R", "H", "9"))
    assert rows(match_pattern(nodes, edges, "R", nodes, "G", "H"), "src_key", "dst_key") == [("1", "1")]


# --- documents ---------------------------------------------------------------

DOCS = [
    # id, landed, body
    (1, 1, {"first_release_date": 0, "game_type": 0, "franchise": 0, "total_rating": 1.5, "summary": "old", "url": "u"}),
    (1, 2, {"first_release_date": 946684800, "game_type": 99, "franchise": 5, "genres": [{"id": 1, "name": "Old"}],
            "similar_games": [{"id": 2}, {"id": 9}, {"id": 2}], "url": "u2"}),
    (2, 3, {"game_type": None, "genres": [{"id": 1, "name": "New"}, {"id": 2}],
            "involved_companies": [{"id": 5}, {"id": 6, "company": {"id": 60, "name": "C"}}]}),
    (3, 4, {"franchise": 77, "first_release_date": 1}),  # no node
    (4, 5, {"franchise": 5}),  # id node, no game
]


def landed(spark):
    rows = [(json.dumps({"id": i, **body}), seq) for i, seq, body in DOCS]
    return spark.createDataFrame(rows, "payload string, seq long").repartition(3)


def edges_of_none(spark):
    return spark.createDataFrame([], EDGES)


def base(spark):
    nodes = nodes_of(
        spark,
        *[("Catalog_ID", k, {"summary": "before", "kept": "k"}) for k in "124"],
        ("Game", "1", {"name": "a"}),
        ("Game", "2", {"name": "b"}),
    )
    return nodes, edges_of_none(spark)


def ingest(spark, graph=None):
    graph = graph or (base(spark)[0], edges_of_none(spark))
    return games.ingest_documents(graph, landed(spark), [F.col("seq").desc()], "seq")[:2]


def test_documents_to_edges(spark):
    _, edges = ingest(spark)
    both = [("Catalog_ID", "1", "5"), ("Catalog_ID", "4", "5"), ("Game", "1", "5")]
    assert hops(edges, "PART_OF_FRANCHISE") == both
    assert hops(edges, "RELEASED_IN") == [("Catalog_ID", "1", "2000"), ("Game", "1", "2000")]
    assert hops(edges, "HAS_TYPE") == [("Catalog_ID", "1", "0"), ("Game", "1", "0")]
    assert hops(edges, "HAS_GENRE") == [(l, k, g) for l in ("Catalog_ID", "Game") for k, g in (("1", "1"), ("2", "1"), ("2", "2"))]
    assert hops(edges, "INVOLVES_COMPANY") == [("Catalog_ID", "2", "60"), ("Game", "2", "60")]
    assert hops(edges, "SIMILAR_TO") == [("Game", "1", "2")]


def test_documents_to_nodes(spark):
    nodes = as_dict(ingest(spark)[0])
    assert set(nodes) == {
        ("Catalog_ID", "1"), ("Catalog_ID", "2"), ("Catalog_ID", "4"), ("Game", "1"), ("Game", "2"),
        ("Franchise", "5"), ("Release_Year", "2000"), ("Release_Year", "1970"), ("GameType", "0"), ("Genre", "1"), ("Genre", "2"), ("Company", "60"),
    }
    assert nodes["Genre", "1"] == {"name": "New"} and nodes["Genre", "2"] == {}
    assert nodes["GameType", "0"] == {"name": "main_game"}
    first = nodes["Catalog_ID", "1"]
    # The last document has no summary: the property goes; others stay.
    assert first["url"] == "u2" and "summary" not in first and "total_rating" not in first and first["kept"] == "k"
    assert first["first_release_date"] == "2000-01-01T00:00:00" and json.loads(first["payload"])["franchise"] == 5
    # No date counts as epoch 0 on the node, without a year edge.
    assert nodes["Catalog_ID", "4"]["first_release_date"] == "1970-01-01T00:00:00"


def test_documents_twice_change_nothing(spark, rows):
    once = ingest(spark)
    twice = ingest(spark, once)
    assert as_dict(twice[0]) == as_dict(once[0])
    assert rows(twice[1]) == rows(once[1])


def test_document_edges_of_one_rule(spark, rows):
    from siteweave.sources import read_payload

    docs = read_payload(landed(spark), "payload", L.DOCUMENT_FIELDS)
    nodes, _ = base(spark)
    one = L.document_edges(docs, nodes, nodes, [L.has_genre])
    assert rows(one) == rows(ingest(spark)[1].filter("rel_type = 'HAS_GENRE'"))


def test_similar_both_ways(spark, rows):
    from siteweave.sources import read_payload

    docs = read_payload(landed(spark), "payload", L.DOCUMENT_FIELDS)
    out = L.similar_edges(L.document_links(docs, [L.similar_to]), base(spark)[0], bidirectional=True)
    assert rows(out, "src_key", "dst_key") == [("1", "2"), ("2", "1")]


# --- games, streams, averages ------------------------------------------------


def stream_rows(spark):
    rows = [("s1", "a", 10.0), ("s2", "a", 30.0), ("s3", "a", 5.0), ("s4", "a", 1.0), ("s5", "b", 20.0), ("s6", "new", 0.0), ("s7", "b", None)]
    df = spark.createDataFrame(rows, "stream_id string, name string, viewer_count double")
    return df.withColumn("title", F.lit("t")).withColumn("user_name", F.lit("u"))


def test_streams_attach_by_name(spark, rows):
    owners = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b")], "key string, name string")
    nodes, edges, created = games.stream_graph(owners, stream_rows(spark), 2, [F.col("viewer_count").desc_nulls_last()])
    assert rows(edges, "src_key", "dst_key") == [
        ("1", "s1"), ("1", "s2"), ("2", "s1"), ("2", "s2"), ("3", "s5"), ("3", "s7"), ("new", "s6")
    ]
    assert rows(created, "label", "key") == [("Game", "new")]
    assert nodes.count() == 5


def test_averages_pool_same_names(spark, rows):
    owners = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", "c"), ("5", "d"), ("6", "e")], "key string, name string")
    streams = spark.createDataFrame(
        [("s1", 10.0), ("s2", 30.0), ("s3", 20.0), ("s4", None), ("s5", 0.0)], "key string, viewer_count double"
    )
    edges = edges_of(
        spark,
        *[("Game", g, "HAS_STREAM", "Stream", s) for g, s in [("1", "s1"), ("2", "s2"), ("3", "s3"), ("4", "s4"), ("5", "s5")]],
    )
    averages = games.average_views(owners, edges, streams)
    assert rows(averages) == [("a", 20.0), ("b", 20.0), ("d", 0.0)]
    values, links = games.average_view_graph(owners, averages, F.col("average").cast("string"))
    assert rows(values, "key") == [("0.0",), ("20.0",)]  # equal averages share a node
    assert rows(links, "src_key", "dst_key") == [("1", "20.0"), ("2", "20.0"), ("3", "20.0"), ("5", "0.0")]


def stream_graph(spark, viewers):
    nodes = nodes_of(spark, ("Game", "1", {"name": "a"}), ("Stream", "s", {"viewer_count": viewers}))
    return nodes, edges_of(spark, ("Game", "1", "HAS_STREAM", "Stream", "s"))


@pytest.mark.parametrize("replace, values", [(False, {"10.0", "20.0"}), (True, {"20.0"})])
def test_average_rerun(spark, replace, values):
    """Stale averages stay, unless edges are replaced."""
    nodes, edges = games.ingest_average_views(stream_graph(spark, "10"))
    changed = merge_props(nodes, assign_props(spark.createDataFrame([("s", "20")], "k string, viewer_count string"), "Stream", "k", ["viewer_count"]), ["Stream"])
    nodes, edges = games.ingest_average_views((changed, edges), replace)
    assert {k for _, _, k in hops(edges, "HAS_AVERAGE_VIEW_COUNT")} == values
    assert {k for l, k in as_dict(nodes) if l == "Average_View_Count"} == values


def test_top_games(spark, rows):
    rows_in = [(str(i), f"g{i}", "art", i) for i in range(12)]
    top = spark.createDataFrame(rows_in, "key string, name string, box_art_url string, viewers int")
    streams = spark.createDataFrame([(f"s{i}", f"g{i % 12}", float(i)) for i in range(120)], "stream_id string, name string, viewer_count double")
    streams = streams.withColumn("title", F.lit("t")).withColumn("user_name", F.lit("u"))
    empty = (nodes_of(spark, ("Game", "99", {"name": "g11"})), edges_of_none(spark))
    nodes, edges = games.ingest_top_games(empty, top, streams, [F.col("viewers").desc()], [F.col("viewer_count").desc()])
    found = as_dict(nodes)
    assert sum(l == "Catalog_ID" for l, _ in found) == 10 and ("Game", "1") not in found and ("Game", "2") in found
    assert found["Game", "11"] == {"name": "g11", "box_art_url": "art"}
    # Five streams for each of ten names; the last name has two games.
    assert len(hops(edges, "HAS_STREAM")) == 55 and len(hops(edges, "HAS_CATALOG_ID")) == 10
    assert ("Game", "99", "s119") in hops(edges, "HAS_STREAM")


def test_similar_games(spark):
    docs = [
        {"id": 1, "similar_games": [{"id": 5, "name": "five", "cover": {"url": "c5"}}, {"id": 6, "name": "six"}]},
        {"id": 2, "similar_games": [{"id": 5, "name": "five"}, {"id": 7, "name": "unknown"}]},
        {"id": 3},
    ]
    from siteweave.sources import read_payload

    parsed = read_payload(spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string"), "doc", L.SIMILAR_SCHEMA)
    catalogue = spark.createDataFrame([("five",), ("six",), ("six",)], "name string")
    streams = stream_rows(spark).withColumn("name", F.lit("six"))
    graph = (nodes_of(spark, ("Catalog_ID", "1", {})), edges_of_none(spark))
    nodes, edges = games.ingest_similar_games(graph, parsed, catalogue, streams, ["stream_id"])
    found = as_dict(nodes)
    assert found["Game", "5"] == {"name": "five", "box_art_url": "c5"} and found["Game", "6"]["box_art_url"] == ""
    assert ("Game", "7") not in found and ("Catalog_ID", "5") in found
    assert hops(edges, "HAS_STREAM") == [("Game", "6", s) for s in ("s1", "s2", "s3")]


def test_similar_games_are_told_once(spark):
    """The games are kept: nodes and edges are made of them, and the documents are not read again for each."""
    from siteweave.session import stored
    from siteweave.sources import read_payload

    doc = {"id": 1, "similar_games": [{"id": 5, "name": "five", "cover": {"url": "c5"}}, {"id": 6, "name": None}]}
    landed = stored(spark.createDataFrame([(json.dumps(doc),)], "doc string"), "landed")
    catalogue = stored(spark.createDataFrame([("five",), (None,)], "name string"), "catalogue")
    streams = stream_rows(spark).withColumn("name", F.lit("five"))
    graph = (nodes_of(spark, ("Catalog_ID", "1", {})), edges_of_none(spark))
    parsed = read_payload(landed, "doc", L.SIMILAR_SCHEMA)
    for part in games.ingest_similar_games(graph, parsed, catalogue, streams, ["stream_id"]):
        assert not part.inputFiles()
        assert part.filter(F.lit("5") == (F.col("key") if "key" in part.columns else F.col("src_key"))).count() >= 1


def test_similar_by_name(spark, rows):
    parsed = spark.createDataFrame(
        [
            (1, [(5, "five", None, None), (6, "six", None, None), (5, "five", None, None)]),
            (2, [(5, "five", None, None)]),
            (3, None),
        ],
        L.SIMILAR_SCHEMA,
    )
    nodes = nodes_of(spark, ("Catalog_ID", "1", {}), ("Game", "five", {}))
    assert rows(L.similar_by_name(parsed, nodes), "src_key", "dst_key") == [("1", "five")]


# --- companies, summaries ----------------------------------------------------


def test_companies(spark):
    docs = spark.createDataFrame(
        [(1, "d", "http://a", 5), (2, None, "", 0), (9, "z", "http://z", 7)], "id long, description string, url string, country int"
    )
    graph = (nodes_of(spark, ("Company", "1", {"name": "x"}), ("Company", "2", {"description": "old"})), edges_of_none(spark))
    nodes, edges = games.ingest_companies(graph, docs, ["id"], countries=True)
    found = as_dict(nodes)
    assert found["Company", "1"] == {"name": "x", "description": "d"} and found["Company", "2"] == {}
    assert ("Company", "9") not in found  # unknown company, yet its website and country are made
    assert ("Website", "http://z") in found and ("Country", "7") in found and ("Website", "") not in found
    assert hops(edges, "HAS_WEBSITE") == [("Company", "1", "http://a")]
    assert hops(edges, "LOCATED_IN") == [("Company", "1", "5")]


def test_company_summaries(spark):
    nodes = nodes_of(
        spark,
        *[("Company", k, {"name": n}) for k, n in [("1", "a"), ("2", "b"), ("3", "c")]],
        *[("AI_Company_Summary", s, {"summary": s}) for s in ("only a", "shared", "kept")],
    )
    edges = edges_of(
        spark,
        ("Company", "1", "HAS_SUMMARY", "AI_Company_Summary", "only a"),
        ("Company", "1", "HAS_SUMMARY", "AI_Company_Summary", "shared"),
        ("Company", "2", "HAS_SUMMARY", "AI_Company_Summary", "kept"),
        ("Company", "3", "HAS_SUMMARY", "AI_Company_Summary", "shared"),
    )
    told = spark.createDataFrame([("a", "new"), ("b", "kept"), ("nobody", "lost")], "name string, summary string")
    nodes, edges = games.ingest_company_summaries((nodes, edges), told)
    assert hops(edges, "HAS_SUMMARY") == [("Company", "1", "new"), ("Company", "2", "kept"), ("Company", "3", "shared")]
    assert {k for l, k in as_dict(nodes) if l == "AI_Company_Summary"} == {"new", "shared", "kept"}


def test_generated_company_summaries(spark, rows):
    nodes = nodes_of(spark, ("Company", "1", {"name": "a"}), ("Company", "2", {"name": "a"}), ("Company", "3", {}), ("Game", "1", {"name": "g"}))

    def fn(prompt):
        raise RuntimeError("quota")

    assert rows(games.company_summaries(nodes, fn)) == [("a", "Error: quota")]


def test_summaries_are_told_once(spark):
    """A function that never gives the same text twice still gives nodes and edges that fit."""
    nodes = nodes_of(spark, *[("Company", str(i), {"name": f"n{i}"}) for i in range(5)])
    told = games.company_summaries(nodes, lambda prompt: uuid.uuid4().hex)
    after, edges = games.ingest_company_summaries((nodes, edges_of_none(spark)), told)
    pointed = {k for _, _, k in hops(edges, "HAS_SUMMARY")}
    assert len(pointed) == 5 and pointed == {k for l, k in as_dict(after) if l == "AI_Company_Summary"}


def test_site_summaries_append(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>"), (2, "u", "<p>boom</p>"), (3, "", "<p>y</p>")], "page_id long, url string, html string")

    def fn(prompt):
        if "boom" in prompt:
            raise RuntimeError("no answer")
        return prompt.splitlines()[-1]

    graph = (spark.createDataFrame([], NODES), edges_of_none(spark))
    for stamp in ("t1", "t2"):
        graph = games.ingest_site_summaries(graph, games.site_summaries(pages, "m", stamp, fn))
    found = as_dict(graph[0])
    assert found["Summary", "1@t1"] == {"text": "x", "model": "m", "timestamp": "t1"}
    assert hops(graph[1], "HAS_SUMMARY") == [("Website", "u", "1@t1"), ("Website", "u", "1@t2")]
    assert len(found) == 3  # two summaries, one website


# --- views -------------------------------------------------------------------


def shown_graph(spark):
    nodes = nodes_of(spark, ("G", "1", {"name": "Red"}), ("G", "2", {"name": "blue"}), ("C", "1", {"title": "Tee"}), ("C", "2", {}))
    edges = edges_of(spark, ("G", "1", "R", "C", "1"), ("G", "1", "R", "C", "2"), ("G", "2", "R", "C", "1"))
    return nodes, edges


def test_answer(spark, rows):
    nodes, edges = shown_graph(spark)
    shown, drawn = answer_graph(ask(nodes, edges, "G", "R", "C", "name", "Red"), nodes)
    assert rows(shown, "id", "label", "group", "title", "colour") == [
        ("C:1", "Tee", "C", "title: Tee", "#FF5733"),
        ("C:2", "C", "C", "", "#FF5733"),
        ("G:1", "Red", "G", "name: Red", "#33FF57"),
    ]
    assert rows(drawn, "source", "target", "label") == [("G:1", "C:1", "R"), ("G:1", "C:2", "R")]


def test_answer_of_nothing(spark):
    nodes, edges = shown_graph(spark)
    shown, drawn = answer_graph(ask(nodes, edges, "G", "R", "C", "name", "green"), nodes)
    assert shown.count() == 0 and drawn.count() == 0


def test_edges_need_both_ends_and_repeat(spark, rows):
    nodes, edges = shown_graph(spark)
    found = nodes.filter("key = '1'")
    assert rows(subgraph_edges(edges.unionByName(edges), found), "source", "target") == [("G:1", "C:1")] * 2
    assert subgraph_nodes(distinct_nodes(found.unionByName(found))).count() == 2


def test_paths(spark, rows):
    node = "struct<label: string, key: string, props: map<string,string>>"
    edge = "struct<src_label: string, src_key: string, rel_type: string, dst_label: string, dst_key: string>"
    paths = spark.createDataFrame(
        [([("A", "1", {}), ("B", "2", {})], [("A", "1", "R", "B", "2")]), ([("A", "1", {})], [])],
        f"nodes array<{node}>, edges array<{edge}>",
    )
    assert rows(path_nodes(paths), "label", "key") == [("A", "1"), ("A", "1"), ("B", "2")]
    assert rows(path_edges(paths)) == [("A", "1", "R", "B", "2")]


def test_schema_views(spark, rows):
    nodes, edges = shown_graph(spark)
    odd = edges.unionByName(edges_of(spark, ("G", "1", "", "C", "1"), ("", "1", "R", "C", "1")))
    assert rows(schema_summary(odd)) == [("G", "R", "C")]
    assert rows(schema_text(odd)) == [("G -[:R]-> C",)]
    labels, triples = schema_graph(odd)
    assert rows(labels) == [("C", "#FF5733"), ("G", "#33FF57")] and triples.count() == 1
    assert rows(property_catalogue(nodes)) == [("C", ["title"]), ("G", ["name"])]
    assert rows(catalogue_text(nodes.unionByName(nodes_of(spark, ("G", "3", {"art": "x"}))))) == [("C: title",), ("G: art, name",)]


def test_tiles(spark, rows):
    good = json.dumps({"name": "a", "box_art_url": "u/{width}x{height}"})
    records = spark.createDataFrame(
        [(good, None), (good, "[1]"), ('{"name": "b"}', "oops"), (json.dumps({"name": "c", "box_art_url": "v"}), good), ("", "7")],
        "x string, y string",
    )
    assert rows(tiles(records)) == [("a", "u/150x200"), ("c", "v")]


def test_flatten(spark):
    records = spark.createDataFrame([({"k": "v"}, 5, None)], "node map<string,string>, n int, s string")
    assert tuple(flatten_records(records).first()) == ('{"k":"v"}', "5", None)


def test_hop_nodes(spark, rows):
    nodes, edges = shown_graph(spark)
    hops_found = match_pattern(nodes, edges.filter("src_key = '1'"), "R", nodes, "G", "C")
    assert rows(hop_nodes(hops_found, nodes), "label", "key") == [("C", "1"), ("C", "2"), ("G", "1")]


def test_keys_are_properties(spark, rows):
    nodes = nodes_of(spark, ("Franchise", "5", {}), ("Company", "7", {"name": "Seven", "id": "other"}), ("Odd", "1", {"x": "y"}))
    assert rows(match_nodes(nodes, "Company", "id", "7"), "key") == [("7",)]
    assert rows(match_nodes(nodes, "Company", "id", "other"), "key") == []
    assert rows(property_catalogue(nodes)) == [("Company", ["id", "name"]), ("Franchise", ["id"]), ("Odd", ["x"])]
    drawn = rows(subgraph_nodes(nodes), "id", "label", "title")
    assert drawn == [("Company:7", "Seven", "id: 7<br>name: Seven"), ("Franchise:5", "5", "id: 5"), ("Odd:1", "Odd", "x: y")]


def test_canonical_text_takes_its_words_from_the_graph(spark, rows):
    nodes = nodes_of(spark, ("Game", "1", {"Title": "x"}), ("title", "2", {}))
    edges = edges_of(spark, ("Game", "1", "HAS_Game", "title", "2"))
    asked = spark.createDataFrame([(1, "a gAME has_GAME; TITLE games ID"), (2, None), (3, "")], "i int, q string")
    told = canonical_text(asked, "q", nodes, edges)
    # A name that is a label and a property goes to the property.
    assert rows(told) == [(1, "a Game HAS_Game; Title games ID"), (2, None), (3, "")]
    assert rows(canonical_text(asked, "q", nodes.limit(0), edges.limit(0))) == rows(asked)


def test_pairs_of_a_crowded_document(spark, monkeypatch):
    """A document that holds most of the names is dealt to blocks that meet each other."""
    monkeypatch.setattr(entities, "BLOCK_NAMES", 10)
    tokens = [("crowd", f"c{i}", "B-ORG") for i in range(45)] + [("crowd", f"p{i}", "B-PRODUCT") for i in range(38)]
    tokens += [("d", "c1", "I-ORG"), ("d", "q", "B-PRODUCT"), ("e", "lonely", "B-ORG")]
    pairs = entities.cooccurrence(spark.createDataFrame(tokens, "doc string, word string, entity string"))
    want = {(f"c{i}", f"p{j}") for i in range(45) for j in range(38)} | {("c1", "q")}
    got = [(r.src_key, r.dst_key) for r in pairs.collect()]
    assert len(got) == len(want) and set(got) == want


def test_entity_pass_is_idempotent(spark, rows):
    tokens = spark.createDataFrame([("d", "Acme", "B-ORG"), ("d", "Box", "B-PRODUCT"), ("d", None, "B-ORG")], "doc string, word string, entity string")
    graph = (nodes_of(spark, ("Company", "Acme", {"note": "n"}), ("Genre", "1", {})), edges_of_none(spark))
    once = games.ingest_entities(graph, tokens)
    twice = games.ingest_entities(once, tokens)
    assert as_dict(twice[0]) == as_dict(once[0]) == {
        ("Company", "Acme"): {"name": "Acme", "note": "n"}, ("Product", "Box"): {"name": "Box"}, ("Genre", "1"): {}
    }
    assert hops(twice[1], "SELLS") == [("Company", "Acme", "Box")]


def test_searched_companies(spark, rows):
    docs = spark.createDataFrame(
        [(9, "Big Acme Inc", "first", "https://a", 0), (2, "acme", "second", "https://b", 0), (5, "Other", "x", "https://c", 0)],
        "id long, name string, description string, url string, country long",
    )
    nodes = nodes_of(spark, ("Company", "2", {"name": "Acme"}), ("Company", "3", {"name": "Nobody"}), ("Company", "9", {"name": "Big"}))
    after, edges = games.ingest_searched_companies((nodes, edges_of_none(spark)), docs, ["id"])
    assert as_dict(after)["Company", "2"] == {"name": "Acme", "description": "second"}
    assert as_dict(after)["Company", "9"] == {"name": "Big", "description": "first"}
    assert hops(edges, "HAS_WEBSITE") == [("Company", "2", "https://b"), ("Company", "9", "https://a")]


def test_averages_grow_by_new_streams_only(spark, rows):
    owners = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b")], "key string, name string")
    has = lambda *pairs: edges_of(spark, *[("Game", g, "HAS_STREAM", "Stream", s) for g, s in pairs])
    seen = lambda *values: spark.createDataFrame(list(values), "key string, viewer_count double")
    first = games.grow_average_views(None, owners, has(("1", "s"), ("2", "t")), seen(("s", 10.0), ("t", None)))
    assert rows(averages_of(first, "name")) == [("a", 10.0)]
    second = games.grow_average_views(first, owners, has(("2", "u"), ("3", "v")), seen(("u", 20.0), ("v", 0.0)))
    assert rows(averages_of(second, "name")) == [("a", 15.0), ("b", 0.0)]
    # A stream that is counted anew loses what it had.
    third = games.grow_average_views(second, owners, has(("2", "u")), seen(("u", 50.0)), changed=seen(("u", 20.0)))
    assert rows(averages_of(third, "name")) == [("a", 30.0), ("b", 0.0)]


def test_grown_averages_read_the_increment(spark):
    """The second run's plan has the state and the new streams, and nothing of the earlier ones."""
    from siteweave.session import stored

    owners = stored(spark.createDataFrame([("1", "a")], "key string, name string"), "owners")
    streams = [stored(spark.createDataFrame([(k, 1.0)], "key string, viewer_count double"), f"run_{k}") for k in "st"]
    edges = [edges_of(spark, ("Game", "1", "HAS_STREAM", "Stream", k)) for k in "st"]
    state = stored(games.grow_average_views(None, owners, edges[0], streams[0]), "state")
    grown = games.grow_average_views(state, owners, edges[1], streams[1])
    read = {f.split("/")[-2] for f in grown.inputFiles()}
    assert read == {"owners", "run_t", "state"}
    assert grown.first()["values"] == 2
