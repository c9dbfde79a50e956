"""Links of documents packed as one text for the shuffle."""

import json

from pyspark.sql import functions as F

from siteweave.operators.graph import as_nodes
from siteweave.operators.links import DOCUMENT_SCHEMA, KINDS, document_links, fold_packed, pack_links
from siteweave.plans import games

NAMES = ["plain", "", None, "a\tb\nc", "\x01", "\x01a\x01b", "tab\x01c\t", "5\tGenre\n4\tx", "日本 é😀\r\n"]


def documents(spark):
    bodies = [
        {"id": i % 5, "first_release_date": i * 40_000_000, "franchise": i % 3, "game_type": i % 16,
         "genres": [{"id": 100 + i, "name": name}, {"id": None, "name": "no key"}, None, {"id": 7, "name": name}],
         "involved_companies": [{"id": 1}, {"id": 2, "company": {"id": 50 + i, "name": name}}, None],
         "similar_games": [{"id": (i + 1) % 5}, {"id": 99}]}
        for i, name in enumerate(NAMES)
    ]
    rows = [(seq, json.dumps(b)) for seq, b in enumerate([*bodies, *bodies, {"id": 1}, {"id": 2, "genres": []}])]
    return spark.createDataFrame(rows, "seq int, payload string").repartition(3)


def test_packed_links_are_the_links(spark, rows):
    docs = documents(spark).select("seq", F.inline(F.array(F.from_json("payload", DOCUMENT_SCHEMA))))
    packed = docs.select(F.col("id").cast("string").alias("src_key"), "seq", pack_links([*KINDS]).alias("_links"))
    assert packed.filter("_links IS NULL").count() == 2
    want = document_links(docs, [*KINDS], "seq")
    assert rows(fold_packed(packed, ["src_key"]), *want.columns) == rows(want)
    assert {r.dst_name for r in want.collect()} >= set(NAMES)


def test_documents_shuffle_their_links_as_text(spark, rows):
    """as arrays of structs the links were most of what catalogue_properties and document_nodes put on disk."""
    ids = spark.createDataFrame([(k,) for k in "0123"], "key string")
    nodes = as_nodes(ids, "Catalog_ID", "key").unionByName(as_nodes(ids, "Game", "key"))
    edges = spark.createDataFrame([], "src_label string, src_key string, rel_type string, dst_label string, dst_key string")
    done = games.ingest_documents((nodes, edges), documents(spark), [F.col("seq").desc()], "seq")
    for part in done[:2]:
        assert "struct<rel_type" not in "".join(str(spark.read.parquet(f).schema.simpleString()) for f in part.inputFiles() if "/documents/" in f)
    docs = documents(spark).select("seq", F.inline(F.array(F.from_json("payload", DOCUMENT_SCHEMA))))
    links = document_links(docs, [*KINDS][:-1], "seq")
    made = links.filter("src_key <> '4' OR rel_type = 'RELEASED_IN'")
    assert rows(done.nodes.filter("label NOT IN ('Catalog_ID', 'Game')"), "label", "key") == rows(made.select("dst_label", "dst_key").distinct())
    named = {r.key: r.props.get("name") for r in done.nodes.filter("label = 'Genre'").collect()}
    assert named["7"] == NAMES[-1] and [named.get(str(100 + i)) for i in range(9)] == [n if i not in (4,) else None for i, n in enumerate(NAMES)]
    kept = links.filter("src_key <> '4'").select("src_key", "rel_type", "dst_label", "dst_key").distinct()
    mine = done.edges.filter("src_label = 'Catalog_ID'").select("src_key", "rel_type", "dst_label", "dst_key")
    assert rows(mine) == rows(kept)
    assert rows(done.edges.filter("rel_type = 'SIMILAR_TO'"), "src_key", "dst_key") == [("0", "1"), ("1", "2"), ("2", "3")]
