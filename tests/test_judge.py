"""Landed documents judged by the declared types of their fields."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from siteweave.operators.graph import as_nodes
from siteweave.operators.links import DOCUMENT_FIELDS
from siteweave.plans import games
from siteweave.sources.judge import judge_documents, split_judged

CASES = {
    '{"id": 1}': None,
    '{"id": 2, "total_rating": 5, "genres": null, "url": 7}': None,
    '{"id": "abc"}': "id is no bigint",
    '{"id": 5.5}': "id is no bigint",
    '{"id": 99999999999999999999}': "id is no bigint",
    '{"id": null}': "no id",
    '{"other": 1}': "no id",
    '{"id": "abc", "genres": 5}': "id is no bigint",
    '{"id": 3, "genres": 5}': "genres is no array",
    '{"id": 3, "genres": [{"id": "x"}]}': "a nested value has another type",
    '{"id": 3, "first_release_date": "soon"}': "first_release_date is no bigint",
    '{"id": 3, "game_type": 5000000000}': "game_type is no int",
    '{"id": 3, "total_rating": "x"}': "total_rating is no double",
    "[1]": "no JSON object",
    "{": "no JSON object",
    "3": "no JSON object",
    "null": "no JSON object",
    "": "no JSON object",
    None: "no JSON object",
}


def landed(spark):
    return spark.createDataFrame(list(enumerate(CASES)), "seq int, payload string")


def test_reasons(spark):
    judged = judge_documents(landed(spark), DOCUMENT_FIELDS)
    assert {r.payload: r.reason for r in judged.collect()} == CASES
    good, rejects = split_judged(judged)
    assert good.count() + rejects.count() == len(CASES)
    assert rejects.columns == ["seq", "payload", "reason"]


def test_every_landed_row_is_used_or_rejected(spark):
    nodes = as_nodes(spark.createDataFrame([(k,) for k in "123"], "key string"), "Catalog_ID", "key")
    edges = spark.createDataFrame([], "src_label string, src_key string, rel_type string, dst_label string, dst_key string")
    seen = Observation("pass")
    done = games.ingest_documents((nodes, edges), landed(spark), [F.col("seq").desc()], "seq", seen)
    assert {r.payload: r.reason for r in done.rejects.collect()} == {p: r for p, r in CASES.items() if r}
    counts = seen.get
    assert counts["landed"] == len(CASES) and counts["rejected"] == done.rejects.count()
    assert counts["id is no bigint"] == 4 and counts["no JSON object"] == 6
    props = {r.key: r.props for r in done.nodes.collect()}
    assert props["2"]["total_rating"] == "5.0" and "total_rating" not in props["3"]
    assert done.edges.count() == 0


def test_documents_are_parsed_once(spark):
    nodes = as_nodes(spark.createDataFrame([("1",)], "key string"), "Catalog_ID", "key")
    edges = spark.createDataFrame([], "src_label string, src_key string, rel_type string, dst_label string, dst_key string")
    done = games.ingest_documents((nodes, edges), landed(spark), [F.col("seq").desc()], "seq")
    for part in done:
        assert "from_json" not in part._jdf.queryExecution().optimizedPlan().toString()


def test_a_spoilt_document_is_read_once_to_tell_why(spark):
    """F7, F8: every field that was looked at read the document again, and so did every reader of the reason."""
    judged = judge_documents(landed(spark), "id long, total_rating double, genres array<struct<id: long, name: string>>")
    plan = judged.filter("reason IS NOT NULL").select("reason")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1
