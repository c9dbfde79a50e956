"""Sources, sinks, ranking and lookups on hand-made rows."""

import random
import time

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siteweave.operators.aggregates import assemble_pages
from siteweave.operators.entities import cooccurrence, entity_nodes
from siteweave.operators.filters import exclude_ilike, exclude_like
from siteweave.operators.lookups import company_website
from siteweave.operators.ranking import assign_uid, colour_index, dedupe_first, top_k
from siteweave.plans.company import usable_pages
from siteweave.plans.games import split_documents
from siteweave.session import new_table_path, shared_dir
from siteweave.sources import (
    append,
    append_new,
    explode_list,
    lookup_by_ids,
    net_new,
    read_graph,
    read_landed,
    read_payload,
    read_upserted,
    search_first,
    split_rejects,
    upsert,
    upsert_table,
    write_graph,
    write_snapshot,
)


@pytest.mark.parametrize("partitions", [1, 7])
def test_assign_uid_equals_global_row_number(spark, partitions):
    rng = random.Random(1)
    values = [(rng.choice(["hot", "hot", *"abcdef"]), i) for i in range(500)]
    df = spark.createDataFrame(values, "k string, i int").repartition(partitions)
    got = {(r.k, r.i): r.UID for r in assign_uid(df, ["k", "i"]).collect()}
    assert got == {v: n for n, v in enumerate(sorted(values), 1)}


def test_assign_uid_of_nothing(spark):
    assert assign_uid(spark.createDataFrame([], "k string"), ["k"]).collect() == []


def test_assign_uid_nulls_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert {r.k: r.UID for r in assign_uid(df, ["k"]).collect()} == {None: 1, "a": 2, "b": 3}


def test_ranking(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 5), (None, 9)], "k string, v int")
    assert rows(dedupe_first(df, ["k"], ["v"])) == [("a", 1), ("b", 5), (None, 9)]
    assert rows(dedupe_first(df, ["k"], ["v"], "n")) == [("a", 1, 1), ("b", 5, 1), (None, 9, 1)]
    assert rows(top_k(df, ["k"], [F.col("v").desc()], 2)) == [("a", 2), ("a", 3), ("b", 5), (None, 9)]
    plan = dedupe_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_colours_repeat(spark):
    labels = spark.createDataFrame([(f"l{i:02d}",) for i in range(12)] * 2, "label string")
    colours = [r.colour for r in colour_index(labels, "label").orderBy("label").collect()]
    assert colours[0] == colours[10] == "#FF5733" and colours[1] == colours[11] and len(colours) == 12


def test_append_and_append_new(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    plain, keyed = new_table_path(spark, "plain"), new_table_path(spark, "keyed")
    for _ in range(2):
        append(df, plain)
        append_new(df, keyed, "id")
    assert spark.read.parquet(plain).count() == 4
    append_new(spark.createDataFrame([(2, "x"), (3, "c")], "id int, v string"), keyed, ["id"])
    assert rows(spark.read.parquet(keyed)) == [(1, "a"), (2, "b"), (3, "c")]


def test_upsert(spark, rows):
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    incoming = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, None, 1)], "id int, v string, seq int")
    assert rows(upsert(existing, incoming, "id", [F.col("seq").desc()])) == [(1, "a"), (2, "new"), (3, None)]


def test_net_new_lookup_rejects(spark, rows):
    source = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int")
    seen = spark.createDataFrame([(3,), (3,), (9,)], "id int")
    assert rows(net_new(source, seen, "id")) == [(1,), (2,), (2,)]
    assert rows(lookup_by_ids(source.distinct(), seen, "id")) == [(3,)]
    good, bad = split_rejects(source.distinct(), F.when(F.col("id") > 2, "large"))
    assert rows(good) == [(1,), (2,)] and rows(bad) == [(3, "large")]


def test_payload(spark, rows):
    docs = spark.createDataFrame(
        [(1, '{"id": 7, "genres": [{"id": 1, "name": "x"}, {"id": 2}], "other": 1}'), (2, '{"id": 8}'), (3, "broken")],
        "n int, doc string",
    )
    parsed = read_payload(docs, "doc", "id long, genres array<struct<id: long, name: string>>")
    assert rows(parsed, "n", "id") == [(1, 7), (2, 8), (3, None)]
    assert rows(explode_list(parsed, "genres", "g").select("id", "g.id", "g.name")) == [(7, 1, "x"), (7, 2, None)]


def test_landed_files(spark, rows):
    """A later file replaces an earlier one's document; a broken line is rejected by itself."""
    path = new_table_path(spark, "landing")
    for line in ['{"id": 1, "v": "old"}', '{"id": 1, "v": "new"}', '{"id": 2, "v', '{"v": "x"}']:
        spark.createDataFrame([(line,)], "value string").write.mode("append").text(path)
        time.sleep(0.05)
    landed = read_landed(spark, path)
    good, bad = split_documents(landed)
    assert rows(bad, "reason") == [("no JSON object",), ("no id",)]
    parsed = read_payload(good, "payload", "id long, v string")
    assert rows(dedupe_first(parsed, ["id"], [F.col("landed_at").desc()]), "id", "v") == [(1, "new")]


def test_snapshots_feed_the_next(spark, rows):
    folder = new_table_path(spark, "table")
    path = write_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), folder)
    for value in ("c", "d"):
        incoming = spark.createDataFrame([(2, value)], "id int, v string")
        path = write_snapshot(upsert(spark.read.parquet(path), incoming, "id", ["v"]), folder)
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "d")]


def test_search_first(spark, rows):
    docs = spark.createDataFrame(
        [(1, "the red ring of power"), (2, "Red Ring"), (3, "red"), (4, "spring red ringing"), (5, None), (6, "red")],
        "id int, text string",
    )
    probes = spark.createDataFrame([("red",), ("red",), ("RED ring",), ("ring red",), ("",), (None,), ("--",)], "p string")
    assert rows(search_first(probes, docs, "p", "text", ["id"]), "p", "id") == [("red", 3)]
    latest = search_first(probes, docs, "p", "text", [F.col("id").desc()], mode="phrase")
    assert rows(latest) == [("RED ring", 2), ("red", 6)]
    with pytest.raises(KeyError):
        search_first(probes, docs, "p", "text", ["id"], mode="fuzzy")
    none = search_first(probes.filter("p = '--'"), docs, "p", "text", ["id"], mode="phrase")
    assert none.columns == ["p", "id"] and none.count() == 0


def test_search_contains_by_brute_force(spark):
    rng = random.Random(5)
    letters = "abé😀 "
    docs = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    probes = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(60)]
    want = {}
    for p in set(probes):
        hits = [i for i, t in docs if p in t]
        if hits:
            want[p] = max(hits)
    found = search_first(
        spark.createDataFrame([(p,) for p in probes], "p string"),
        spark.createDataFrame([*docs, (99, None)], "id int, text string"),
        "p",
        "text",
        [F.col("id").desc()],
        mode="contains",
    )
    assert {r.p: r.id for r in found.collect()} == want


def test_search_phrase_by_brute_force(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    probes = [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    want = {}
    for p in set(probes):
        hits = [i for i, t in docs if f" {p} " in f" {t} "]
        if hits:
            want[p] = min(hits)
    found = search_first(
        spark.createDataFrame([(p,) for p in probes], "p string"),
        spark.createDataFrame(docs, "id int, text string"),
        "p",
        "text",
        ["id"],
        mode="phrase",
    )
    assert {r.p: r.id for r in found.collect()} == want


def test_assemble_pages(spark, rows):
    pages = [("d", i, f"p{i}") for i in range(25)] + [("d", 99, ""), ("e", 3, "z"), ("e", 1, "y"), ("f", 0, None)]
    df = spark.createDataFrame(pages, "doc string, page int, text string").repartition(5)
    want = [("d", "\n".join(f"p{i}" for i in range(25))), ("e", "y\nz")]
    assert rows(assemble_pages(df, "doc", "page", "text")) == want
    assert rows(assemble_pages(df, "doc", "page", "text", pages_per_part=10)) == want


def test_a_long_document_is_one_row(spark):
    pages = spark.range(2500).select(F.lit("d").alias("doc"), "id", F.concat(F.lit("p"), "id").alias("text"))
    (row,) = assemble_pages(pages.repartition(7), "doc", "id", "text").collect()
    assert row.text == "\n".join(f"p{i}" for i in range(2500))


def test_the_history_is_only_probed(spark):
    """A small increment meets a history above the broadcast threshold: no exchange below their join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        source = spark.range(2_000_000, 2_020_000, 1000)
        fresh = net_new(source, spark.range(2_010_000), "id")
        lines = fresh._jdf.queryExecution().executedPlan().toString().split("\n")
        assert fresh.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = next(i for i, line in enumerate(lines) if "Range (0, 2010000" in line)
    above = [line for line in lines[:at] if "Exchange hashpartitioning" in line or "LeftSemi" in line]
    assert "BroadcastHashJoin" in above[-1] and "LeftSemi" in above[-1]


def test_rows_of_one_key_in_a_batch(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    ordered, plain = new_table_path(spark, "ordered"), new_table_path(spark, "plain")
    append_new(df, ordered, "id", [F.col("v").desc()])
    append_new(df, plain, "id")
    assert rows(spark.read.parquet(ordered)) == [(1, "b"), (2, "c")]
    assert rows(spark.read.parquet(plain), "id") == [(1,), (2,)]


def test_graph_without_edges_and_labels_like_numbers(spark, rows):
    nodes = spark.createDataFrame([("2024", "1", {"a": "b"})], "label string, key string, props map<string,string>")
    edges = spark.createDataFrame([], "src_label string, src_key string, rel_type string, dst_label string, dst_key string")
    back, none = read_graph(spark, write_graph(nodes, edges, new_table_path(spark, "graph")))
    assert [(r.label, r.key, r.props) for r in back.collect()] == [("2024", "1", {"a": "b"})]
    assert none.count() == 0 and none.columns == edges.columns


def test_excluded_words_are_no_patterns(spark, rows):
    df = spark.createDataFrame([("a_b",), ("axb",), ("A_B c",), ("100%",), ("1000",), (None,)], "t string")
    assert rows(exclude_like(df, "t", ["a_b", "0%"])) == [("1000",), ("A_B c",), ("axb",)]
    assert rows(exclude_ilike(df, "t", ["a_b", "0%"])) == [("1000",), ("axb",)]


def test_sells_needs_both_nodes(spark, rows):
    tokens = spark.createDataFrame([("1", "Acme", "XORGY"), ("1", "Kit", "B-PRODUCT")], "doc string, word string, entity string")
    assert cooccurrence(tokens).count() == 0


def test_entities(spark, rows):
    tokens = spark.createDataFrame(
        [
            ("1", "Acme", "B-ORG"), ("1", "Acme", "I-ORG"), ("1", "Kit", "B-PRODUCT"), ("1", None, "B-ORG"),
            ("1", "Box", "I-PRODUCT"), ("2", "Zed", "B-ORG"), ("3", "Ann", "B-PER"), ("3", "Oslo", "I-LOC"),
        ],
        "doc string, word string, entity string",
    )
    assert rows(entity_nodes(tokens)) == [
        ("Company", "Acme"), ("Company", "Zed"), ("Loc", "Oslo"), ("Per", "Ann"), ("Product", "Box"), ("Product", "Kit")
    ]
    assert rows(cooccurrence(tokens), "src_key", "dst_key") == [("Acme", "Box"), ("Acme", "Kit")]


def test_company_website_messages(spark):
    requested = spark.createDataFrame([(i,) for i in range(8)], "game int")
    games = spark.createDataFrame(
        [(1, None), (2, []), (3, [30]), (4, [40, 50]), (5, [50]), (6, [60]), (7, [70])],
        "id int, involved_companies array<int>",
    )
    involved = spark.createDataFrame([(40, None), (50, 5), (60, 6), (70, 7)], "id int, company int")
    companies = spark.createDataFrame(
        [(6, None), (7, [("http://a",), ("http://b",)])], "id int, websites array<struct<url: string>>"
    )
    found = {r.game: r.answer for r in company_website(requested, "game", games, involved, companies).collect()}
    assert found == {
        0: "Game not found.",
        1: "No company information available.",
        2: "No company information available.",
        3: "Company ID not found.",
        4: "Company details missing.",
        5: "Company website not found.",
        6: "Company website not found.",
        7: "http://a http://b",
    }


def test_pushed_filters(spark):
    """The page filters reach the parquet reader, and only the columns in use are read."""
    path = new_table_path(spark, "scraped")
    spark.createDataFrame(
        [("a.com", "x", 1)], "website string, scrappeddata string, unused int"
    ).write.parquet(path)
    plan = usable_pages(spark.read.parquet(path)).select("website")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(scrappeddata)" in plan and "StringContains(scrappeddata,HTTP Error)" in plan
    assert "unused" not in plan


def test_graph_snapshot(spark, rows):
    nodes = spark.createDataFrame(
        [("A", "1", {"n": "x"}), ("B", "2", {})], "label string, key string, props map<string,string>"
    )
    edges = spark.createDataFrame(
        [("A", "1", "R", "B", "2")], "src_label string, src_key string, rel_type string, dst_label string, dst_key string"
    )
    folder = new_table_path(spark, "graph")
    first, second = write_graph(nodes, edges, folder), write_graph(nodes, edges, folder)
    assert first != second
    again, edges_again = read_graph(spark, first)
    assert rows(again, "label", "key", F.to_json("props")) == rows(nodes, "label", "key", F.to_json("props"))
    assert rows(edges_again) == rows(edges)


def test_shared_dir(spark):
    """The folder the session names, where it names one; Spark checkpoints below it."""
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir", folder)
    assert folder in spark.sparkContext.getCheckpointDir()
    assert new_table_path(spark, "x").startswith(folder) and new_table_path(spark, "x") != new_table_path(spark, "x")


def test_upsert_rewrites_touched_folders_only(spark, rows):
    path = new_table_path(spark, "dealt")
    first = spark.range(200).select("id", F.lit("old").alias("v"))
    upsert_table(first, path, "id", ["v"], buckets=16)
    folder = Path(path.removeprefix("file:"))
    before = {f.parent.name: {g.name for g in f.parent.glob("*.parquet")} for f in folder.glob("*/*.parquet")}
    assert len(before) == 16
    more = spark.createDataFrame([(3, "b"), (3, "a"), (1000, "new")], "id long, v string")
    for _ in range(2):
        upsert_table(more, path, "id", ["v"], buckets=4)  # the table keeps its number of folders
    after = {f.parent.name: {g.name for g in f.parent.glob("*.parquet")} for f in folder.glob("*/*.parquet")}
    changed = {name for name in after if after[name] != before.get(name)}
    assert set(after) == set(before) and 1 <= len(changed) <= 2
    got = dict(rows(read_upserted(spark, path)))
    assert len(got) == 201 and got[3] == "a" and got[1000] == "new" and got[4] == "old"
