"""Queries over paths and over records of mixed values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fixed
from ...operators.graph import EDGE, as_edges, match_pattern
from ...operators.paths import match_paths, with_properties
from ...operators.records import (
    draw_records,
    flat_values,
    node_value,
    path_value,
    record,
    record_values,
    relationship_value,
)
from ...sources import read_table
from .. import adapters
from .base import LABEL_NODES, TRADE_EDGES, query

# Suppliers as companies that are like two others each; there are cycles and loops.
_LIKE = """
alike AS (
  SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS src, CAST((s_suppkey * k + 1) % n AS VARCHAR) AS dst
  FROM supplier, (SELECT count(*) AS n FROM supplier), (VALUES (3), (7)) AS v(k))"""


def _like(spark, folder):
    suppliers = read_table(spark, folder, "supplier")
    n = suppliers.agg(F.count(F.lit(1))).scalar()
    other = F.explode(F.array((F.col("s_suppkey") * 3 + 1) % n, (F.col("s_suppkey") * 7 + 1) % n))
    pairs = suppliers.select("s_suppkey", other.alias("other"))
    return suppliers, as_edges(pairs, fixed.COMPANY, "s_suppkey", fixed.SIMILAR_TO, fixed.COMPANY, "other")


def _walk_sql(least, most, back=False):
    steps = "SELECT src AS a, dst AS b, src || '>' || dst AS edge FROM alike"
    if back:
        steps += " UNION ALL SELECT dst, src, src || '>' || dst FROM alike WHERE src <> dst"
    return f"""WITH RECURSIVE {_LIKE},
steps AS ({steps}),
walks(nodes, edges, place) AS (
  SELECT [CAST(s_suppkey AS VARCHAR)], CAST([] AS VARCHAR[]), CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 5 = 0
  UNION ALL
  SELECT list_append(nodes, b), list_append(edges, edge), b FROM walks JOIN steps ON a = place
  WHERE len(edges) < {most} AND NOT list_contains(edges, edge))
SELECT array_to_string(nodes, '-') AS nodes, array_to_string(edges, ' ') AS edges FROM walks WHERE len(edges) >= {least}"""


def _told(paths):
    hops = F.transform("edges", lambda e: F.concat(e["src_key"], F.lit(">"), e["dst_key"]))
    return paths.select(F.array_join(F.transform("nodes", lambda n: n["key"]), "-").alias("nodes"), F.array_join(hops, " ").alias("edges"))


def _starts(suppliers):
    return suppliers.filter("s_suppkey % 5 = 0").select(F.lit(fixed.COMPANY).alias("label"), F.col("s_suppkey").cast("string").alias("key"))


@query("match_paths", _walk_sql(0, 4))
def paths_out(spark, folder):
    """Every fifth company, and where up to four relationships lead from it."""
    suppliers, edges = _like(spark, folder)
    return _told(match_paths(_starts(suppliers), edges, [fixed.SIMILAR_TO], 0, 4))


@query("match_paths_both_ways", _walk_sql(2, 3, back=True))
def paths_both_ways(spark, folder):
    suppliers, edges = _like(spark, folder)
    return _told(match_paths(_starts(suppliers), edges, [fixed.SIMILAR_TO], 2, 3, both_ways=True))


# Records of three kinds: a game and its company as nodes with the relationship and a number;
# a path from a game over a company to its country; a text and a list alone.
_MIXED = f"""
WITH {LABEL_NODES}, {TRADE_EDGES},
hops AS (
  SELECT e.* FROM edges e JOIN nodes g ON g.label = src_label AND g.key = src_key AND contains(g.name, 'red')
  WHERE rel_type = 'INVOLVES_COMPANY'),
ways AS (
  SELECT hops.src_key AS game, hops.dst_key AS company, l.dst_key AS country
  FROM hops JOIN edges l ON l.src_label = 'Company' AND l.src_key = hops.dst_key WHERE CAST(hops.src_key AS BIGINT) % 2 = 1),
pairs AS (SELECT src_key AS game, dst_key AS company FROM hops WHERE CAST(src_key AS BIGINT) % 2 = 0),
found AS (
  SELECT 'Game' AS label, game AS key FROM pairs UNION SELECT 'Company', company FROM pairs
  UNION SELECT 'Game', game FROM ways UNION SELECT 'Company', company FROM ways UNION SELECT 'Country', country FROM ways),
drawn AS (
  SELECT 'Game' AS sl, game AS sk, 'INVOLVES_COMPANY' AS rel, 'Company' AS dl, company AS dk FROM pairs
  UNION ALL SELECT 'Game', game, 'INVOLVES_COMPANY', 'Company', company FROM ways
  UNION ALL SELECT 'Company', company, 'LOCATED_IN', 'Country', country FROM ways)
"""


def _mixed(spark, folder):
    nodes, edges = adapters.trade_graph(spark, folder)
    red = nodes.filter((F.col("label") == fixed.GAME) & F.try_element_at("props", F.lit("name")).contains("red"))
    odd = F.col("key").cast("long") % 2 == 1
    hops = match_pattern(red.filter(~odd), edges, fixed.INVOLVES_COMPANY, nodes, fixed.GAME, fixed.COMPANY)
    pairs = hops.select(
        F.col("src_key").alias("id"),
        record(
            {
                "game": node_value(F.col("src_label"), F.col("src_key"), F.col("src_props")),
                "involves": relationship_value(F.struct(*EDGE)),
                "company": node_value(F.col("dst_label"), F.col("dst_key"), F.col("dst_props")),
                "number": F.col("src_key").cast("long"),
            }
        ).alias("record"),
    )
    over = edges.filter(F.col("rel_type").isin(fixed.INVOLVES_COMPANY, fixed.LOCATED_IN))
    paths = with_properties(match_paths(red.filter(odd), over, [fixed.INVOLVES_COMPANY, fixed.LOCATED_IN], 2, 2), nodes)
    ways = paths.select(
        F.col("nodes")[0]["key"].alias("id"),
        record({"way": path_value(F.col("nodes"), F.col("edges")), "note": F.lit(None).cast("string")}).alias("record"),
    )
    alone = red.select(
        F.col("key").alias("id"),
        record({"name": F.col("props")["name"], "parts": F.split(F.col("props")["name"], " ").cast("variant")}).alias("record"),
    )
    return pairs.union(ways).union(alone)


@query(
    "record_nodes",
    _MIXED
    + """SELECT label || ':' || key AS id, name AS label, label AS "group",
       CASE label WHEN 'Game' THEN 'box_art_url: https://art.example/{width}x{height}/' || key || '<br>catalog_id: ' || key || '<br>name: '
                  WHEN 'Company' THEN 'id: ' || key || '<br>name: ' ELSE 'code: ' || key || '<br>title: ' END || name AS title
FROM found JOIN nodes USING (label, key)""",
)
def nodes_of_records(spark, folder):
    """Nodes of records in which scalars, nodes, relationships and paths are mixed, with their properties."""
    return draw_records(_mixed(spark, folder))[0].select("id", "label", "group", "title")


@query(
    "record_edges",
    _MIXED + "SELECT sl || ':' || sk AS source, dl || ':' || dk AS target, rel AS label FROM drawn",
)
def edges_of_records(spark, folder):
    return draw_records(_mixed(spark, folder))[1].select("source", "target", "label")


@query(
    "record_texts",
    _MIXED
    + """SELECT game AS id, 'number' AS name, game AS text FROM pairs
UNION ALL SELECT p.game, 'company', '{"name":"' || n.name || '"}' FROM pairs p JOIN nodes n ON n.label = 'Company' AND n.key = p.company
UNION ALL SELECT key, 'name', name FROM nodes WHERE label = 'Game' AND contains(name, 'red')
UNION ALL SELECT key, 'parts', '["' || replace(name, ' ', '","') || '"]' FROM nodes WHERE label = 'Game' AND contains(name, 'red')""",
)
def texts_of_records(spark, folder):
    texts = flat_values(record_values(_mixed(spark, folder)))
    return texts.filter(F.col("name").isin("number", "company", "name", "parts")).select("id", "name", "text")
