"""Queries of the graph page."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import display_label, fixed, strip_backticks, tag_label, tooltip
from ...operators.aggregates import property_catalogue, schema_summary
from ...operators.graph import match_nodes, match_pattern, whole_props
from ...operators.ranking import colour_index
from ...operators.views import flatten_records, path_edges, path_nodes, schema_graph, tiles
from ...sources import read_table
from .. import adapters
from ..questions import answer_graph, ask, catalogue_text, schema_text
from .base import LABEL_NODES, TRADE_EDGES, query

_COLOURS = "['" + "', '".join(fixed.PALETTE) + "']"


@query(
    "schema_summary",
    f'WITH {TRADE_EDGES} SELECT DISTINCT src_label AS "from", rel_type, dst_label AS "to" FROM edges',
)
def summary(spark, folder):
    return schema_summary(adapters.trade_graph(spark, folder)[1])


@query(
    "schema_lines",
    f"""WITH {TRADE_EDGES}
SELECT DISTINCT src_label || ' -[:' || rel_type || ']-> ' || dst_label AS line FROM edges""",
)
def lines(spark, folder):
    return schema_text(adapters.trade_graph(spark, folder)[1])


_PROPERTIES = f"""
WITH {LABEL_NODES},
props AS (
  SELECT DISTINCT label, CASE label WHEN 'Country' THEN 'title' ELSE 'name' END AS property FROM nodes WHERE name IS NOT NULL
  UNION SELECT 'Game', 'box_art_url' FROM part
  UNION SELECT label, CASE label WHEN 'Game' THEN 'catalog_id' WHEN 'Country' THEN 'code' ELSE 'id' END FROM nodes)
"""


@query(
    "property_catalogue",
    _PROPERTIES + "SELECT label, string_agg(property, ',' ORDER BY property) AS properties FROM props GROUP BY 1",
)
def catalogue(spark, folder):
    found = property_catalogue(adapters.trade_graph(spark, folder)[0])
    return found.select("label", F.array_join("properties", ",").alias("properties"))


@query(
    "property_lines",
    _PROPERTIES
    + "SELECT label || ': ' || string_agg(property, ', ' ORDER BY property) AS line FROM props GROUP BY label",
)
def property_lines(spark, folder):
    return catalogue_text(adapters.trade_graph(spark, folder)[0])


@query("match_exact", "SELECT CAST(p_partkey AS VARCHAR) AS key FROM part WHERE p_name = 'red widget'")
def match_exact(spark, folder):
    nodes, _ = adapters.trade_graph(spark, folder)
    return match_nodes(nodes, fixed.GAME, "name", "red widget").select("key")


@query("match_by_key", "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name FROM supplier WHERE s_suppkey = 7")
def match_by_key(spark, folder):
    """A node by the property that is its key."""
    nodes, _ = adapters.trade_graph(spark, folder)
    return match_nodes(nodes, fixed.COMPANY, "id", "7").select("key", F.col("props")["name"].alias("name"))


@query("match_contains", "SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name FROM part WHERE contains(p_name, 'ring')")
def match_contains(spark, folder):
    nodes, _ = adapters.trade_graph(spark, folder)
    found = match_nodes(nodes, fixed.GAME, "name", "ring", "contains")
    return found.select("key", F.col("props")["name"].alias("name"))


@query(
    "match_pattern",
    f"""WITH {LABEL_NODES}, {TRADE_EDGES}
SELECT src_key, dst_key, g.name AS game, c.name AS company
FROM edges JOIN nodes g ON g.label = src_label AND g.key = src_key JOIN nodes c ON c.label = dst_label AND c.key = dst_key
WHERE rel_type = 'INVOLVES_COMPANY'""",
)
def pattern(spark, folder):
    nodes, edges = adapters.trade_graph(spark, folder)
    hops = match_pattern(nodes, edges, fixed.INVOLVES_COMPANY, nodes, fixed.GAME, fixed.COMPANY)
    return hops.select(
        "src_key", "dst_key", F.col("src_props")["name"].alias("game"), F.col("dst_props")["name"].alias("company")
    )


_ANSWER = f"""
WITH {LABEL_NODES}, {TRADE_EDGES},
hops AS (
  SELECT e.* FROM edges e JOIN nodes g ON g.label = src_label AND g.key = src_key AND contains(g.name, 'red')
  WHERE rel_type = 'INVOLVES_COMPANY'),
found AS (
  SELECT src_label AS label, src_key AS key FROM hops UNION SELECT dst_label, dst_key FROM hops)
"""


def _answer(spark, folder):
    nodes, edges = adapters.trade_graph(spark, folder)
    return answer_graph(ask(nodes, edges, fixed.GAME, fixed.INVOLVES_COMPANY, fixed.COMPANY, "name", "red"), nodes)


@query(
    "subgraph_nodes",
    _ANSWER
    + f"""SELECT label || ':' || key AS id, name AS label, label AS "group",
       CASE label WHEN 'Game' THEN 'box_art_url: https://art.example/{{width}}x{{height}}/' || key || '<br>catalog_id: ' || key
                  ELSE 'id: ' || key END || '<br>name: ' || name AS title,
       {_COLOURS}[CAST(dense_rank() OVER (ORDER BY label) AS INTEGER)] AS colour
FROM found JOIN nodes USING (label, key)""",
)
def answer_nodes(spark, folder):
    return _answer(spark, folder)[0]


@query(
    "subgraph_edges",
    _ANSWER
    + """SELECT src_label || ':' || src_key AS source, dst_label || ':' || dst_key AS target, rel_type AS label FROM hops""",
)
def answer_edges(spark, folder):
    return _answer(spark, folder)[1]


_PATHS = f"""
WITH {LABEL_NODES}, {TRADE_EDGES},
paths AS (
  SELECT a.src_label AS l1, a.src_key AS k1, a.rel_type AS r1, a.dst_label AS l2, a.dst_key AS k2,
         b.rel_type AS r2, b.dst_label AS l3, b.dst_key AS k3
  FROM edges a JOIN edges b ON b.src_label = a.dst_label AND b.src_key = a.dst_key)
"""


def _paths(spark, folder):
    """Game -> company -> country, as arrays of nodes and of edges."""
    _, edges = adapters.trade_graph(spark, folder)
    first = edges.filter(F.col("dst_label") == fixed.COMPANY).select(F.struct("*").alias("a"))
    second = edges.filter(F.col("src_label") == fixed.COMPANY).select(F.struct("*").alias("b"))
    empty = F.create_map().cast("map<string,string>")

    def node(label, key):
        return F.struct(label.alias("label"), key.alias("key"), empty.alias("props"))

    a, b = F.col("a"), F.col("b")
    return first.join(second, F.col("a.dst_key") == F.col("b.src_key")).select(
        F.array(
            node(a["src_label"], a["src_key"]), node(a["dst_label"], a["dst_key"]), node(b["dst_label"], b["dst_key"])
        ).alias("nodes"),
        F.array("a", "b").alias("edges"),
    )


@query(
    "path_nodes",
    _PATHS
    + """SELECT label, key, count(*) AS on_paths FROM (
           SELECT l1 AS label, k1 AS key FROM paths UNION ALL SELECT l2, k2 FROM paths UNION ALL SELECT l3, k3 FROM paths)
         GROUP BY 1, 2""",
)
def nodes_of_paths(spark, folder):
    return path_nodes(_paths(spark, folder)).groupBy("label", "key").agg(F.count(F.lit(1)).alias("on_paths"))


@query(
    "path_edges",
    _PATHS
    + """SELECT src_label, src_key, rel_type, dst_label, dst_key, count(*) AS on_paths FROM (
           SELECT l1 AS src_label, k1 AS src_key, r1 AS rel_type, l2 AS dst_label, k2 AS dst_key FROM paths
           UNION ALL SELECT l2, k2, r2, l3, k3 FROM paths) GROUP BY ALL""",
)
def edges_of_paths(spark, folder):
    found = path_edges(_paths(spark, folder))
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("on_paths"))


@query(
    "schema_graph",
    f"""WITH {TRADE_EDGES}, labels AS (SELECT src_label AS label FROM edges UNION SELECT dst_label FROM edges)
SELECT label, {_COLOURS}[CAST((row_number() OVER (ORDER BY label) - 1) % 10 + 1 AS INTEGER)] AS colour FROM labels""",
)
def schema_nodes(spark, folder):
    return schema_graph(adapters.trade_graph(spark, folder)[1])[0]


@query(
    "colour_index",
    f"""SELECT label, {_COLOURS}[CAST((row_number() OVER (ORDER BY label) - 1) % 10 + 1 AS INTEGER)] AS colour
        FROM (SELECT DISTINCT source AS label FROM documents)""",
)
def colours(spark, folder):
    return colour_index(read_table(spark, folder, "documents").withColumnRenamed("source", "label"), "label")


def _records(spark, folder):
    """Result rows: a game as JSON text, its event payload, and a number."""
    blob = F.to_json(F.struct(F.col("name"), F.col("box_art_url"), F.col("price")))
    games = adapters.games(spark, folder).select(F.col("key"), blob.alias("game"), F.col("size").alias("n"))
    events = read_table(spark, folder, "events").select(F.col("event_id").cast("string").alias("key"), "props")
    return games.join(events, "key", "left")


@query(
    "tiles",
    """SELECT DISTINCT p_name AS name, 'https://art.example/150x200/' || p_partkey AS thumb FROM part""",
)
def game_tiles(spark, folder):
    records = _records(spark, folder)
    return tiles(records.withColumn("n", F.col("n").cast("string")))


@query(
    "flatten_records",
    """SELECT CAST(p_partkey AS VARCHAR) AS key, CAST(p_size AS VARCHAR) AS n,
              '{"name":"' || p_name || '","box_art_url":"https://art.example/{width}x{height}/' || p_partkey || '"}' AS game,
              '["' || p_type || '"]' AS genres
       FROM part""",
)
def flat(spark, folder):
    game = F.create_map(F.lit("name"), F.col("name"), F.lit("box_art_url"), F.col("box_art_url"))
    records = adapters.games(spark, folder).select(
        "key", F.col("size").alias("n"), game.alias("game"), F.array("genre").alias("genres")
    )
    return flatten_records(records)


@query(
    "display_labels",
    f"""WITH {LABEL_NODES}
SELECT label AS node_label, key, coalesce(nullif(name, ''), key) AS shown,
       CASE label WHEN 'Game' THEN 'box_art_url: https://art.example/{{width}}x{{height}}/' || key || '<br>catalog_id: ' || key || '<br>name: ' || name
         WHEN 'Company' THEN 'id: ' || key || '<br>name: ' || name WHEN 'Country' THEN 'code: ' || key || '<br>title: ' || name
         ELSE 'id: ' || key END AS title
FROM nodes""",
)
def shown(spark, folder):
    nodes, _ = adapters.trade_graph(spark, folder)
    return nodes.select("label", "key", whole_props()).select(
        F.col("label").alias("node_label"),
        "key",
        display_label(F.col("props"), F.col("label")).alias("shown"),
        tooltip(F.col("props")).alias("title"),
    )


@query(
    "tag_labels",
    """SELECT event_id, upper(substring(event_type, 1, 1)) || substring(event_type, 2) AS label FROM events""",
)
def tags(spark, folder):
    """Event types as entity tags, with a quoted label on the way."""
    events = read_table(spark, folder, "events")
    tag = F.concat(F.when(F.col("event_id") % 2 == 0, "B-").otherwise("I-"), F.upper("event_type"))
    quoted = F.concat(F.lit("`"), tag_label(tag), F.lit("`"))
    return events.select("event_id", strip_backticks(quoted).alias("label"))
