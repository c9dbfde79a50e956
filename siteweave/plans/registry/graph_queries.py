"""Queries that build and change the graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import as_key, fixed
from ...operators import links as L
from ...operators.aggregates import averages_of, latest
from ...operators.graph import (
    as_edges,
    as_nodes,
    create_nodes,
    detached,
    drop_orphans,
    match_set,
    merge_edges,
    merge_nodes,
    replace_edges,
)
from ...session import new_table_path, stored
from ...sources import lookup_by_ids, read_graph, read_payload, read_table, write_graph
from .. import adapters, games
from .base import DOCS, LABEL_NODES, LATEST_LINE, TRADE_EDGES, TYPES, query

def _landed():
    """Documents in landing order, latest first."""
    return [latest("l_shipdate"), *adapters.LINE_ID]




def _documents(spark, folder, schema=L.DOCUMENT_SCHEMA):
    return read_payload(adapters.game_documents(spark, folder), "payload", schema)


# --- nodes -------------------------------------------------------------------


def _suppliers(spark, folder):
    return read_table(spark, folder, "supplier").select(
        as_key(F.col("s_suppkey")).alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("rating"),
        F.lit("supplier").alias("description"),
    )


def _customer_updates(spark, folder):
    """Incoming rows keyed like suppliers; several orders per key, no description for open ones."""
    return read_table(spark, folder, "orders").select(
        as_key(F.col("o_custkey")).alias("key"),
        F.col("o_totalprice").alias("rating"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("description"),
        "o_orderdate",
        "o_orderkey",
    )


_LAST_ORDERS = """
last_orders AS (
  SELECT CAST(o_custkey AS VARCHAR) AS key, o_totalprice AS rating,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS description
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


@query(
    "merge_nodes",
    f"""WITH {_LAST_ORDERS}
SELECT coalesce(CAST(s_suppkey AS VARCHAR), l.key) AS key, s_name AS name,
       CASE WHEN l.key IS NOT NULL THEN l.rating ELSE s_acctbal END AS rating,
       CASE WHEN l.key IS NOT NULL THEN l.description ELSE 'supplier' END AS description
FROM supplier FULL JOIN last_orders l ON l.key = CAST(s_suppkey AS VARCHAR)""",
)
def merge_company_nodes(spark, folder):
    return merge_nodes(
        _suppliers(spark, folder),
        _customer_updates(spark, folder),
        ["key"],
        ["rating", "description"],
        [latest("o_orderdate"), latest("o_orderkey")],
    )


@query(
    "match_set",
    f"""WITH {_LAST_ORDERS}
SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name, s_acctbal AS rating,
       CASE WHEN l.key IS NOT NULL THEN l.description ELSE 'supplier' END AS description
FROM supplier LEFT JOIN last_orders l ON l.key = CAST(s_suppkey AS VARCHAR)""",
)
def match_set_companies(spark, folder):
    return match_set(
        _suppliers(spark, folder),
        _customer_updates(spark, folder),
        ["key"],
        ["description"],
        [latest("o_orderdate"), latest("o_orderkey")],
    )


@query(
    "create_nodes",
    """SELECT 'Company' AS label, CAST(s_suppkey AS VARCHAR) AS key, s_name AS name FROM supplier
       UNION ALL SELECT 'Summary', CAST(doc_id AS VARCHAR), source FROM documents""",
)
def create_summary_nodes(spark, folder):
    companies = as_nodes(read_table(spark, folder, "supplier").withColumnRenamed("s_name", "name"), fixed.COMPANY, "s_suppkey", ["name"])
    docs = read_table(spark, folder, "documents").select("doc_id", F.col("source").alias("name"))
    nodes = create_nodes(companies, as_nodes(docs, fixed.SUMMARY, "doc_id", ["name"]))
    return nodes.select("label", "key", F.col("props")["name"].alias("name"))


@query(
    "catalogue_properties",
    f"""WITH {DOCS}
SELECT CAST(p_partkey AS VARCHAR) AS key, l_extendedprice AS total_rating,
       strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(coalesce(released, 0)), '%Y-%m-%dT%H:%M:%S') AS first_release_date,
       CASE WHEN d.id IS NOT NULL THEN 'Sold on ' || l_linestatus || ' with flag ' || l_returnflag END AS summary,
       CASE WHEN d.id IS NOT NULL THEN 'https://games.example/' || id END AS url,
       CAST(l_orderkey AS VARCHAR) AS payload_similar
FROM part LEFT JOIN (
  SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY id ORDER BY {LATEST_LINE}) = 1) d ON id = p_partkey""",
)
def catalogue_properties(spark, folder):
    """Properties of all catalogue ids after one pass over the documents."""
    nodes = adapters.catalogue_nodes(spark, folder)
    landed = adapters.game_documents(spark, folder)
    after = games.ingest_documents((nodes, _no_edges(nodes)), landed, _landed(), "l_shipdate").nodes
    prop = lambda name: F.try_element_at("props", F.lit(name))
    return after.filter(F.col("label") == fixed.CATALOG_ID).select(
        "key",
        prop("total_rating").cast("double").alias("total_rating"),
        prop("first_release_date").alias("first_release_date"),
        prop("summary").alias("summary"),
        prop("url").alias("url"),
        F.get_json_object(prop("payload"), "$.similar_games[0].id").alias("payload_similar"),
    )


def _no_edges(nodes):
    """No edges yet."""
    return as_edges(nodes.limit(0), "", "key", "", "", "key")


# --- edges of documents ------------------------------------------------------

_EDGE = "src_label, CAST(id AS VARCHAR) AS src_key, '{rel}' AS rel_type, '{label}' AS dst_label, CAST({key} AS VARCHAR) AS dst_key"


def _document_sql(rel, label, key, rows="docs", guard="true"):
    return f"""WITH {DOCS}
SELECT DISTINCT {_EDGE.format(rel=rel, label=label, key=key)}
FROM {rows}, (VALUES ('Catalog_ID'), ('Game')) AS v(src_label) WHERE {guard}"""


def _document_edges(spark, folder, rule, fields):
    docs = _documents(spark, folder, f"id long, {fields}")
    ids, owners = adapters.catalogue_nodes(spark, folder), adapters.game_nodes(spark, folder)
    return L.document_edges(docs, ids, owners, [rule])


@query(
    "edge_released_in",
    _document_sql("RELEASED_IN", "Release_Year", "year(l_shipdate)", guard="released <> 0"),
)
def edge_released_in(spark, folder):
    return _document_edges(spark, folder, L.released_in, "first_release_date long")


@query(
    "edge_franchise",
    _document_sql("PART_OF_FRANCHISE", "Franchise", "franchise", guard="franchise <> 0"),
)
def edge_franchise(spark, folder):
    return _document_edges(spark, folder, L.part_of_franchise, "franchise long")


@query("edge_has_type", _document_sql("HAS_TYPE", "GameType", "game_type", guard="game_type <= 14"))
def edge_has_type(spark, folder):
    return _document_edges(spark, folder, L.has_type, "game_type int")


@query(
    "edge_genre",
    _document_sql(
        "HAS_GENRE",
        "Genre",
        "genre_id",
        rows="(SELECT id, unnest([l_linenumber, 100 + l_suppkey % 10]) AS genre_id FROM docs)",
    ),
)
def edge_genre(spark, folder):
    return _document_edges(spark, folder, L.has_genre, "genres array<struct<id: long, name: string>>")


@query("edge_company", _document_sql("INVOLVES_COMPANY", "Company", "l_suppkey"))
def edge_company(spark, folder):
    return _document_edges(
        spark,
        folder,
        L.involves_company,
        "involved_companies array<struct<id: long, company: struct<id: long, name: string>>>",
    )


_ALL_LINKS = f"""WITH {DOCS},
links AS (
  SELECT id, 'RELEASED_IN' AS rel_type, 'Release_Year' AS dst_label, CAST(year(l_shipdate) AS VARCHAR) AS dst_key
  FROM docs WHERE released <> 0
  UNION SELECT id, 'PART_OF_FRANCHISE', 'Franchise', CAST(franchise AS VARCHAR) FROM docs WHERE franchise <> 0
  UNION SELECT id, 'HAS_TYPE', 'GameType', CAST(game_type AS VARCHAR) FROM docs WHERE game_type <= 14
  UNION SELECT id, 'HAS_GENRE', 'Genre', CAST(unnest([l_linenumber, 100 + l_suppkey % 10]) AS VARCHAR) FROM docs
  UNION SELECT id, 'INVOLVES_COMPANY', 'Company', CAST(l_suppkey AS VARCHAR) FROM docs),
all_edges AS (
  SELECT src_label, CAST(id AS VARCHAR) AS src_key, rel_type, dst_label, dst_key
  FROM links, (VALUES ('Catalog_ID'), ('Game')) AS v(src_label)
  UNION SELECT 'Game', CAST(id AS VARCHAR), 'SIMILAR_TO', 'Game', CAST(p_partkey AS VARCHAR)
  FROM docs JOIN part ON p_partkey = l_orderkey)
"""


def _ingested(spark, folder):
    nodes = adapters.catalogue_nodes(spark, folder).unionByName(adapters.game_nodes(spark, folder))
    landed = adapters.game_documents(spark, folder)
    return games.ingest_documents((nodes, _no_edges(nodes)), landed, _landed(), "l_shipdate")[:2]


@query("document_edges", _ALL_LINKS + "SELECT * FROM all_edges")
def document_edges(spark, folder):
    """All edges of the landed documents from one parse."""
    return _ingested(spark, folder)[1]


@query(
    "document_nodes",
    _ALL_LINKS
    + f""", {TYPES}
SELECT DISTINCT dst_label AS label, dst_key AS key,
       CASE dst_label WHEN 'GameType' THEN type_name WHEN 'Genre' THEN 'Genre ' || dst_key
         WHEN 'Company' THEN 'Supplier#' || lpad(dst_key, 9, '0') END AS name
FROM links LEFT JOIN types ON dst_label = 'GameType' AND CAST(code AS VARCHAR) = dst_key
UNION ALL SELECT 'Catalog_ID', CAST(p_partkey AS VARCHAR), NULL FROM part
UNION ALL SELECT 'Game', CAST(p_partkey AS VARCHAR), p_name FROM part""",
)
def document_nodes(spark, folder):
    nodes, _ = _ingested(spark, folder)
    return nodes.select("label", "key", F.try_element_at("props", F.lit("name")).alias("name"))


@query(
    "edge_similar",
    """SELECT DISTINCT 'Game' AS src_label, CAST(l_partkey AS VARCHAR) AS src_key, 'SIMILAR_TO' AS rel_type,
              'Game' AS dst_label, CAST(l_orderkey AS VARCHAR) AS dst_key
       FROM lineitem JOIN part ON p_partkey = l_orderkey""",
)
def edge_similar(spark, folder):
    docs = _documents(spark, folder, "id long, similar_games array<struct<id: long>>")
    return L.similar_edges(L.document_links(docs, [L.similar_to]), adapters.game_nodes(spark, folder))


@query(
    "edge_similar_both_ways",
    """WITH pairs AS (SELECT CAST(l_partkey AS VARCHAR) AS a, CAST(l_orderkey AS VARCHAR) AS b
                      FROM lineitem JOIN part ON p_partkey = l_orderkey)
       SELECT 'Game' AS src_label, a AS src_key, 'SIMILAR_TO' AS rel_type, 'Game' AS dst_label, b AS dst_key
       FROM (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs)""",
)
def edge_similar_both_ways(spark, folder):
    docs = _documents(spark, folder, "id long, similar_games array<struct<id: long>>")
    return L.similar_edges(L.document_links(docs, [L.similar_to]), adapters.game_nodes(spark, folder), bidirectional=True)


@query(
    "edge_similar_by_name",
    """SELECT DISTINCT 'Catalog_ID' AS src_label, CAST(l_partkey AS VARCHAR) AS src_key, 'SIMILAR_TO' AS rel_type,
              'Game' AS dst_label, c_name AS dst_key
       FROM lineitem JOIN customer ON c_name = 'Customer#' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0')""",
)
def edge_similar_by_name(spark, folder):
    """Games keyed by name; customers are the games."""
    docs = read_payload(adapters.similar_documents(spark, folder), "payload", L.SIMILAR_SCHEMA)
    named = as_nodes(read_table(spark, folder, "customer"), fixed.GAME, "c_name")
    return L.similar_by_name(docs, adapters.catalogue_nodes(spark, folder).unionByName(named))


# --- edges of games, streams, companies --------------------------------------

_SIMILAR_GAMES = """
WITH similar_games AS (
  SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
         max(CASE WHEN l_linenumber % 2 = 1 THEN 'https://art.example/{width}x{height}/' || l_orderkey ELSE '' END) AS art
  FROM lineitem JOIN customer ON c_custkey = l_orderkey GROUP BY 1, 2)
"""


def _similar_games(spark, folder):
    docs = read_payload(adapters.similar_documents(spark, folder), "payload", L.SIMILAR_SCHEMA)
    catalogue = read_table(spark, folder, "customer").select(F.col("c_name").alias("name"))
    return games.similar_games(docs, catalogue, ["name"])


@query("similar_games", _SIMILAR_GAMES + "SELECT key, name, art AS box_art_url FROM similar_games")
def similar_games(spark, folder):
    return _similar_games(spark, folder)


@query(
    "edge_has_id",
    _SIMILAR_GAMES
    + """SELECT 'Game' AS src_label, key AS src_key, 'HAS_CATALOG_ID' AS rel_type, 'Catalog_ID' AS dst_label,
                key AS dst_key FROM similar_games""",
)
def edge_has_id(spark, folder):
    return games.catalogue_edges(_similar_games(spark, folder))


_BEST_STREAMS = """
WITH best AS (
  SELECT p_name, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS stream_id
  FROM lineitem JOIN part ON p_partkey = l_partkey
  QUALIFY row_number() OVER (PARTITION BY p_name
    ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 3)
"""


def _named_streams(spark, folder):
    names = adapters.games(spark, folder).select(F.col("key").alias("game_key"), "name")
    return adapters.streams(spark, folder).join(names, "game_key")


@query(
    "edge_has_stream",
    _BEST_STREAMS
    + """SELECT 'Game' AS src_label, CAST(p_partkey AS VARCHAR) AS src_key, 'HAS_STREAM' AS rel_type,
                'Stream' AS dst_label, stream_id AS dst_key FROM best JOIN part USING (p_name)""",
)
def edge_has_stream(spark, folder):
    """The first streams per game name, attached to every game of the name."""
    _, edges, _ = games.stream_graph(
        adapters.games(spark, folder),
        _named_streams(spark, folder),
        fixed.STREAMS_PER_SIMILAR_GAME,
        [latest("viewer_count"), *adapters.LINE_ID],
    )
    return edges


@query(
    "merge_by_name",
    """SELECT DISTINCT 'Game' AS label, c_name AS key, c_name AS name
       FROM lineitem JOIN customer ON c_custkey = l_partkey WHERE c_name NOT IN (SELECT s_name FROM supplier)""",
)
def merge_by_name(spark, folder):
    """Games that have to be made because no game has the stream's game name."""
    named = read_table(spark, folder, "customer").select(as_key(F.col("c_custkey")).alias("game_key"), F.col("c_name").alias("name"))
    streams = adapters.streams(spark, folder).join(named, "game_key")
    known = read_table(spark, folder, "supplier").select(as_key(F.col("s_suppkey")).alias("key"), F.col("s_name").alias("name"))
    _, created = L.attach_by_name(known, streams, "name", "stream_id", fixed.HAS_STREAM, fixed.STREAM)
    return created.select("label", "key", F.col("props")["name"].alias("name"))


def _averages(spark, folder):
    streams = adapters.streams(spark, folder).select(
        F.col("stream_id").alias("key"), "game_key", "viewer_count"
    )
    edges = as_edges(streams, fixed.GAME, "game_key", fixed.HAS_STREAM, fixed.STREAM, "key")
    return games.average_views(adapters.games(spark, folder), edges, streams)


@query(
    "avg_viewers",
    """SELECT p_name AS name, round(avg(l_quantity), 4) AS average
       FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""",
)
def avg_viewers(spark, folder):
    return _averages(spark, folder).select("name", F.round("average", 4).alias("average"))


@query(
    "grown_averages",
    "SELECT p_name AS name, round(avg(l_quantity), 4) AS average FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1",
)
def grown_averages(spark, folder):
    """Averages from a state that two runs have added their own streams to."""
    owners = adapters.games(spark, folder)
    streams = adapters.streams(spark, folder).withColumn("key", F.col("stream_id"))
    state = None
    for run in (F.col("l_linenumber") < 4, F.col("l_linenumber") >= 4):
        new = streams.filter(run)
        edges = as_edges(new, fixed.GAME, "game_key", fixed.HAS_STREAM, fixed.STREAM, "stream_id")
        state = stored(games.grow_average_views(state, owners, edges, new), "averages")
    return averages_of(state, "name").withColumn("average", F.round("average", 4))


@query(
    "edge_avg_views",
    """WITH averages AS (
         SELECT p_name, CAST(CAST(round(avg(l_quantity), 4) AS DECIMAL(20, 4)) AS VARCHAR) AS value
         FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
       SELECT 'Game' AS src_label, CAST(p_partkey AS VARCHAR) AS src_key, 'HAS_AVERAGE_VIEW_COUNT' AS rel_type,
              'Average_View_Count' AS dst_label, value AS dst_key FROM averages JOIN part USING (p_name)""",
)
def edge_avg_views(spark, folder):
    key = F.round("average", 4).cast("decimal(20,4)").cast("string")
    return games.average_view_graph(adapters.games(spark, folder), _averages(spark, folder), key)[1]


def _company_documents(spark, folder):
    """Customers as company documents; those of nation 0 have neither url nor country."""
    nation = F.col("c_nationkey")
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("description"),
        F.when(nation == 0, "")
        .otherwise(F.concat(F.lit("https://"), F.lower("c_mktsegment"), F.lit(".example/"), (F.col("c_custkey") % 500).cast("string")))
        .alias("url"),
        nation.alias("country"),
    )


_COMPANY_DOCS = """
WITH company_docs AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS description, CAST(c_nationkey AS VARCHAR) AS country,
         CASE WHEN c_nationkey <> 0 THEN 'https://' || lower(c_mktsegment) || '.example/' || (c_custkey % 500) END AS url
  FROM customer),
known AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name FROM supplier)
"""


def _company_graph(spark, folder):
    nodes = as_nodes(
        read_table(spark, folder, "supplier").withColumnRenamed("s_name", "name"), fixed.COMPANY, "s_suppkey", ["name"]
    )
    graph = (nodes, _no_edges(nodes))
    return games.ingest_companies(graph, _company_documents(spark, folder), ["id"], countries=True)


@query(
    "edge_website",
    _COMPANY_DOCS
    + """SELECT 'Company' AS src_label, id AS src_key, 'HAS_WEBSITE' AS rel_type, 'Website' AS dst_label, url AS dst_key
         FROM company_docs WHERE url IS NOT NULL AND id IN (SELECT id FROM known)""",
)
def edge_website(spark, folder):
    return _company_graph(spark, folder)[1].filter(F.col("rel_type") == fixed.HAS_WEBSITE)


@query(
    "edge_country",
    _COMPANY_DOCS
    + """SELECT 'Company' AS src_label, id AS src_key, 'LOCATED_IN' AS rel_type, 'Country' AS dst_label,
                country AS dst_key FROM company_docs WHERE country <> '0' AND id IN (SELECT id FROM known)""",
)
def edge_country(spark, folder):
    return _company_graph(spark, folder)[1].filter(F.col("rel_type") == fixed.LOCATED_IN)


@query(
    "company_nodes",
    _COMPANY_DOCS
    + """SELECT 'Company' AS label, id AS key, s_name AS name, description FROM known LEFT JOIN company_docs USING (id)
         UNION ALL SELECT DISTINCT 'Website', url, NULL, NULL FROM company_docs WHERE url IS NOT NULL
         UNION ALL SELECT DISTINCT 'Country', country, NULL, NULL FROM company_docs WHERE country <> '0'""",
)
def company_nodes(spark, folder):
    """Websites and countries are made even for companies that are not in the graph."""
    nodes, _ = _company_graph(spark, folder)
    prop = lambda name: F.try_element_at("props", F.lit(name)).alias(name)
    return nodes.select("label", "key", prop("name"), prop("description"))


# --- whole passes ------------------------------------------------------------


@query(
    "top_games_pass",
    """WITH top AS (
         SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY sum(l_quantity) DESC, l_partkey LIMIT 10),
       names AS (SELECT DISTINCT p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM top)),
       best AS (
         SELECT p_name, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS stream_id
         FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_name IN (SELECT p_name FROM names)
         QUALIFY row_number() OVER (PARTITION BY p_name
           ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 5)
       SELECT 'Game' AS src_label, CAST(l_partkey AS VARCHAR) AS src_key, 'HAS_CATALOG_ID' AS rel_type,
              'Catalog_ID' AS dst_label, CAST(l_partkey AS VARCHAR) AS dst_key FROM top
       UNION ALL SELECT 'Game', CAST(p_partkey AS VARCHAR), 'HAS_STREAM', 'Stream', stream_id
       FROM best JOIN part USING (p_name)""",
)
def top_games_pass(spark, folder):
    """Edges after taking in the ten most viewed games and the first streams of their names."""
    streams = _named_streams(spark, folder)
    viewers = streams.groupBy(F.col("game_key").alias("key"), "l_partkey").agg(F.sum("viewer_count").alias("viewers"))
    parts = adapters.games(spark, folder).select("key", "name", "box_art_url")
    nodes = adapters.game_nodes(spark, folder)
    _, edges = games.ingest_top_games(
        (nodes, _no_edges(nodes)),
        viewers.join(parts, "key"),
        streams,
        [latest("viewers"), "l_partkey"],
        [latest("viewer_count"), *adapters.LINE_ID],
    )
    return edges


@query(
    "top_games_by_name",
    """WITH top AS (
         SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY sum(l_quantity) DESC, l_partkey LIMIT 10),
       named AS (SELECT l_partkey, p_name FROM top JOIN part ON p_partkey = l_partkey),
       best AS (
         SELECT p_name, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS stream_id
         FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_name IN (SELECT p_name FROM named)
         QUALIFY row_number() OVER (PARTITION BY p_name
           ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 5)
       SELECT 'Game' AS src_label, p_name AS src_key, 'HAS_CATALOG_ID' AS rel_type, 'Catalog_ID' AS dst_label,
              CAST(l_partkey AS VARCHAR) AS dst_key FROM named
       UNION ALL SELECT 'Game', p_name, 'HAS_STREAM', 'Stream', stream_id FROM best""",
)
def top_games_by_name(spark, folder):
    """The same pass over a graph whose games are keyed by name."""
    streams = _named_streams(spark, folder)
    viewers = streams.groupBy(F.col("game_key").alias("key"), "l_partkey").agg(F.sum("viewer_count").alias("viewers"))
    parts = adapters.games(spark, folder)
    nodes = as_nodes(parts.select("name").distinct(), fixed.GAME, "name", ["name"])
    return games.ingest_top_games_by_name(
        (nodes, _no_edges(nodes)),
        viewers.join(parts.select("key", "name", "box_art_url"), "key"),
        streams,
        [latest("viewers"), "l_partkey"],
        [latest("viewer_count"), *adapters.LINE_ID],
    )[1]


@query(
    "entity_pass",
    """SELECT 'Company' AS label, source AS key, source AS name, CASE WHEN source IN (SELECT DISTINCT source FROM documents WHERE doc_id < 3) THEN 'kept' END AS note
       FROM (SELECT DISTINCT source FROM documents)
       UNION ALL SELECT DISTINCT 'Product', lang, lang, NULL FROM documents
       UNION ALL SELECT DISTINCT 'Loc', source || '/' || lang, source || '/' || lang, NULL FROM documents""",
)
def entity_pass(spark, folder):
    """Nodes after a pass over tagged names; a few companies were there with a note."""
    docs = read_table(spark, folder, "documents")
    known = docs.filter("doc_id < 3").select("source", F.lit("kept").alias("note")).distinct()
    nodes = as_nodes(known, fixed.COMPANY, "source", ["note"])
    after, _ = games.ingest_entities((nodes, _no_edges(nodes)), adapters.tokens(spark, folder))
    return after.select("label", "key", F.try_element_at("props", F.lit("name")).alias("name"), F.try_element_at("props", F.lit("note")).alias("note"))


@query(
    "company_search_pass",
    """WITH titled AS (
         SELECT c_custkey, 'The ' || s_name || ' trading company' AS title, lower(c_mktsegment) AS segment
         FROM customer JOIN supplier ON s_suppkey = c_custkey % 40),
       hits AS (
         SELECT s_name, min(c_custkey) AS id FROM supplier JOIN titled ON contains(title, s_name) GROUP BY 1)
       SELECT CAST(id AS VARCHAR) AS src_key, 'https://' || segment || '.example/' || id AS dst_key
       FROM hits JOIN titled ON c_custkey = id WHERE id IN (SELECT s_suppkey FROM supplier)""",
)
def company_search_pass(spark, folder):
    """Websites of the companies found by name; the document found describes the company of its own id."""
    suppliers = read_table(spark, folder, "supplier")
    nodes = as_nodes(suppliers.withColumnRenamed("s_name", "name"), fixed.COMPANY, "s_suppkey", ["name"])
    named = suppliers.select(F.col("s_suppkey").alias("at"), "s_name")
    customers = read_table(spark, folder, "customer").withColumn("at", F.col("c_custkey") % 40)
    docs = customers.join(named, "at").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("The "), "s_name", F.lit(" trading company")).alias("name"),
        F.col("c_mktsegment").alias("description"),
        F.concat(F.lit("https://"), F.lower("c_mktsegment"), F.lit(".example/"), F.col("c_custkey").cast("string")).alias("url"),
        F.lit(0).alias("country"),
    )
    edges = games.ingest_searched_companies((nodes, _no_edges(nodes)), docs, ["id"])[1]
    return edges.filter(F.col("rel_type") == fixed.HAS_WEBSITE).select("src_key", "dst_key")


def _customer_streams(spark, folder):
    named = read_table(spark, folder, "customer").select(
        as_key(F.col("c_custkey")).alias("game_key"), F.col("c_name").alias("name")
    )
    return adapters.streams(spark, folder).join(named, "game_key")


@query(
    "similar_games_pass",
    _SIMILAR_GAMES
    + """, best AS (
           SELECT c_name AS name, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS stream_id,
                  l_quantity AS viewers
           FROM lineitem JOIN customer ON c_custkey = l_partkey WHERE c_name IN (SELECT name FROM similar_games)
           QUALIFY row_number() OVER (PARTITION BY c_name
             ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) <= 3)
         SELECT 'Game' AS label, key, name, CAST(NULL AS DOUBLE) AS viewers FROM similar_games
         UNION ALL SELECT 'Stream', stream_id, NULL, viewers FROM best
         UNION ALL SELECT DISTINCT 'Catalog_ID', key, NULL, NULL FROM (
           SELECT CAST(p_partkey AS VARCHAR) AS key FROM part UNION SELECT key FROM similar_games)""",
)
def similar_games_pass(spark, folder):
    """Nodes after taking in the similar games of all documents, with their first streams."""
    docs = read_payload(adapters.similar_documents(spark, folder), "payload", L.SIMILAR_SCHEMA)
    catalogue = read_table(spark, folder, "customer").select(F.col("c_name").alias("name"))
    ids = adapters.catalogue_nodes(spark, folder)
    nodes, _ = games.ingest_similar_games(
        (ids, _no_edges(ids)),
        docs,
        catalogue,
        _customer_streams(spark, folder),
        [latest("viewer_count"), *adapters.LINE_ID],
    )
    prop = lambda name: F.try_element_at("props", F.lit(name))
    return nodes.select("label", "key", prop("name").alias("name"), prop("viewer_count").cast("double").alias("viewers"))


def _average_sql(columns):
    runs = " UNION ".join(
        f"SELECT p_name, round(avg({column}), 4) AS value FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1"
        for column in columns
    )
    return f"""SELECT CAST(p_partkey AS VARCHAR) AS src_key, value FROM ({runs}) JOIN part USING (p_name)"""


def _average_runs(spark, folder, replace):
    """A run on the streams' viewers, then one on changed viewer counts."""
    lines = read_table(spark, folder, "lineitem")
    key = F.concat_ws("-", *adapters.LINE_ID)
    edges = as_edges(
        adapters.streams(spark, folder), fixed.GAME, "game_key", fixed.HAS_STREAM, fixed.STREAM, "stream_id"
    )
    for column in ("l_quantity", "l_linenumber"):
        viewed = lines.withColumn("viewer_count", F.col(column).cast("double"))
        nodes = adapters.game_nodes(spark, folder).unionByName(as_nodes(viewed, fixed.STREAM, key, ["viewer_count"]))
        _, edges = games.ingest_average_views((nodes, edges), replace)
    found = edges.filter(F.col("rel_type") == fixed.HAS_AVERAGE_VIEW_COUNT)
    return found.select("src_key", F.round(F.col("dst_key").cast("double"), 4).alias("value"))


@query("average_views_rerun", _average_sql(["l_quantity", "l_linenumber"]))
def average_views_rerun(spark, folder):
    """Merged averages: those of the first run stay."""
    return _average_runs(spark, folder, replace=False)


@query("average_views_replaced", _average_sql(["l_linenumber"]))
def average_views_replaced(spark, folder):
    return _average_runs(spark, folder, replace=True)


@query(
    "company_summary_pass",
    """WITH told AS (
         SELECT s_suppkey, 'Give me a 500 character summary about the ' || s_name || ' game company.' AS prompt FROM supplier)
       SELECT 'Company' AS src_label, CAST(s_suppkey AS VARCHAR) AS src_key, 'HAS_SUMMARY' AS rel_type,
              'AI_Company_Summary' AS dst_label,
              length(prompt) || ' characters, ' || len(string_split(prompt, ' ')) || ' words' AS dst_key
       FROM told""",
)
def company_summary_pass(spark, folder):
    """Edges after giving every company the summary the text function makes of its prompt."""
    nodes = as_nodes(
        read_table(spark, folder, "supplier").withColumnRenamed("s_name", "name"), fixed.COMPANY, "s_suppkey", ["name"]
    )
    _, edges = games.ingest_company_summaries((nodes, _no_edges(nodes)), games.company_summaries(nodes))
    return edges


# --- summaries ---------------------------------------------------------------

_SUMMARIES = """
WITH old AS (
  SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment || ' ' || c_nationkey || ' ' || CAST(floor(c_acctbal / 500) AS BIGINT) AS summary
  FROM customer),
new AS (SELECT CAST(s_suppkey AS VARCHAR) AS key, 'Nation ' || s_nationkey AS summary FROM supplier),
after AS (
  SELECT * FROM old WHERE key NOT IN (SELECT key FROM new)
  UNION ALL SELECT * FROM new)
"""


def _summary_edges(spark, folder):
    old = read_table(spark, folder, "customer").select(
        "c_custkey",
        F.concat_ws(" ", "c_mktsegment", "c_nationkey", F.floor(F.col("c_acctbal") / 500)).alias("summary"),
    )
    new = read_table(spark, folder, "supplier").select(
        "s_suppkey", F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("summary")
    )
    return (
        as_edges(old, fixed.COMPANY, "c_custkey", fixed.HAS_SUMMARY, fixed.COMPANY_SUMMARY, "summary"),
        as_edges(new, fixed.COMPANY, "s_suppkey", fixed.HAS_SUMMARY, fixed.COMPANY_SUMMARY, "summary"),
    )


@query(
    "replace_summaries",
    _SUMMARIES
    + """SELECT 'Company' AS src_label, key AS src_key, 'HAS_SUMMARY' AS rel_type, 'AI_Company_Summary' AS dst_label,
                summary AS dst_key FROM after""",
)
def replace_summaries(spark, folder):
    return replace_edges(*_summary_edges(spark, folder), fixed.HAS_SUMMARY)


@query(
    "drop_orphan_summaries",
    _SUMMARIES + "SELECT DISTINCT 'AI_Company_Summary' AS label, summary AS key FROM after",
)
def drop_orphan_summaries(spark, folder):
    """Summary nodes that are left once replaced summaries without an owner are gone."""
    old, new = _summary_edges(spark, folder)
    nodes = (
        old.unionByName(new).select(F.col("dst_label").alias("label"), F.col("dst_key").alias("key")).distinct()
    )
    rel = fixed.HAS_SUMMARY
    return drop_orphans(nodes, replace_edges(old, new, rel), detached(old, new, rel), rel, fixed.COMPANY_SUMMARY)


@query(
    "site_summary_history",
    """SELECT 'Website' AS src_label, url AS src_key, 'HAS_SUMMARY' AS rel_type, 'Summary' AS dst_label,
              page_id || '@' || stamp AS dst_key
       FROM pages, (VALUES ('2024-01-01T00:00:00'), ('2024-01-02T00:00:00')) AS v(stamp)""",
)
def site_summary_history(spark, folder):
    """Two runs over all pages leave two summaries per page."""
    pages = read_table(spark, folder, "pages")
    sites = as_nodes(pages.select("url").distinct(), fixed.WEBSITE, "url", ["url"])
    graph = (sites, _no_edges(sites))
    for stamp in ("2024-01-01T00:00:00", "2024-01-02T00:00:00"):
        graph = games.ingest_site_summaries(graph, games.site_summaries(pages, "describe", stamp))
    return graph[1]


# --- snapshots, re-runs ------------------------------------------------------


@query(
    "merge_rerun",
    f"""WITH {TRADE_EDGES} SELECT * FROM edges""",
)
def merge_rerun(spark, folder):
    """Merging the graph's own edges again adds nothing."""
    nodes, edges = adapters.trade_graph(spark, folder)
    return merge_edges(edges, edges, nodes, [fixed.INVOLVES_COMPANY, fixed.HAS_GENRE, fixed.LOCATED_IN])


@query(
    "graph_snapshot",
    f"""WITH {LABEL_NODES}, {TRADE_EDGES}
SELECT label AS kind, count(*) AS n, count(name) AS named FROM nodes GROUP BY 1
UNION ALL SELECT rel_type, count(*), 0 FROM edges GROUP BY 1""",
)
def graph_snapshot(spark, folder):
    """Write the graph, read it back, count."""
    path = write_graph(*adapters.trade_graph(spark, folder), new_table_path(spark, "graph"))
    nodes, edges = read_graph(spark, path)
    name = F.coalesce(F.try_element_at("props", F.lit("name")), F.try_element_at("props", F.lit("title")))
    return (
        nodes.groupBy(F.col("label").alias("kind"))
        .agg(F.count(F.lit(1)).alias("n"), F.count(name).alias("named"))
        .unionByName(
            edges.groupBy(F.col("rel_type").alias("kind")).agg(
                F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("named")
            )
        )
    )


@query(
    "document_rejects",
    """SELECT event_id, reason FROM (
         SELECT event_id, CASE event_type WHEN 'error' THEN 'no JSON object' WHEN 'click' THEN 'no k' WHEN 'view' THEN 'k is no bigint' END AS reason
         FROM events) WHERE reason IS NOT NULL""",
)
def document_rejects(spark, folder):
    """Events as documents: errors are cut off, clicks name another field, views hold text for a number."""
    props = F.col("props")
    payload = (
        F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)"))
        .when(F.col("event_type") == "click", F.replace(props, F.lit('"k"'), F.lit('"other"')))
        .when(F.col("event_type") == "view", F.regexp_replace(props, '("k": *)([0-9]+)', '$1"$2"'))
        .otherwise(props)
    )
    events = read_table(spark, folder, "events").select("event_id", payload.alias("payload"))
    return games.split_documents(events, "k")[1].select("event_id", "reason")


_SPOILT = """CASE l_linenumber % 7 WHEN 1 THEN 'id is no bigint' WHEN 2 THEN 'genres is no array' WHEN 3 THEN 'no id'
                  WHEN 4 THEN 'no JSON object' WHEN 5 THEN 'a nested value has another type' END"""


def _spoilt(spark, folder):
    """Landed documents of which most have a value of another type than declared."""
    payload, line = F.col("payload"), F.col("l_linenumber") % 7
    spoilt = (
        F.when(line == 1, F.regexp_replace(payload, '^[{]"id":([0-9]+)', '{"id":$1.5'))
        .when(line == 2, F.regexp_replace(payload, '"genres":.[{][^]]*.', '"genres":"none"'))
        .when(line == 3, F.regexp_replace(payload, '^[{]"id":[0-9]+', '{"id":null'))
        .when(line == 4, F.substr(payload, F.lit(2)))
        .when(line == 5, F.regexp_replace(payload, '"similar_games":.[{]"id":([0-9]+)', '"similar_games":[{"id":"$1"'))
        .otherwise(payload)
    )
    return adapters.game_documents(spark, folder).withColumn("payload", spoilt)


@query(
    "ingest_rejects",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, reason FROM (SELECT *, {_SPOILT} AS reason FROM lineitem) WHERE reason IS NOT NULL",
)
def ingest_rejects(spark, folder):
    """The rows that a pass over documents gives back."""
    nodes = adapters.catalogue_nodes(spark, folder)
    done = games.ingest_documents((nodes, _no_edges(nodes)), _spoilt(spark, folder), _landed(), "l_shipdate")
    return done.rejects.select(*adapters.LINE_ID, "reason")


@query(
    "edges_beside_rejects",
    f"""WITH {DOCS}
SELECT DISTINCT CAST(id AS VARCHAR) AS src_key, CAST(unnest([l_linenumber, 100 + l_suppkey % 10]) AS VARCHAR) AS dst_key
FROM docs WHERE {_SPOILT} IS NULL""",
)
def edges_beside_rejects(spark, folder):
    """What the documents that fit still link to."""
    nodes = adapters.catalogue_nodes(spark, folder)
    done = games.ingest_documents((nodes, _no_edges(nodes)), _spoilt(spark, folder), _landed(), "l_shipdate")
    return done.edges.filter(F.col("rel_type") == fixed.HAS_GENRE).select("src_key", "dst_key")


@query(
    "known_documents",
    """SELECT CAST(l_partkey AS VARCHAR) AS id, count(*) AS n_docs FROM lineitem
       WHERE l_partkey IN (SELECT o_custkey FROM orders) GROUP BY 1""",
)
def known_documents(spark, folder):
    """Documents of the ids the graph holds; here the ids of customers with orders."""
    docs = _documents(spark, folder, "id long").select(as_key(F.col("id")).alias("id"))
    ids = read_table(spark, folder, "orders").select(as_key(F.col("o_custkey")).alias("id"))
    return lookup_by_ids(docs, ids, "id").groupBy("id").agg(F.count(F.lit(1)).alias("n_docs"))
