"""The driver's test tables seen as the domain's tables.

Each adapter is a projection; the SQL in `registry` states the same mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.graph import as_edges, as_nodes
from ..sources.tables import read_table, spread

# Columns of a lineitem row that together are unique.
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ART = "https://art.example/{width}x{height}/"


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def supplier_name(key: Column) -> Column:
    return F.format_string("Supplier#%09d", key)


def customer_name(key: Column) -> Column:
    return F.format_string("Customer#%09d", key)


def host(url: Column) -> Column:
    return F.regexp_extract(url, "https?://([^/]+)", 1)


def scraped(spark: SparkSession, folder: str) -> DataFrame:
    page = F.col("page_id")
    status = page % 10
    return read_table(spark, folder, "pages").select(
        "page_id",
        F.concat(host(F.col("url")), F.when(page % 7 == 0, " ").otherwise("")).alias("website"),
        (F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(page.cast("int"))).alias("createdate"),
        F.when(status == 3, "HTTP Error: 404")
        .when(status == 4, "Request Error: timeout")
        .otherwise(F.col("html"))
        .alias("scrappeddata"),
    )


def companies(spark: SparkSession, folder: str) -> DataFrame:
    hosts = (
        read_table(spark, folder, "pages")
        .groupBy(host(F.col("url")).alias("website"))
        .agg(F.min("page_id").alias("m"))
    )
    m = F.col("m")
    return hosts.select(
        "website",
        _text("handle-", m).alias("handle"),
        _text("Company ", m).alias("name"),
        F.when(m % 2 == 0, "public").otherwise("private").alias("type"),
        F.when(m % 5 == 0, "automotive").when(m % 5 != 1, "games").alias("industry"),
        (m % 1000).cast("string").alias("size"),
        (1950 + m % 70).cast("string").alias("founded"),
        F.when(m % 3 == 0, "US").otherwise("DE").alias("country_code"),
        _text("City ", m % 50).alias("city"),
        _text("State ", m % 20).alias("state"),
    )


def game_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Landed JSON, one document per lineitem row; `LINE_ID` and `l_shipdate` are kept
    as the landing order. A game has many documents, the latest counts for its properties.
    """
    line, supp = F.col("l_linenumber"), F.col("l_suppkey")
    ship = F.datediff("l_shipdate", F.lit("1970-01-01").cast("date")).cast("long") * 86400
    doc = F.struct(
        F.col("l_partkey").alias("id"),
        _text("https://games.example/", F.col("l_partkey")).alias("url"),
        _text("Sold on ", F.col("l_linestatus"), " with flag ", F.col("l_returnflag")).alias("summary"),
        F.col("l_extendedprice").alias("total_rating"),
        F.when(line == 6, F.lit(0).cast("long")).when(line != 7, ship).alias("first_release_date"),
        (F.col("l_quantity").cast("int") % 20).alias("game_type"),
        (supp % 7).alias("franchise"),
        F.array(
            F.struct(line.cast("long").alias("id"), _text("Genre ", line).alias("name")),
            F.struct((100 + supp % 10).alias("id"), _text("Genre ", 100 + supp % 10).alias("name")),
        ).alias("genres"),
        F.array(
            F.struct(
                F.col("l_orderkey").alias("id"),
                F.struct(supp.alias("id"), supplier_name(supp).alias("name")).alias("company"),
            ),
            F.struct(
                F.col("l_orderkey").alias("id"),
                F.lit(None).cast("struct<id: long, name: string>").alias("company"),
            ),
        ).alias("involved_companies"),
        F.array(F.struct(F.col("l_orderkey").alias("id"))).alias("similar_games"),
    )
    lines = spread(read_table(spark, folder, "lineitem"))
    return lines.select(*LINE_ID, "l_shipdate", F.to_json(doc).alias("payload"))


def similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Landed JSON of similar games with names and, for odd lines, covers."""
    similar = F.col("l_orderkey")
    cover = F.when(
        F.col("l_linenumber") % 2 == 1,
        F.struct(F.concat(F.lit(ART), similar.cast("string")).alias("url")),
    )
    doc = F.struct(
        F.col("l_partkey").alias("id"),
        F.array(
            F.struct(similar.alias("id"), customer_name(similar).alias("name"), cover.alias("cover"))
        ).alias("similar_games"),
    )
    lines = spread(read_table(spark, folder, "lineitem"))
    return lines.select(*LINE_ID, "l_shipdate", F.to_json(doc).alias("payload"))


def games(spark: SparkSession, folder: str) -> DataFrame:
    """Games with string key, name (shared by many) and box art."""
    key = F.col("p_partkey").cast("string")
    return read_table(spark, folder, "part").select(
        key.alias("key"),
        F.col("p_name").alias("name"),
        F.concat(F.lit(ART), key).alias("box_art_url"),
        F.col("p_type").alias("genre"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def game_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return as_nodes(games(spark, folder), fixed.GAME, "key", ["name", "box_art_url"])


def catalogue_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return as_nodes(read_table(spark, folder, "part"), fixed.CATALOG_ID, "p_partkey")


def streams(spark: SparkSession, folder: str) -> DataFrame:
    """Streams with their game's key; one per lineitem row."""
    return read_table(spark, folder, "lineitem").select(
        F.concat_ws("-", *LINE_ID).alias("stream_id"),
        F.col("l_partkey").cast("string").alias("game_key"),
        F.col("l_quantity").alias("viewer_count"),
        _text("Line ", F.col("l_linenumber")).alias("title"),
        supplier_name(F.col("l_suppkey")).alias("user_name"),
        *LINE_ID,
    )


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tagged tokens: a document's source as company, language as product, label as other."""
    docs = read_table(spark, folder, "documents")
    pieces = F.array(
        F.struct(F.col("source").alias("word"), F.lit("B-ORG").alias("entity")),
        F.struct(F.col("lang").alias("word"), F.lit("I-PRODUCT").alias("entity")),
        F.struct(F.concat(F.col("source"), F.lit("/"), F.col("lang")).alias("word"), F.lit("B-LOC").alias("entity")),
    )
    return docs.select(F.col("doc_id").cast("string").alias("doc"), F.explode(pieces).alias("_t")).select("doc", "_t.*")


def trade_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Games, genres, companies and countries with their edges."""
    parts = games(spark, folder)
    suppliers = read_table(spark, folder, "supplier")
    nations = read_table(spark, folder, "nation")
    lines = read_table(spark, folder, "lineitem")
    nodes = (
        game_nodes(spark, folder)
        .unionByName(as_nodes(parts.select("genre").distinct(), fixed.GENRE, "genre"))
        .unionByName(
            suppliers.select(
                F.lit(fixed.COMPANY).alias("label"),
                F.col("s_suppkey").cast("string").alias("key"),
                F.create_map(F.lit("name"), F.col("s_name")).alias("props"),
            )
        )
        .unionByName(
            nations.select(
                F.lit(fixed.COUNTRY).alias("label"),
                F.col("n_nationkey").cast("string").alias("key"),
                F.create_map(F.lit("title"), F.col("n_name")).alias("props"),
            )
        )
    )
    edges = (
        as_edges(lines, fixed.GAME, "l_partkey", fixed.INVOLVES_COMPANY, fixed.COMPANY, "l_suppkey")
        .unionByName(as_edges(parts, fixed.GAME, "key", fixed.HAS_GENRE, fixed.GENRE, "genre"))
        .unionByName(
            as_edges(
                suppliers.filter(F.col("s_nationkey") != 0),
                fixed.COMPANY,
                "s_suppkey",
                fixed.LOCATED_IN,
                fixed.COUNTRY,
                "s_nationkey",
            )
        )
    )
    return nodes, edges
