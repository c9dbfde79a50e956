"""Queries over plain tables: lookups, upserts, ranking, guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import (
    as_key,
    code_name,
    default_if_falsy,
    epoch_timestamp,
    first_or,
    fixed,
    has_items,
    has_number,
    text_or,
    utc_year,
)
from ...operators.aggregates import count_by, latest
from ...operators.entities import cooccurrence, entity_nodes
from ...operators.links import DOCUMENT_SCHEMA, SIMILAR_SCHEMA
from ...operators.lookups import company_website
from ...operators.ranking import sample_rows, top_k, top_n
from ...session import new_table_path
from ...sources import (
    append_new,
    explode_list,
    lookup_by_ids,
    net_new,
    read_landed,
    read_payload,
    read_table,
    read_upserted,
    search_first,
    split_rejects,
    spread,
    upsert,
    upsert_table,
    write_snapshot,
)
from .. import adapters
from .base import DOCS, LATEST_LINE, TYPES, query



@query("net_new", "SELECT doc_id, source, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def net_new_documents(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "lang")
    return net_new(docs, read_table(spark, folder, "labels"), "doc_id")


@query(
    "append_new",
    """SELECT doc_id, source, lang, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 1 ELSE 2 END AS run
       FROM documents""",
)
def append_new_documents(spark, folder):
    """First run: the labelled documents. Second run: all, of which only the others are added."""
    path = new_table_path(spark, "documents")
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "lang")
    labelled = lookup_by_ids(docs, read_table(spark, folder, "labels"), "doc_id")
    append_new(labelled.withColumn("run", F.lit(1)), path, "doc_id")
    append_new(docs.withColumn("run", F.lit(2)), path, "doc_id")
    return spark.read.parquet(path)


@query(
    "upsert_latest",
    """SELECT c_custkey AS key, coalesce(status, 'none') AS status, coalesce(price, 0.0) AS price
       FROM customer LEFT JOIN (
         SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status,
                arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price
         FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def upsert_latest(spark, folder):
    existing = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.lit("none").alias("status"), F.lit(0.0).alias("price")
    )
    incoming = read_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        "o_orderdate",
        "o_orderkey",
    )
    return upsert(existing, incoming, "key", [latest("o_orderdate"), latest("o_orderkey")])


@query(
    "upsert_rounds",
    """SELECT vec_id, round_no, label FROM (
         SELECT vec_id, 0 AS round_no, label FROM embeddings
         UNION ALL SELECT vec_id * 2, 1, label FROM embeddings
         UNION ALL SELECT vec_id * 3, 2, label FROM embeddings)
       QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round_no DESC) = 1""",
)
def upsert_rounds(spark, folder):
    """A table merged into twice, each time from the snapshot written before."""
    vectors = read_table(spark, folder, "embeddings").select("vec_id", "label")
    place = new_table_path(spark, "vectors")
    current = write_snapshot(vectors.withColumn("round_no", F.lit(0)), place)
    for number in (1, 2):
        changed = vectors.select((F.col("vec_id") * (number + 1)).alias("vec_id"), "label", F.lit(number).alias("round_no"))
        current = write_snapshot(upsert(spark.read.parquet(current), changed, "vec_id", ["label"]), place)
    return spark.read.parquet(current)


@query(
    "landed_files",
    """SELECT role, count(*) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations GROUP BY 1""",
)
def landed_files(spark, folder):
    """Messages landed as JSON lines, read back and parsed."""
    path = new_table_path(spark, "landing")
    turns = read_table(spark, folder, "conversations").select(F.to_json(F.struct("*")).alias("value"))
    turns.write.text(path)
    parsed = read_payload(read_landed(spark, path), "payload", "role string, text string")
    return parsed.groupBy("role").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sum(F.length("text")).alias("n_chars")
    )


@query(
    "vector_upsert",
    """WITH changed AS (
         SELECT vec_id * 2 AS vec_id, label, embedding[64] AS first, embedding[1] AS last FROM embeddings)
       SELECT coalesce(c.vec_id, e.vec_id) AS vec_id, coalesce(c.label, e.label) AS label,
              CAST(coalesce(c.first, e.embedding[1]) AS DOUBLE) AS first_value,
              CAST(coalesce(c.last, e.embedding[64]) AS DOUBLE) AS last_value
       FROM embeddings e FULL JOIN changed c ON e.vec_id = c.vec_id""",
)
def vector_upsert(spark, folder):
    vectors = read_table(spark, folder, "embeddings")
    changed = vectors.select(
        (F.col("vec_id") * 2).alias("vec_id"), F.reverse("embedding").alias("embedding"), "label"
    )
    merged = upsert(vectors, changed, "vec_id", ["label"])
    return merged.select(
        "vec_id",
        "label",
        F.element_at("embedding", 1).cast("double").alias("first_value"),
        F.element_at("embedding", -1).cast("double").alias("last_value"),
    )


@query(
    "lookup_by_ids",
    "SELECT p_partkey, p_name, p_type FROM part WHERE p_partkey IN (SELECT l_orderkey FROM lineitem)",
)
def lookup_parts(spark, folder):
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    ids = read_table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("p_partkey"))
    return lookup_by_ids(parts, ids, "p_partkey")


@query(
    "upsert_touched",
    """SELECT c_custkey, CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE 'ordered' END AS note FROM customer
       LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 50 = 0) ON o_custkey = c_custkey""",
)
def upsert_touched(spark, folder):
    """Customers in a table dealt by key, of which a second run rewrites only the folders it has keys of."""
    path = new_table_path(spark, "customers")
    customers = read_table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("note"))
    upsert_table(customers, path, "c_custkey", ["note"])
    some = read_table(spark, folder, "orders").filter("o_orderkey % 50 = 0").select(F.col("o_custkey").alias("c_custkey"))
    known = lookup_by_ids(some.distinct(), customers, "c_custkey")
    upsert_table(known.withColumn("note", F.lit("ordered")), path, "c_custkey", ["note"])
    return read_upserted(spark, path)


@query(
    "search_equal",
    """SELECT p_name, p_partkey, p_retailprice FROM part
       QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_retailprice DESC, p_partkey) = 1""",
)
def search_equal(spark, folder):
    parts = read_table(spark, folder, "part")
    probes = parts.select(F.col("p_name").alias("probe"))
    found = search_first(probes, parts, "probe", "p_name", [latest("p_retailprice"), "p_partkey"])
    return found.select("p_name", "p_partkey", "p_retailprice")


@query(
    "search_phrase",
    """SELECT probe, p_partkey FROM
         (SELECT DISTINCT p_name AS probe FROM part),
         (SELECT p_partkey, ' ' || lower(replace(p_brand, '#', ' ') || ' ' || p_name || ' ' || p_type) || ' ' AS text FROM part)
       WHERE contains(text, ' ' || lower(probe) || ' ')
       QUALIFY row_number() OVER (PARTITION BY probe ORDER BY p_partkey) = 1""",
)
def search_phrase(spark, folder):
    parts = read_table(spark, folder, "part")
    docs = parts.select("p_partkey", F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("text"))
    probes = parts.select(F.col("p_name").alias("probe"))
    return search_first(probes, docs, "probe", "text", ["p_partkey"], mode="phrase").select("probe", "p_partkey")


@query(
    "search_contains",
    """SELECT probe, p_partkey FROM (SELECT DISTINCT substring(p_name, 3) AS probe FROM part) JOIN part ON contains(p_name, probe)
       QUALIFY row_number() OVER (PARTITION BY probe ORDER BY p_partkey) = 1""",
)
def search_contains(spark, folder):
    """Names without their first two letters, looked for inside all names."""
    parts = read_table(spark, folder, "part")
    probes = parts.select(F.substr("p_name", F.lit(3)).alias("probe"))
    docs = parts.select("p_partkey", "p_name")
    return search_first(probes, docs, "probe", "p_name", ["p_partkey"], mode="contains").select("probe", "p_partkey")


@query(
    "search_in_documents",
    """WITH told AS (
         SELECT text FROM benchmark UNION SELECT text FROM conversations
         UNION SELECT regexp_extract(lower(text), '[\\p{L}\\p{N}_]+') FROM conversations),
       probes AS (
         SELECT text AS probe, ' ' || array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+'), ' ') || ' ' AS run
         FROM told WHERE regexp_matches(text, '[\\p{L}\\p{N}_]')),
       texts AS (
         SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+'), ' ') || ' ' AS run FROM documents)
       SELECT probe, min(doc_id) AS doc_id FROM probes JOIN texts ON contains(texts.run, probes.run) GROUP BY probe""",
)
def search_in_documents(spark, folder):
    """Every message, its first word and every benchmark item, looked for as words in a row in all documents."""
    messages = read_table(spark, folder, "conversations").select("text")
    first_word = F.regexp_extract(F.lower("text"), r"[\p{L}\p{N}_]+", 0)
    probes = messages.union(messages.select(first_word)).union(read_table(spark, folder, "benchmark").select("text"))
    docs = spread(read_table(spark, folder, "documents").select("doc_id", "text"))
    return search_first(probes.toDF("probe"), docs, "probe", "text", ["doc_id"], mode="phrase").select("probe", "doc_id")


@query(
    "search_inside_documents",
    """WITH probes AS (
         SELECT unnest(string_split(text, chr(10))) AS probe FROM benchmark UNION SELECT text FROM conversations
         UNION SELECT n_name FROM nation UNION SELECT lower(substring(n_name, 1, 3)) FROM nation)
       SELECT probe, min(doc_id) AS doc_id FROM (SELECT probe FROM probes WHERE probe <> '') JOIN documents ON contains(text, probe)
       GROUP BY probe""",
)
def search_inside_documents(spark, folder):
    """Lines of benchmark items, messages and short strings, looked for as runs of characters in all documents."""
    lines = read_table(spark, folder, "benchmark").select(F.explode(F.split("text", "\n")))
    names = read_table(spark, folder, "nation").select("n_name")
    short = names.select(F.lower(F.substring("n_name", 1, 3)))
    probes = lines.union(read_table(spark, folder, "conversations").select("text")).union(names).union(short)
    docs = spread(read_table(spark, folder, "documents").select("doc_id", "text"))
    return search_first(probes.toDF("probe"), docs, "probe", "text", ["doc_id"], mode="contains").select("probe", "doc_id")


@query(
    "default_and_guard",
    f"""WITH {DOCS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(released, 0) AS released,
       TIMESTAMP '1970-01-01 00:00:00' + to_seconds(coalesce(released, 0)) AS released_at,
       CASE WHEN released <> 0 THEN CAST(year(l_shipdate) AS INTEGER) END AS release_year,
       coalesce(released <> 0, false) AS has_date, franchise <> 0 AS has_franchise
FROM docs""",
)
def default_and_guard(spark, folder):
    docs = read_payload(adapters.game_documents(spark, folder), "payload", DOCUMENT_SCHEMA)
    date = F.col("first_release_date")
    released = default_if_falsy(has_number(date), date, 0)
    return docs.select(
        *adapters.LINE_ID,
        released.alias("released"),
        epoch_timestamp(released).alias("released_at"),
        F.when(has_number(date), utc_year(date)).alias("release_year"),
        has_number(date).alias("has_date"),
        has_number(F.col("franchise")).alias("has_franchise"),
    )


@query(
    "explode_payload",
    f"""WITH {DOCS},
genres AS (
  SELECT id, l_suppkey, l_extendedprice, unnest([l_linenumber, 100 + l_suppkey % 10]) AS genre_id FROM docs)
SELECT genre_id, 'Genre ' || genre_id AS genre_name, count(*) AS n_docs, count(DISTINCT id) AS n_games,
       max(l_extendedprice) AS top_rating
FROM genres GROUP BY 1, 2""",
)
def explode_payload(spark, folder):
    docs = read_payload(
        adapters.game_documents(spark, folder),
        "payload",
        "id long, total_rating double, genres array<struct<id: long, name: string>>",
    )
    genres = explode_list(docs, "genres", "genre")
    return genres.groupBy(F.col("genre.id").alias("genre_id"), F.col("genre.name").alias("genre_name")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.countDistinct("id").alias("n_games"),
        F.max("total_rating").alias("top_rating"),
    )


@query(
    "similar_covers",
    """SELECT l_orderkey AS similar_id, 'Customer#' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS name,
              CASE WHEN l_linenumber % 2 = 1 THEN 'https://art.example/{width}x{height}/' || l_orderkey ELSE '' END AS cover,
              count(*) AS n_docs
       FROM lineitem GROUP BY 1, 2, 3""",
)
def similar_covers(spark, folder):
    docs = read_payload(adapters.similar_documents(spark, folder), "payload", SIMILAR_SCHEMA)
    similar = explode_list(docs, "similar_games", "s")
    named = similar.select(
        F.col("s.id").alias("similar_id"), F.col("s.name").alias("name"), text_or(F.col("s.cover.url")).alias("cover")
    )
    return count_by(named, ["similar_id", "name", "cover"], "n_docs")


@query(
    "code_lookup",
    f"""WITH {TYPES}, {DOCS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, code, type_name
FROM docs JOIN types ON code = game_type""",
)
def code_lookup(spark, folder):
    docs = read_payload(adapters.game_documents(spark, folder), "payload", "game_type int")
    named = docs.withColumn("type_name", code_name(F.col("game_type")))
    return named.filter("type_name IS NOT NULL").select(
        *adapters.LINE_ID, F.col("game_type").alias("code"), "type_name"
    )


@query(
    "website_chain",
    """WITH requested AS (SELECT DISTINCT o_orderkey AS game FROM orders),
     g AS (SELECT p_partkey AS game, CASE WHEN p_size <= 5 THEN NULL ELSE p_partkey * 10 END AS involvement FROM part),
     i AS (SELECT p_partkey * 10 AS involvement, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_partkey // 20 END AS company
           FROM part WHERE p_type <> 'ECONOMY'),
     c AS (SELECT s_suppkey AS company, CASE WHEN s_acctbal < 5000 THEN 'https://' || lower(s_name) || '.example' END AS site
           FROM supplier)
     SELECT requested.game,
            CASE WHEN g.game IS NULL THEN 'Game not found.'
                 WHEN g.involvement IS NULL THEN 'No company information available.'
                 WHEN i.involvement IS NULL THEN 'Company ID not found.'
                 WHEN coalesce(i.company, 0) = 0 THEN 'Company details missing.'
                 WHEN c.site IS NULL THEN 'Company website not found.'
                 ELSE c.site END AS answer
     FROM requested LEFT JOIN g ON g.game = requested.game
     LEFT JOIN i ON i.involvement = g.involvement LEFT JOIN c ON c.company = i.company""",
)
def website_chain(spark, folder):
    """Orders ask for games; parts are the games, suppliers the companies."""
    part = read_table(spark, folder, "part")
    key = F.col("p_partkey")
    games = part.select(
        key.alias("id"),
        F.when(F.col("p_size") <= 5, F.array().cast("array<long>"))
        .otherwise(F.array(key * 10, key * 10 + 1))
        .alias("involved_companies"),
    )
    involved = part.filter("p_type <> 'ECONOMY'").select(
        (key * 10).alias("id"), F.when(F.col("p_type") != "PROMO", F.floor(key / 20)).alias("company")
    )
    url = F.concat(F.lit("https://"), F.lower("s_name"), F.lit(".example"))
    companies = read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") < 5000, F.array(F.struct(url.alias("url")))).alias("websites"),
    )
    requested = read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("game")).distinct()
    return company_website(requested, "game", games, involved, companies)


@query(
    "cooccurrence",
    """SELECT DISTINCT 'Company' AS src_label, source AS src_key, 'SELLS' AS rel_type, 'Product' AS dst_label,
              lang AS dst_key FROM documents""",
)
def sells(spark, folder):
    return cooccurrence(adapters.tokens(spark, folder))


@query(
    "entity_nodes",
    """SELECT DISTINCT 'Company' AS label, source AS name FROM documents
       UNION SELECT 'Product', lang FROM documents UNION SELECT 'Loc', source || '/' || lang FROM documents""",
)
def entities(spark, folder):
    return entity_nodes(adapters.tokens(spark, folder))


@query(
    "top_streams_per_game",
    """SELECT game_key, stream_id, viewer_count, rank FROM (
         SELECT CAST(l_partkey AS VARCHAR) AS game_key, l_quantity AS viewer_count,
                l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS stream_id,
                row_number() OVER (PARTITION BY l_partkey
                  ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_suppkey) AS rank
         FROM lineitem) WHERE rank <= 3""",
)
def top_streams_per_game(spark, folder):
    streams = adapters.streams(spark, folder)
    best = top_k(
        streams, ["game_key"], [latest("viewer_count"), *adapters.LINE_ID], fixed.STREAMS_PER_SIMILAR_GAME, "rank"
    )
    return best.select("game_key", "stream_id", "viewer_count", "rank")


_TOP_GAMES = """
WITH top AS (
  SELECT l_partkey, sum(l_quantity) AS viewers FROM lineitem GROUP BY 1 ORDER BY viewers DESC, l_partkey LIMIT 10)
"""


def _top_games(spark, folder):
    viewers = adapters.streams(spark, folder).groupBy("l_partkey").agg(F.sum("viewer_count").alias("viewers"))
    return top_n(viewers, [latest("viewers"), "l_partkey"])


@query("top_games", _TOP_GAMES + "SELECT * FROM top")
def top_games(spark, folder):
    return _top_games(spark, folder)


@query(
    "top_game_streams",
    _TOP_GAMES
    + """SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity AS viewer_count FROM lineitem
         WHERE l_partkey IN (SELECT l_partkey FROM top)
         QUALIFY row_number() OVER (PARTITION BY l_partkey
           ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_suppkey) <= 5""",
)
def top_game_streams(spark, folder):
    streams = lookup_by_ids(adapters.streams(spark, folder), _top_games(spark, folder), "l_partkey")
    best = top_k(
        streams, ["l_partkey"], [latest("viewer_count"), *adapters.LINE_ID], fixed.STREAMS_PER_TOP_GAME
    )
    return best.select(*adapters.LINE_ID, "viewer_count")


@query(
    "sample_rows",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
        ORDER BY {LATEST_LINE} LIMIT 10""",
)
def sample_lines(spark, folder):
    lines = read_table(spark, folder, "lineitem").select(*adapters.LINE_ID, "l_shipdate")
    return sample_rows(lines, [latest("l_shipdate"), *adapters.LINE_ID])


@query(
    "count_similar",
    """SELECT CAST(l_partkey AS VARCHAR) AS game, count(*) AS n_similar FROM lineitem GROUP BY 1""",
)
def count_similar(spark, folder):
    docs = read_payload(adapters.game_documents(spark, folder), "payload", "id long, similar_games array<struct<id: long>>")
    similar = explode_list(docs, "similar_games", "similar")
    return count_by(similar.select(as_key(F.col("id")).alias("game")), ["game"], "n_similar")


@query(
    "reject_split",
    """SELECT event_id, event_type = 'error' OR value < 1 AS rejected,
              CASE WHEN event_type = 'error' THEN 'failed event' WHEN value < 1 THEN 'value too small' ELSE '' END AS reason
       FROM events""",
)
def reject_split(spark, folder):
    reason = F.when(F.col("event_type") == "error", "failed event").when(F.col("value") < 1, "value too small")
    good, bad = split_rejects(read_table(spark, folder, "events"), reason)
    return good.select("event_id", F.lit(False).alias("rejected"), F.lit("").alias("reason")).unionByName(
        bad.select("event_id", F.lit(True).alias("rejected"), "reason")
    )


@query(
    "first_of_list",
    f"""WITH {DOCS}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS first_genre,
       true AS has_similar FROM docs""",
)
def first_of_list(spark, folder):
    docs = read_payload(
        adapters.game_documents(spark, folder),
        "payload",
        "genres array<struct<id: long>>, similar_games array<struct<id: long>>",
    )
    return docs.select(
        *adapters.LINE_ID,
        first_or(F.col("genres.id"), -1).cast("long").alias("first_genre"),
        has_items(F.col("similar_games")).alias("has_similar"),
    )
