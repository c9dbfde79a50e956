"""Queries over text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import (
    canonical_case,
    company_prompt,
    first_chars,
    html_to_text,
    json_object,
    row_json,
    schema_tokens,
    site_prompt,
    strip_text,
)
from ...operators.aggregates import assemble_pages, canonical_text
from ...operators.enrich import enrich
from ...sources import read_table, spread
from .. import adapters
from .base import query

# Pages cut at every `<`; what hides the text behind a piece is the last opening or closing before it.
_PAGE_TEXT = """
WITH cut AS (
  SELECT page_id, url, unnest(string_split(html, '<')) AS piece, generate_subscripts(string_split(html, '<'), 1) AS i FROM pages),
tagged AS (
  SELECT *, CASE WHEN i > 1 THEN lower(regexp_extract(piece, '^(!--|/?[A-Za-z0-9]+)')) ELSE '' END AS tag FROM cut),
opened AS (
  SELECT *, last_value(CASE WHEN tag IN ('script', 'style', 'template') THEN 'hidden'
                            WHEN tag IN ('/script', '/style', '/template') THEN 'shown'
                            WHEN tag = '!--' AND NOT contains(piece, '-->') THEN 'comment'
                            WHEN contains(piece, '-->') THEN 'shown' END IGNORE NULLS)
              OVER (PARTITION BY page_id ORDER BY i) AS state
  FROM tagged),
seen AS (
  SELECT page_id, url, i,
         CASE WHEN i = 1 THEN piece WHEN state IN ('hidden', 'comment') THEN ''
              WHEN contains(piece, '-->') THEN substring(piece, strpos(piece, '-->') + 3)
              ELSE substring(piece, strpos(piece, '>') + 1) END AS text
  FROM opened),
page_text AS (
  SELECT page_id, url, replace(replace(replace(replace(
    string_agg(text, '' ORDER BY i), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&') AS text
  FROM seen GROUP BY page_id, url)
"""


def _pages(spark, folder):
    pages = spread(read_table(spark, folder, "pages"))
    return pages.select("page_id", "url", html_to_text(F.col("html")).alias("text"))


@query("page_text", _PAGE_TEXT + "SELECT page_id, text FROM page_text")
def page_text(spark, folder):
    return _pages(spark, folder).select("page_id", "text")


@query(
    "page_text_2000",
    _PAGE_TEXT + "SELECT page_id, substring(text, 1, 2000) AS head, length(text) AS chars FROM page_text",
)
def page_text_2000(spark, folder):
    return _pages(spark, folder).select(
        "page_id", first_chars(F.col("text")).alias("head"), F.length("text").cast("long").alias("chars")
    )


@query(
    "site_prompts",
    _PAGE_TEXT
    + """SELECT page_id, url, 'Summarize this webpage in 300 max characters:' || chr(10) || substring(text, 1, 2000) AS prompt
         FROM page_text""",
)
def site_prompts(spark, folder):
    return _pages(spark, folder).select("page_id", "url", site_prompt(first_chars(F.col("text"))).alias("prompt"))


@query(
    "strip_text",
    r"""SELECT doc_id, regexp_replace(text, '^[\t-\r\x1c-\x20\x{85}\p{Z}]+|[\t-\r\x1c-\x20\x{85}\p{Z}]+$', '', 'g') AS text
        FROM documents""",
)
def stripped(spark, folder):
    return spread(read_table(spark, folder, "documents")).select("doc_id", strip_text(F.col("text")).alias("text"))


@query(
    "assemble_pages",
    """SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text
       FROM conversations WHERE text <> '' GROUP BY 1""",
)
def assembled(spark, folder):
    return assemble_pages(read_table(spark, folder, "conversations"), "conv_id", "turn", "text")


_CASED = {"labels": ["The", "La"], "rels": ["OF", "DIE"], "props": ["eN", "the_name"]}


@query(
    "canonical_case",
    r"""SELECT doc_id, array_to_string(list_transform(
          regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+'),
          lambda w: CASE lower(w) WHEN 'the' THEN 'The' WHEN 'la' THEN 'La' WHEN 'of' THEN 'OF' WHEN 'die' THEN 'DIE'
            WHEN 'en' THEN 'eN' WHEN 'the_name' THEN 'the_name' ELSE w END), '') AS text
        FROM documents""",
)
def cased(spark, folder):
    docs = spread(read_table(spark, folder, "documents"))
    return docs.select("doc_id", canonical_case(F.col("text"), **_CASED).alias("text"))


@query(
    "canonical_text",
    r"""WITH names(lower, name) AS (VALUES ('game', 'Game'), ('genre', 'Genre'), ('company', 'Company'), ('country', 'Country'),
          ('involves_company', 'INVOLVES_COMPANY'), ('has_genre', 'HAS_GENRE'), ('located_in', 'LOCATED_IN'),
          ('name', 'name'), ('title', 'title'), ('box_art_url', 'box_art_url'), ('id', 'id'), ('code', 'code'), ('catalog_id', 'catalog_id')),
        said AS (SELECT event_id, upper(event_type) || ' of a GAME, has_genre: ID ' || event_id || ' of COUNTRY Code games' AS text FROM events),
        parts AS (
          SELECT event_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+')) AS part,
                 generate_subscripts(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+'), 1) AS i FROM said)
        SELECT event_id, string_agg(coalesce(name, part), '' ORDER BY i) AS text FROM parts LEFT JOIN names ON lower = lower(part) GROUP BY 1""",
)
def spelt(spark, folder):
    """Questions with the names of the graph's own schema spelt as there."""
    nodes, edges = adapters.trade_graph(spark, folder)
    said = F.concat(F.upper("event_type"), F.lit(" of a GAME, has_genre: ID "), F.col("event_id").cast("string"), F.lit(" of COUNTRY Code games"))
    asked = read_table(spark, folder, "events").select("event_id", said.alias("text"))
    return canonical_text(asked, "text", nodes, edges)


@query(
    "extract_tokens",
    r"""SELECT page_id,
          array_to_string(list_sort(list_distinct(regexp_extract_all(html, ':([A-Z][A-Za-z0-9_]*)', 1))), ' ') AS labels,
          array_to_string(list_sort(list_distinct(regexp_extract_all(html, '-\[:([A-Z_][A-Za-z0-9_]*)\]-', 1))), ' ') AS rels,
          array_to_string(list_sort(list_distinct(regexp_extract_all(html, '\.([a-zA-Z_][A-Za-z0-9_]*)', 1))), ' ') AS props
        FROM pages""",
)
def tokens(spark, folder):
    found = schema_tokens(F.col("html"))
    return read_table(spark, folder, "pages").select(
        "page_id", *[F.array_join(col, " ").alias(name) for name, col in found.items()]
    )


@query(
    "row_json",
    """SELECT c_custkey, CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
                'c_mktsegment': c_mktsegment}) AS VARCHAR) AS json FROM customer""",
)
def customer_json(spark, folder):
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return read_table(spark, folder, "customer").select("c_custkey", row_json(cols).alias("json"))


@query(
    "prompt_text",
    """SELECT DISTINCT 'Give me a 500 character summary about the ' || s_name || ' game company.' AS prompt
       FROM supplier""",
)
def company_prompts(spark, folder):
    return read_table(spark, folder, "supplier").select(company_prompt(F.col("s_name")).alias("prompt")).distinct()


@query(
    "json_objects",
    """SELECT event_id, event_type <> 'error' AS is_object,
              CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS k FROM events""",
)
def json_objects(spark, folder):
    """Error events carry a cut-off JSON text here, which is passed over."""
    broken = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    blob = json_object(broken)
    return read_table(spark, folder, "events").select(
        "event_id", blob.isNotNull().alias("is_object"), F.try_element_at(blob, F.lit("k")).alias("k")
    )


@query(
    "enrich_text",
    r"""SELECT doc_id, length(text) || ' characters, ' || length(regexp_extract_all(text, '[^\s\x0b\x1c-\x1f\x{85}\p{Z}]+'))
          || ' words' AS summary FROM documents""",
)
def enriched(spark, folder):
    docs = spread(read_table(spark, folder, "documents").select("doc_id", "text"))
    return enrich(docs, "text", "summary").select("doc_id", "summary")


@query(
    "enrich_skip",
    r"""SELECT turn_id, reply FROM (
          SELECT conv_id || '/' || turn AS turn_id, length(text) || ' characters' AS reply, role FROM conversations)
        WHERE role <> 'assistant'""",
)
def enrich_skip(spark, folder):
    """A text function that fails for assistant messages; those rows are skipped."""

    def reply(message: str) -> str:
        role, text = message.split("|", 1)
        if role == "assistant":
            raise ValueError("nothing to say to oneself")
        return f"{len(text)} characters"

    messages = read_table(spark, folder, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("turn_id"), F.concat_ws("|", "role", "text").alias("message")
    )
    return enrich(messages, "message", "reply", reply, on_error="skip").select("turn_id", "reply")


@query(
    "enrich_value",
    r"""SELECT conv_id || '/' || turn AS turn_id,
               CASE WHEN role = 'assistant' THEN 'Error: nothing to say to oneself' ELSE role END AS reply
        FROM conversations""",
)
def enrich_value(spark, folder):
    """The same failure stored as the value."""

    def reply(role: str) -> str:
        if role == "assistant":
            raise ValueError("nothing to say to oneself")
        return role

    messages = read_table(spark, folder, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("turn_id"), "role"
    )
    return enrich(messages, "role", "reply", reply).select("turn_id", "reply")
