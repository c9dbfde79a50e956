"""The registry, and SQL for the adapters in `siteweave.plans.adapters`."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ...functions import fixed
from ...session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, folder) -> DataFrame function under a name."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


# Columns that order lineitem rows totally, latest shipment first.
LATEST_LINE = "l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey"

SCRAPED = """
scraped AS (
  SELECT page_id,
         regexp_extract(url, 'https?://([^/]+)', 1) || CASE WHEN page_id % 7 = 0 THEN ' ' ELSE '' END AS website,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id AS INTEGER)) AS createdate,
         CASE page_id % 10 WHEN 3 THEN 'HTTP Error: 404' WHEN 4 THEN 'Request Error: timeout' ELSE html END AS scrappeddata
  FROM pages)"""

COMPANIES = """
companies AS (
  SELECT website, 'handle-' || m AS handle, 'Company ' || m AS name,
         CASE WHEN m % 2 = 0 THEN 'public' ELSE 'private' END AS type,
         CASE m % 5 WHEN 0 THEN 'automotive' WHEN 1 THEN NULL ELSE 'games' END AS industry,
         CAST(m % 1000 AS VARCHAR) AS size, CAST(1950 + m % 70 AS VARCHAR) AS founded,
         CASE WHEN m % 3 = 0 THEN 'US' ELSE 'DE' END AS country_code,
         'City ' || (m % 50) AS city, 'State ' || (m % 20) AS state
  FROM (SELECT regexp_extract(url, 'https?://([^/]+)', 1) AS website, min(page_id) AS m FROM pages GROUP BY 1))"""

# A landed document per lineitem row, its JSON fields as plain columns.
DOCS = """
docs AS (
  SELECT *, l_partkey AS id,
         CASE l_linenumber WHEN 6 THEN 0 WHEN 7 THEN NULL ELSE CAST(epoch(l_shipdate) AS BIGINT) END AS released,
         CAST(l_quantity AS INTEGER) % 20 AS game_type, l_suppkey % 7 AS franchise
  FROM lineitem)"""

TYPES = "types(code, type_name) AS (VALUES " + ", ".join(
    f"({code}, '{name}')" for code, name in fixed.GAME_TYPES.items()
) + ")"

LABEL_NODES = """
nodes AS (
  SELECT 'Game' AS label, CAST(p_partkey AS VARCHAR) AS key, p_name AS name FROM part
  UNION ALL SELECT DISTINCT 'Genre', p_type, NULL FROM part
  UNION ALL SELECT 'Company', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
  UNION ALL SELECT 'Country', CAST(n_nationkey AS VARCHAR), n_name FROM nation)"""

TRADE_EDGES = """
edges AS (
  SELECT DISTINCT 'Game' AS src_label, CAST(l_partkey AS VARCHAR) AS src_key, 'INVOLVES_COMPANY' AS rel_type,
         'Company' AS dst_label, CAST(l_suppkey AS VARCHAR) AS dst_key FROM lineitem
  UNION ALL SELECT DISTINCT 'Game', CAST(p_partkey AS VARCHAR), 'HAS_GENRE', 'Genre', p_type FROM part
  UNION ALL SELECT DISTINCT 'Company', CAST(s_suppkey AS VARCHAR), 'LOCATED_IN', 'Country', CAST(s_nationkey AS VARCHAR)
            FROM supplier WHERE s_nationkey <> 0)"""
