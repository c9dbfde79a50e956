"""Queries of the company chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import fetch_status, persona_prompt, row_json
from ...operators.filters import country_view
from ...operators.joins import split_join
from ...operators.ranking import assign_uid
from ...session import keep, new_table_path
from ...sources import append, read_table, upsert
from .. import adapters, company
from .base import COMPANIES, SCRAPED, query

PAGE_ORDER = ["createdate", "page_id"]

_STAGED = f"""
WITH {SCRAPED}, {COMPANIES},
staged AS (
  SELECT c.*, row_number() OVER (ORDER BY c.website, s.createdate, s.page_id) AS uid
  FROM companies c JOIN scraped s USING (website)),
usable AS (
  SELECT page_id, createdate, scrappeddata, trim(website) AS site FROM scraped
  WHERE NOT regexp_matches(lower(website), 'facebook|linkedin|wordpress|instagram')
    AND NOT regexp_matches(scrappeddata, 'HTTP Error|Request Error')),
first_page AS (
  SELECT site, arg_min(createdate, page_id) AS d, arg_min(scrappeddata, page_id) AS t, count(*) AS copies
  FROM usable GROUP BY site),
per_uid AS (
  SELECT staged.*, d, t, copies FROM staged JOIN first_page ON trim(website) = site
  WHERE industry IS NOT NULL AND NOT contains(industry, 'automotive')),
chain AS (
  SELECT website, handle, name, type, industry, size, founded, country_code, city, state, uid AS "UID",
         d AS "scrappedDate", t AS "SCRAPPEDDATA", CAST(1 AS BIGINT) AS "RowNumCounter", CAST(1 AS BIGINT) AS "RowNum"
  FROM per_uid QUALIFY uid = min(uid) OVER (PARTITION BY website))
"""


def _chain(spark, folder):
    return company.company_chain(
        adapters.companies(spark, folder), adapters.scraped(spark, folder), PAGE_ORDER
    )


@query("company_chain", _STAGED + "SELECT * FROM chain")
def company_chain(spark, folder):
    return _chain(spark, folder)


@query("company_us_view", _STAGED + "SELECT * FROM chain WHERE country_code = 'US'")
def company_us_view(spark, folder):
    return country_view(_chain(spark, folder))


@query(
    "stage_companies",
    _STAGED
    + """SELECT website, handle, name, type, industry, size, founded, country_code, city, state, uid AS "UID"
         FROM staged""",
)
def stage_companies(spark, folder):
    return company.stage_companies(
        adapters.companies(spark, folder), adapters.scraped(spark, folder), PAGE_ORDER
    )


@query(
    "company_first_pages",
    _STAGED
    + """SELECT uid AS "UID", website, industry, d AS "scrappedDate", length(t) AS page_chars, copies AS page_copies
         FROM per_uid""",
)
def company_first_pages(spark, folder):
    """The first page of every staged company's site, and how many there are; `company_pages` has them all."""
    scraped = adapters.scraped(spark, folder)
    staged = company.stage_companies(adapters.companies(spark, folder), scraped, PAGE_ORDER)
    return company.company_pages(staged, scraped, PAGE_ORDER).select(
        "UID",
        "website",
        "industry",
        "scrappedDate",
        F.length("SCRAPPEDDATA").cast("long").alias("page_chars"),
        "page_copies",
    )


_PAGE_TEXTS = (
    _STAGED
    + """SELECT c.website, c.name, c.industry, page_id, createdate AS "scrappedDate", scrappeddata AS "SCRAPPEDDATA"
         FROM (SELECT DISTINCT * FROM companies) c JOIN usable ON trim(c.website) = site
         WHERE industry IS NOT NULL AND NOT contains(industry, 'automotive')
           AND c.website IN (SELECT website FROM scraped)"""
)


def _page_texts(spark, folder):
    paged = company.company_page_texts(adapters.companies(spark, folder), adapters.scraped(spark, folder), PAGE_ORDER)
    page = F.col("order_page_id").alias("page_id")
    return paged.select("website", "name", "industry", page, "scrappedDate", "SCRAPPEDDATA")


@query("company_page_texts", _PAGE_TEXTS)
def company_page_texts(spark, folder):
    """All page texts of every usable company, whole."""
    return _page_texts(spark, folder)


@query(
    "company_pages",
    _STAGED
    + """, spans AS (SELECT website, min(uid) AS first_uid, max(uid) AS last_uid, count(*) AS staged_rows FROM staged GROUP BY 1)
         SELECT c.website, c.name, c.industry, page_id, createdate AS "scrappedDate", scrappeddata AS "SCRAPPEDDATA",
                first_uid AS "first_UID", last_uid AS "last_UID", staged_rows
         FROM (SELECT DISTINCT * FROM companies) c JOIN usable ON trim(c.website) = site JOIN spans ON spans.website = c.website
         WHERE industry IS NOT NULL AND NOT contains(industry, 'automotive')""",
)
def company_pages(spark, folder):
    """All page texts of every usable company, whole, with the numbers of its staged rows.

    The plain join repeats every page for each staged row of the company. Rows are numbered by website first, so
    `first_UID` to `last_UID` are those rows.
    """
    staged = company.stage_companies(adapters.companies(spark, folder), adapters.scraped(spark, folder), PAGE_ORDER)
    spans = staged.groupBy("website").agg(
        F.min("UID").alias("first_UID"), F.max("UID").alias("last_UID"), F.count(F.lit(1)).alias("staged_rows")
    )
    # One row per website, kept: the texts are joined to finished numbers.
    return split_join(_page_texts(spark, folder), keep(spans), "website")


@query("usable_pages", _STAGED + "SELECT page_id, site, createdate, scrappeddata AS page_text FROM usable")
def usable_pages(spark, folder):
    return company.usable_pages(adapters.scraped(spark, folder)).select(
        "page_id",
        F.trim("website").alias("site"),
        "createdate",
        F.col("scrappeddata").alias("page_text"),
    )


@query(
    "append_rerun",
    _STAGED + """SELECT website, "UID", CAST(2 AS BIGINT) AS copies FROM chain""",
)
def append_rerun(spark, folder):
    """The plain incremental table: a second run appends the whole set again."""
    path = new_table_path(spark, "companies")
    for _ in range(2):
        append(_chain(spark, folder), path)
    return spark.read.parquet(path).groupBy("website", "UID").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "persona_prompts_rows",
    _STAGED
    + """SELECT "UID", json, 'Please parse the raw text of this company''s website and define a buying persona out of it '
                || json || '?' AS prompt
         FROM (SELECT "UID", CAST(to_json({'website': website, 'handle': handle, 'name': name, 'type': type,
                 'industry': industry, 'size': size, 'founded': founded, 'country_code': country_code,
                 'city': city, 'state': state, 'UID': "UID"}) AS VARCHAR) AS json FROM chain)""",
)
def persona_prompts_rows(spark, folder):
    """Prompts of the company alone; `persona_prompts` has the page text that they ask to parse."""
    rows = _chain(spark, folder).select("UID", row_json([*company.COMPANY, "UID"]).alias("json"))
    return rows.withColumn("prompt", persona_prompt(F.col("json")))


_WHOLE_PROMPTS = (
    _STAGED
    + """SELECT "UID", json, 'Please parse the raw text of this company''s website and define a buying persona out of it '
                || json || '?' AS prompt
         FROM (SELECT "UID", CAST(to_json({'website': website, 'handle': handle, 'name': name, 'type': type,
                 'industry': industry, 'size': size, 'founded': founded, 'country_code': country_code,
                 'city': city, 'state': state, 'UID': "UID",
                 'scrappedDate': strftime("scrappedDate", '%Y-%m-%dT%H:%M:%S.%g'),
                 'SCRAPPEDDATA': "SCRAPPEDDATA"}) AS VARCHAR) AS json FROM chain)"""
)


@query("persona_prompts_whole", _WHOLE_PROMPTS)
@query("persona_prompts", _WHOLE_PROMPTS)
def persona_prompts(spark, folder):
    """The prompts with the whole row, the page text included."""
    return company.prompts(_chain(spark, folder))


@query("persona_table", _STAGED + """SELECT "UID", true AS described FROM chain""")
def persona_table(spark, folder):
    """Every clean row, page text included, through the persona prompt and the text function."""
    told = company.personas(_chain(spark, folder))
    return told.select("UID", F.col("persona").rlike(r"^\d+ characters, \d+ words$").alias("described"))


@query(
    "persona_upsert",
    _STAGED
    + """SELECT staged.uid AS "UID", chain."UID" IS NOT NULL AS told
         FROM staged LEFT JOIN chain ON chain."UID" = staged.uid""",
)
def persona_upsert(spark, folder):
    """A table of personas still to be told for all staged rows, with those of the clean rows merged in."""
    staged = company.stage_companies(
        adapters.companies(spark, folder), adapters.scraped(spark, folder), PAGE_ORDER
    )
    waiting = staged.select("UID", F.lit("").alias("persona"))
    told = upsert(waiting, company.personas(_chain(spark, folder)), "UID", ["persona"])
    return told.select("UID", (F.col("persona") != "").alias("told"))


@query(
    "assign_uid",
    'SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS "UID" FROM customer',
)
def assign_customer_uid(spark, folder):
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return assign_uid(customers, ["c_mktsegment", "c_custkey"])


@query(
    "fetch_status",
    f"""WITH {SCRAPED}
SELECT page_id, website,
       CASE WHEN scrappeddata IS NULL THEN 'missing' WHEN contains(scrappeddata, 'HTTP Error') THEN 'http_error'
            WHEN contains(scrappeddata, 'Request Error') THEN 'request_error' ELSE 'ok' END AS status
FROM scraped""",
)
def page_status(spark, folder):
    return adapters.scraped(spark, folder).select(
        "page_id", "website", fetch_status(F.col("scrappeddata")).alias("status")
    )
