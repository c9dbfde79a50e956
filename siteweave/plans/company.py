"""Company records joined to scraped pages, one clean row per site.

companies(website, handle, name, type, industry, size, founded, country_code, city, state)
scraped(website, createdate, scrappeddata, ...)
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, persona_prompt, row_json
from ..operators.enrich import enrich
from ..operators.filters import exclude_ilike, exclude_like
from ..operators.joins import split_join
from ..operators.ranking import assign_uid, dedupe_first
from ..session import keep

COMPANY = [
    "website",
    "handle",
    "name",
    "type",
    "industry",
    "size",
    "founded",
    "country_code",
    "city",
    "state",
]
CHAIN = [*COMPANY, "UID", "scrappedDate", "SCRAPPEDDATA"]


def stage_companies(companies: DataFrame, scraped: DataFrame, page_order: Sequence[str]) -> DataFrame:
    """One numbered row per company and scrape of exactly its website.

    `page_order` names scrape columns that tell a site's scrapes apart, so that a
    site with very many of them still sorts over several tasks.
    """
    fanned = split_join(companies, scraped.select("website", *page_order), "website")
    rest = [c for c in companies.columns if c != "website"]
    return assign_uid(fanned, ["website", *rest, *page_order]).drop(*page_order)


def usable_companies(staged: DataFrame) -> DataFrame:
    return exclude_like(staged, "industry", [fixed.EXCLUDED_INDUSTRY])


def usable_pages(scraped: DataFrame) -> DataFrame:
    """Fetched pages of hosts that are a company's own."""
    own = exclude_ilike(scraped.filter(F.col("website").isNotNull()), "website", fixed.BLOCKED_HOSTS)
    fetched = own.filter(F.col("scrappeddata").isNotNull())
    return exclude_like(fetched, "scrappeddata", [fixed.HTTP_ERROR, fixed.REQUEST_ERROR])


def _site_pages(scraped: DataFrame, page_order: Sequence[str]) -> DataFrame:
    return usable_pages(scraped).select(
        F.trim("website").alias("site"),
        F.col("createdate").alias("scrappedDate"),
        F.col("scrappeddata").alias("SCRAPPEDDATA"),
        *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(page_order)],
    )


def company_pages(staged: DataFrame, scraped: DataFrame, page_order: Sequence[str]) -> DataFrame:
    """Staged companies with the first page of the same site, the site's name trimmed.

    A site with m scrapes has m staged rows and m pages; a plain join would repeat
    each staged row m times. All later steps keep one page per site, so the other
    copies are only counted: `page_copies` is the number of rows the plain join has
    for the staged row.
    """
    found = _site_pages(scraped, page_order)
    order = [c for c in found.columns if c.startswith("_order_")]
    copies = found.groupBy("site").agg(F.count(F.lit(1)).alias("page_copies"))
    first = dedupe_first(found, ["site"], order).join(copies, "site")
    sited = usable_companies(staged).withColumn("site", F.trim("website"))
    return split_join(sited, first, "site").select(*CHAIN, "page_copies")


def company_page_texts(companies: DataFrame, scraped: DataFrame, page_order: Sequence[str]) -> DataFrame:
    """Usable companies with every usable page of their site, whole, one row per company and page.

    The join before any row is dropped holds no other texts than these: a site with m scrapes
    gives m rows here for each of its companies. Companies alike in all columns count once, and
    only those count whose very website was scraped, as in `stage_companies`.
    """
    staged = companies.join(scraped.select("website"), "website", "left_semi")
    firms = usable_companies(staged).select(*COMPANY).distinct().withColumn("site", F.trim("website"))
    found = _site_pages(scraped, page_order)
    named = [F.col(f"_order_{i}").alias(f"order_{c}") for i, c in enumerate(page_order)]
    return split_join(firms, found, "site").select(*COMPANY, "scrappedDate", "SCRAPPEDDATA", *named)


def prompts(chain: DataFrame) -> DataFrame:
    """(UID, json, prompt) of every row, the page text included; kept, so that numbers and prompts stay together."""
    rows = chain.select("UID", row_json(CHAIN).alias("json"))
    return keep(rows.withColumn("prompt", persona_prompt(F.col("json"))))


def company_chain(companies: DataFrame, scraped: DataFrame, page_order: Sequence[str]) -> DataFrame:
    """One row per website: its first staged company with the first page of the site.

    First-per-key commutes with this join, since companies and pages are filtered
    and ordered each by themselves. Deduplicating both sides before the join means
    no site ever multiplies its rows. The two counters are 1 throughout.
    """
    staged = stage_companies(companies, scraped, page_order)
    first_company = dedupe_first(usable_companies(staged), ["website"], ["UID"], "RowNumCounter")
    found = _site_pages(scraped, page_order)
    first_page = dedupe_first(found, ["site"], [c for c in found.columns if c.startswith("_order_")])
    joined = split_join(first_company.withColumn("site", F.trim("website")), first_page, "site")
    return joined.select(*CHAIN, "RowNumCounter", F.lit(1).cast("long").alias("RowNum"))


def personas(
    chain: DataFrame, fn: Callable[[str], str] | None = None, on_error: str = "value"
) -> DataFrame:
    """(UID, persona) from every row's JSON through the persona prompt, kept as told."""
    asked = chain.select("UID", persona_prompt(row_json(CHAIN)).alias("prompt"))
    return keep(enrich(asked, "prompt", "persona", fn, on_error).select("UID", "persona"))
