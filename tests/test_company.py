"""The company chain on hand-made rows."""

import json
from datetime import datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from siteweave.operators.filters import country_view
from siteweave.plans.company import CHAIN, COMPANY, company_chain, company_pages, personas, stage_companies
from siteweave.plans.company import company_page_texts, prompts
from siteweave.session import new_table_path
from siteweave.sources import append_new

ORDER = ["createdate", "page"]


def firm(website, industry="games", country="US", name="n"):
    return (website, "h", name, "t", industry, "s", "1990", country, "c", "st")


def companies(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COMPANY))


def scraped(spark, *rows):
    full = [(w, datetime(2024, 1, 1 + i), t, i) for i, (w, t) in enumerate(rows)]
    return spark.createDataFrame(full, "website string, createdate timestamp_ntz, scrappeddata string, page int")


def test_site_scraped_three_times(spark):
    firms, pages = companies(spark, firm("a.com")), scraped(spark, ("a.com", "x"), ("a.com", "y"), ("a.com", "z"))
    staged = stage_companies(firms, pages, ORDER)
    assert sorted(r.UID for r in staged.collect()) == [1, 2, 3]
    first = company_pages(staged, pages, ORDER).collect()
    assert [(r.SCRAPPEDDATA, r.page_copies) for r in first] == [("x", 3)] * 3  # nine rows in all
    (row,) = company_chain(firms, pages, ORDER).collect()
    assert (row.UID, row.SCRAPPEDDATA, row.RowNumCounter, row.RowNum) == (1, "x", 1, 1)


def test_all_page_texts_of_a_site(spark):
    firms = companies(spark, firm("a.com"), firm("a.com"), firm("a.com ", name="other"), firm("b.com"), firm("c.com", "automotive"))
    texts = ["x", "y", "HTTP Error", None, "z"]
    pages = scraped(spark, *[("a.com", t) for t in texts], ("a.com ", "x"), ("c.com", "c"))
    out = company_page_texts(firms, pages, ORDER).collect()
    want = [(n, t, p) for n in ("n", "other") for t, p in [("x", 0), ("y", 1), ("z", 4), ("x", 5)]]
    assert sorted((r.name, r.SCRAPPEDDATA, r.order_page) for r in out) == sorted(want)


def test_prompts_hold_the_page_text(spark):
    firms, pages = companies(spark, firm("a.com")), scraped(spark, ("a.com", 'all "the" text'))
    (row,) = prompts(company_chain(firms, pages, ORDER)).collect()
    told = json.loads(row.json)
    assert set(told) == set(CHAIN) and told["SCRAPPEDDATA"] == 'all "the" text' and row.json in row.prompt


def test_trimmed_join_and_exact_staging(spark):
    firms = companies(spark, firm("a.com"), firm("a.com ", name="other"), firm("b.com"))
    pages = scraped(spark, ("a.com ", "late"), ("a.com", "text"))
    out = {r.website: r for r in company_chain(firms, pages, ORDER).collect()}
    assert set(out) == {"a.com", "a.com "}  # b.com was never scraped
    assert out["a.com"].SCRAPPEDDATA == out["a.com "].SCRAPPEDDATA == "late"


def test_filters(spark):
    sites = ["ok.com", "no.com", "car.com", "Car.com", "FaceBook.com", "my.linkedin.x", "err.com", "req.com", "empty.com"]
    industry = {"no.com": None, "car.com": "an automotive firm", "Car.com": "Automotive"}
    text = {"err.com": "HTTP Error 404", "req.com": "a Request Error", "empty.com": None, "ok.com": "http error"}
    firms = companies(spark, *[firm(s, industry.get(s, "games")) for s in sites])
    pages = scraped(spark, *[(s, text.get(s, "text")) for s in sites])
    assert sorted(r.website for r in company_chain(firms, pages, ORDER).collect()) == ["Car.com", "ok.com"]


def test_country_view(spark):
    firms = companies(spark, firm("a"), firm("b", country="DE"), firm("c", country=None))
    out = country_view(company_chain(firms, scraped(spark, ("a", "1"), ("b", "2"), ("c", "3")), ORDER))
    assert [r.website for r in out.collect()] == ["a"]


@pytest.mark.parametrize("copies", [1, 2])
def test_chain_equals_full_join_then_dedupe(spark, copies):
    """Brute force in Python over the full m*m join."""
    sites = ["a", "b", "b ", "c", "d"]
    firms = [firm(s, name=f"{s}{i}", industry=["games", "automotive"][i]) for s in sites for i in range(copies)]
    texts = ["HTTP Error", "one", "two"]
    scrapes = [(s, t) for s, t in product(sites[:4] + ["d "], texts)]
    staged = sorted(((f, p) for f in firms for p, (w, _) in enumerate(scrapes) if w == f[0]), key=lambda x: (x[0], x[1]))
    best = {}
    for uid, (f, _) in enumerate(staged, 1):
        for p, (w, t) in enumerate(scrapes):
            if "automotive" not in f[4] and w.strip() == f[0].strip() and "HTTP Error" not in t:
                best[f[0]] = min(best.get(f[0], (uid, p, t)), (uid, p, t))
    out = company_chain(companies(spark, *firms), scraped(spark, *scrapes), ORDER)
    got = {r.website: (r.UID, r.SCRAPPEDDATA) for r in out.collect()}
    assert got == {w: (u, t) for w, (u, _, t) in best.items()}


def test_chain_columns(spark):
    out = company_chain(companies(spark, firm("a")), scraped(spark, ("a", "x")), ORDER)
    assert out.columns == [*CHAIN, "RowNumCounter", "RowNum"]


def test_personas_hold_whole_rows(spark):
    chain = company_chain(companies(spark, firm("a")), scraped(spark, ("a", "x" * 5000)), ORDER)
    (told,) = personas(chain, fn=lambda prompt: prompt).collect()
    assert told.persona.startswith("Please parse the raw text") and "x" * 5000 in told.persona


def test_hot_site(spark):
    """A third of all scrapes are of one site; staged rows stay linear, numbers complete."""
    n = 3000
    pages = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id").cast("string"))).alias("website"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("createdate"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("scrappeddata"),
        F.col("id").alias("page"),
    )
    firms = pages.select("website").distinct().select("website", *[F.lit("x").alias(c) for c in COMPANY[1:]])
    staged = stage_companies(firms, pages, ORDER)
    uids = [r.UID for r in staged.select("UID").collect()]
    assert sorted(uids) == list(range(1, n + 1))
    out = company_chain(firms, pages, ORDER)
    assert out.count() == n - n // 3 + 1
    assert out.filter("website = 'hot'").first().SCRAPPEDDATA == "t0"


def test_nightly_rerun_adds_only_new_sites(spark, rows):
    path = new_table_path(spark, "clean")
    firms = companies(spark, firm("a"), firm("b"), firm("c"))
    nights = [[("a", "1"), ("b", "HTTP Error")], [("a", "1"), ("b", "HTTP Error"), ("b", "2"), ("a", "3")]]
    for scrapes in nights:
        append_new(company_chain(firms, scraped(spark, *scrapes), ORDER), path, "website")
    assert rows(spark.read.parquet(path), "website", "SCRAPPEDDATA") == [("a", "1"), ("b", "2")]


def test_pages_name_the_staged_rows_that_they_go_with(spark):
    """the numbered staged rows were left out of `company_pages`."""
    from siteweave.plans.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    paged = {r.website: r for r in QUERIES["company_pages"](spark, folder).collect()}
    staged = [r for r in QUERIES["stage_companies"](spark, folder).collect() if r.website in paged]
    for website, row in paged.items():
        uids = {r.UID for r in staged if r.website == website}
        assert uids == set(range(row.first_UID, row.last_UID + 1)) and len(uids) == row.staged_rows
