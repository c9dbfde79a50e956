import random
import re

import pytest

from siteweave.llm.queries import URL_RULES
from siteweave.llm.url_rules import filter_urls

PAGES = "page_id long, url string, verdict string, rule string"


def judge(url, rules, default="allow"):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def check(llm, urls, rules):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)]
    pages = llm.createDataFrame(rows, PAGES)
    frame = llm.createDataFrame(rules, "host string, path string, verdict string")
    got = {r[0]: tuple(r)[1:] for r in filter_urls(pages, frame).collect()}
    assert got == {i: judge(u, [r for r in rules if None not in r]) for i, u in enumerate(urls)}


TRAPS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http://EXAMPLE.com/en/x",
    "http://example.com",
    "http://example.com/",
    "http://www.example.com/en/",
    "http://www.example.com/en",
    "http://a.www.example.com/en/q?x=://net/es/",
    "http://notexample.com/en/",
    "http://x.net/es/a#f",
    "http://x.net?/es/",
    "http://x.net#/fr/",
    "http://net/fr/",
    "http://.com/",
    "http://com./",
    "http://a..com//en//",
    "http://ÄÖ.com/é",
    "http://a\nb.com/x\ny/",
    "http://" + "a." * 3000 + "com/" + "en/" * 3000,
    "http://example.com/en/x",
    "http://example.com/en/x",
]


def test_rules_of_the_query(llm):
    check(llm, TRAPS, URL_RULES)


def test_rules_that_end_inside_names(llm):
    rules = [
        ("example.com", "", "block"),
        ("example.com", "/en", "allow"),
        ("example.com", "/en", "block"),
        ("com", "/en/longer/path", "allow"),
        ("b.example.com", "/e", "allow"),
        ("Example.Com", "/en/X", "block"),
        ("", "/en", "block"),
        (None, "/", "block"),
    ]
    urls = [*TRAPS, "http://example.com/english", "http://b.example.com/en/longer/path", "http://example.com/en/X"]
    check(llm, urls, [(h and h.lower(), p, v) for h, p, v in rules])


def test_random_rules(llm):
    draw = random.Random(3)
    name = lambda: ".".join(draw.choice(["a", "b", "ab", "com"]) for _ in range(draw.randrange(1, 4)))
    path = lambda: "".join(draw.choice(["/", "/a", "/ab", "a"]) for _ in range(draw.randrange(4)))
    rules = [(name(), "/" + path(), draw.choice(["allow", "block"])) for _ in range(60)]
    urls = [f"http://{name()}/{path()}{draw.choice(['', '?q', '#f/a'])}" for _ in range(400)]
    check(llm, urls, rules)


def test_no_rules_and_no_pages(llm):
    rules = llm.createDataFrame([], "host string, path string, verdict string")
    pages = llm.createDataFrame([(1, "http://a.com/", "", "")], PAGES)
    assert [tuple(r) for r in filter_urls(pages, rules, default="block").collect()] == [(1, "a.com", "/", None, "block")]
    rules = llm.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert filter_urls(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("id_", [None, 5])
def test_rows_without_id_and_repeated_rows_stay(llm, id_):
    rules = llm.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = llm.createDataFrame([(id_, "http://x.net/es/", "", "")] * 3, PAGES)
    assert [tuple(r) for r in filter_urls(pages, rules).collect()] == [(id_, "x.net", "/es/", "net/es/", "block")] * 3
