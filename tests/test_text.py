"""Column helpers against Python's own text functions."""

import html
import os
import re
import subprocess
import sys
import time
from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siteweave import functions as fn
from siteweave.operators.enrich import enrich


def apply(spark, col, values, kind="string"):
    """The column over the values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(col).collect()]


@pytest.fixture(scope="module")
def c(spark):
    return F.col("c")


def test_truthiness(spark, c):
    assert apply(spark, fn.has_number(c), [None, 0, 5], "int") == [False, False, True]
    assert apply(spark, fn.has_text(c), [None, "", " "]) == [False, False, True]
    assert apply(spark, fn.has_items(c), [None, [], [1]], "array<int>") == [False, False, True]
    assert apply(spark, fn.default_if_falsy(fn.has_number(c), c, 0), [None, 0, 5], "int") == [0, 0, 5]


def test_dates(spark, c):
    seconds = [0, 1, 86399, 946684799, 946684800, -1, 4102444800]
    years = apply(spark, fn.utc_year(c), seconds, "long")
    assert years == [1970, 1970, 1970, 1999, 2000, 1969, 2100]
    stamps = apply(spark, fn.iso_stamp(fn.epoch_timestamp(c)), seconds, "long")
    assert stamps[:2] == ["1970-01-01T00:00:00", "1970-01-01T00:00:01"]


def test_year_is_utc_in_any_session_zone(spark, c):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert apply(spark, fn.utc_year(c), [946684800], "long") == [2000]
        assert apply(spark, fn.iso_stamp(fn.epoch_timestamp(c)), [946684800], "long") == ["2000-01-01T00:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_codes(spark, c):
    assert apply(spark, fn.code_name(c), [0, 14, 15, 99, -1, None], "int") == ["main_game", "update", None, None, None, None]


def test_labels(spark, c):
    assert apply(spark, fn.tag_label(c), ["B-ORG", "I-PRODUCT", "B-PER", "MISC"]) == ["Company", "Product", "Per", "Misc"]
    props = [{"name": "n", "title": "t"}, {"name": "", "title": "t"}, {"id": "5"}, {}]
    assert apply(spark, fn.display_label(c, F.lit("L")), props, "map<string,string>") == ["n", "t", "5", "L"]
    assert apply(spark, fn.display_label(c, F.lit("")), [{}], "map<string,string>") == ["Node"]
    assert apply(spark, fn.tooltip(c), [{"b": "2", "a": "1"}, {}], "map<string,string>") == ["a: 1<br>b: 2", ""]


def test_urls_and_json(spark, c):
    assert apply(spark, fn.thumb_url(c), ["u/{width}x{height}?{width}", "plain"]) == ["u/150x200?150", "plain"]
    blobs = apply(spark, fn.json_object(c), ['{"a": 1, "b": {"c": 2}}', "[1]", "{", "text", "", None, "3"])
    assert blobs == [{"a": "1", "b": '{"c":2}'}, None, None, None, None, None, None]


def test_fetch_status(spark, c):
    texts = [None, "x", "an HTTP Error 5", "Request Error: y", "HTTP Error and Request Error", "http error"]
    assert apply(spark, fn.fetch_status(c), texts) == ["missing", "ok", "http_error", "request_error", "http_error", "ok"]


def test_html_to_text(spark, c):
    pages = {
        '<!DOCTYPE html><p class="a>b">x</p><P>y</P>': "xy",
        "a<!-- <script src=x> --> visible text": "a visible text",
        "<p title='a>b' id=\"c>d\">hello</p><p title=\"open>end": "helloend",
        "a<template id=t><b>hidden</b></template>b<script>x<!-- </script>c": "abc",
        "&#0000000065;&#x00000042;&#0;&#99999999;": "AB&#0;&#99999999;",
        "<script>var t='</p>';</script><STYLE a=1>p{}</STYLE>z<!-- <p>no --> &lt;b&gt;": "z <b>",
        "a < b &amp;lt; c &#65;&#x42;&#x1F600; &bogus; &": "a < b &lt; c AB\U0001f600 &bogus; &",
        "text<script>never closed": "text",
        "one<br/>two</div>": "onetwo",
        "caf&eacute; &nbsp;|&copy;": "café  |©",
    }
    assert apply(spark, fn.html_to_text(c), list(pages)) == list(pages.values())


def test_html_to_text_behind_the_last_tag(spark, c):
    pages = {
        "a <b c": "a <b c",
        "<p>a</p> <b \"c": "a <b \"c",
        "<p>a</p> 1 < 2 <!-- rest <b": "a 1 < 2 ",
        "<p>a<!-- x> <b": "a",
        "a<script>b</p> <b c": "a",
        "a<script>b</script> <b c": "a <b c",
        "<a '><b c=\"d\">x<i \">y": "xy",
        "": "",
    }
    assert apply(spark, fn.html_to_text(c), list(pages)) == list(pages.values())


def test_html_to_text_takes_time_in_proportion(spark, c):
    n = 1_000_000
    units = ['<a "', "<a ", "<!-- <a ", "<script ", "<a '>", "<a \"'>", "</script ", "<script><a ", "<", "<a \"x\" ", "&amp <", "<a \">x'"]
    pages = [(u * (n // len(u)))[:n] for u in units] + ["<p>" + u * (n // len(u)) + e for u in units[:4] for e in (">", "'>", '">')]
    begun = time.time()
    texts = apply(spark, F.length(fn.html_to_text(c)), pages)
    assert time.time() - begun < 60 and texts[:2] == [len(p) for p in pages[:2]]


class _Seen(HTMLParser):
    """What a page shows, by Python's parser; it knows no templates, and gives references decoded."""

    def __init__(self):
        super().__init__()
        self.text, self.hidden = [], None

    def handle_starttag(self, tag, attrs):
        self.hidden = tag if tag in ("script", "style") else self.hidden

    def handle_endtag(self, tag):
        self.hidden = None if tag == self.hidden else self.hidden

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


TEXT = st.lists(st.sampled_from(["word", " ", "é", "&amp;", "&lt;b&gt;", "1", "\n", "'", '"', "> "]), max_size=6).map("".join)
VALUE = st.sampled_from(["", " id=x", " title='a>b'", ' title="it\'s <b>"', " hidden", ' a="1" b=\'2\'', ' class = "c"'])
NAMES = st.sampled_from(["p", "B", "div", "h1", "a"])
HIDDEN = st.tuples(st.sampled_from(["script", "STYLE"]), VALUE, st.sampled_from(["", "var t='</p>';", "a<b", "<!-- x", "<p>"]))
PARTS = st.recursive(
    st.one_of(
        TEXT,
        HIDDEN.map(lambda x: f"<{x[0]}{x[1]}>{x[2]}</{x[0]}>"),
        st.sampled_from(["<br/>", "<!-- a <b> -->", "<!DOCTYPE html>", "<hr>", '<img src="x>y" />']),
    ),
    lambda inner: st.tuples(NAMES, VALUE, st.lists(inner, max_size=4)).map(lambda x: f"<{x[0]}{x[1]}>{''.join(x[2])}</{x[0]}>"),
    max_leaves=12,
)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PARTS, max_size=4).map("".join), min_size=1, max_size=30))
def test_html_to_text_is_pythons_parser(spark, c, pages):
    want = []
    for page in pages:
        seen = _Seen()
        seen.feed(page)
        seen.close()
        want.append("".join(seen.text))
    assert apply(spark, fn.html_to_text(c), pages) == want


SLOW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
LISTS = st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=12), min_size=1, max_size=40)


@SLOW
@given(LISTS)
def test_strip_is_pythons_strip(spark, c, texts):
    padded = [f" \t {t} \n" for t in texts]
    assert apply(spark, fn.strip_text(c), padded) == [t.strip() for t in padded]


@SLOW
@given(st.lists(st.lists(st.sampled_from(["&amp;", "&lt;", "&#48;", "&#x41;", "&", ";", "a", "#", " ", "&eacute;", "&quot;"]), max_size=12).map("".join), min_size=1, max_size=40))
def test_entities_are_pythons(spark, c, texts):
    # Python also decodes some names without their semicolon; ours asks for it.
    texts = [t for t in texts if not re.search(r"&(#x?)?[0-9A-Za-z]*(?![0-9A-Za-z;])", t.replace("&amp;", "").replace("&lt;", ""))]
    texts.append("")
    assert apply(spark, fn.decode_entities(c), texts) == [html.unescape(t) for t in texts]


@SLOW
@given(st.lists(st.lists(st.sampled_from(["game", "GAME", "_", " ", "é", "has_genre", "Has_Genre", "-", "name", "1", "́"]), max_size=9).map("".join), min_size=1, max_size=40))
def test_canonical_case_is_whole_word_replacement(spark, c, texts):
    kinds = {"labels": ["Game"], "rels": ["HAS_GENRE"], "props": ["name"]}

    def replaced(text):
        for names in kinds.values():
            for name in names:
                text = re.sub(rf"\b{re.escape(name)}\b", name, text, flags=re.IGNORECASE)
        return text

    assert apply(spark, fn.canonical_case(c, **kinds), texts) == [replaced(t) for t in texts]


def test_canonical_case_prefers_the_last_kind(spark, c):
    assert apply(spark, fn.canonical_case(c, labels=["Name"], props=["name"]), ["NAME it"]) == ["name it"]
    assert apply(spark, fn.canonical_case(c), ["As it is"]) == ["As it is"]


def test_schema_tokens(spark, c):
    tokens = fn.schema_tokens(c)
    text = ["Game -[:HAS_GENRE]-> Genre\nGame -[:IS]-> :Thing g.name g.name .x1"]
    assert apply(spark, tokens["rels"], text) == [["HAS_GENRE", "IS"]]
    assert apply(spark, tokens["labels"], text) == [["HAS_GENRE", "IS", "Thing"]]
    assert apply(spark, tokens["props"], text) == [["name", "x1"]]


def test_prompts(spark, c):
    assert apply(spark, fn.company_prompt(c), ["50% Off"]) == ["Give me a 500 character summary about the 50% Off game company."]
    assert apply(spark, fn.site_prompt(fn.first_chars(c, 3)), ["abcdef"]) == ["Summarize this webpage in 300 max characters:\nabc"]


def test_lists(spark, c):
    assert apply(spark, fn.first_or(c, 0), [[3, 4], [], None], "array<int>") == [3, 0, 0]
    assert apply(spark, fn.text_or(c["url"]), [("u",), (None,), None], "struct<url: string>") == ["u", "", ""]


def test_enrich_policies(spark, c, rows):
    df = spark.createDataFrame([(1, " ab "), (2, ""), (3, None)], "i int, t string")

    def fails_on_empty(text):
        if not text:
            raise ValueError("empty")
        return text * 2

    stored = enrich(df, "t", "out", fails_on_empty)
    assert rows(stored, "i", "out") == [(1, "ab  ab"), (2, "Error: empty"), (3, None)]
    skipped = enrich(df, "t", "out", fails_on_empty, on_error="skip")
    assert rows(skipped, "i", "out") == [(1, "ab  ab"), (3, None)]
    with pytest.raises(ValueError):
        enrich(df, "t", "out", on_error="ignore")


def test_workers_need_not_have_the_package(tmp_path):
    """A driver that found the package by its own path only, started elsewhere."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from siteweave.session import get_session\n"
        "from siteweave.operators.enrich import enrich\n"
        "df = get_session('elsewhere', 2, 2).createDataFrame([('a b',)], 't string')\n"
        "print(enrich(df, 't', 'o').first().o, flush=True)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "3 characters, 2 words" in done.stdout, done.stderr[-2000:]


def test_enrich_calls_once_per_row(spark, c):
    calls = spark.sparkContext.accumulator(0)

    def counted(text):
        calls.add(1)
        return text

    df = spark.createDataFrame([(str(i),) for i in range(20)], "t string")
    assert enrich(df, "t", "out", counted, on_error="skip").count() == 20
    assert calls.value == 20
