import math
import random
import re

from pyspark.sql import functions as F

from siteweave.llm import licenses
from siteweave.llm.queries import op5_licenses  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda c: c[0].lower(), text or "")


def base(text):
    w = WORD.findall(lower(text))
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), sorted(places)


def scan(docs):
    return {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}


def test_every_place_of_a_phrase(make_docs, prose):
    draw = random.Random(5)
    pool = "mit license apache general public the MIT-License Apache: License É license\nmit ELIGENSE".split(" ")
    texts = [" ".join(draw.choice(pool) for _ in range(draw.randrange(60))) for _ in range(200)]
    texts += [None, "", " -- ", "MIT  License", "mit.license", "mitlicense", "ΜIT license", prose(1, 5000) + " mit license"]
    rows = scan(make_docs(texts).repartition(4))
    for i, text in enumerate(texts):
        n, places = base(text)
        assert rows[i].n_words == n
        assert sorted((m.start, m.label) for m in rows[i].matches if m.kind == "phrase") == places


def test_templates_need_their_key_phrases(make_docs):
    text, (must, *_) = licenses.TEMPLATES["bsd"]
    without = text.replace("source and binary", "source or binary")
    texts = [f"x y {text.upper()} z", text[len("redistribution and ") :], without, "Licensed under CC BY-NC 4.0.", "the and of in to " * 200]
    rows = scan(make_docs(texts))
    labels = [[(m.label, m.kind, m.start) for m in rows[i].matches] for i in range(len(texts))]
    assert labels[0] == [("bsd", "template", 2)]
    assert labels[1] == [] and labels[2] == []
    assert labels[3] == [("cc-by-nc", "template", 0)]
    assert labels[4] == []
    assert must in text


def test_a_notice_with_a_few_other_words(make_docs):
    text, _ = licenses.TEMPLATES["gpl"]
    changed = text.replace("this program is free software", "our tool is free software maybe").replace("maybe ", "")
    (row,) = scan(make_docs([changed])).values()
    found = {(m.label, m.kind) for m in row.matches}
    assert found == {("gpl", "phrase"), ("gpl", "template")}
    assert all(0 < m.score <= 1 for m in row.matches)


def test_frequencies_count_all_documents(make_docs):
    docs = make_docs(["mit mit", "MIT license", None, "license", "x"]).repartition(3)
    assert licenses.word_frequencies(docs, ["license", "mit", "none"]) == (5, {"license": 2, "mit": 2, "none": 0})


def test_odd_rows(make_docs):
    docs = make_docs([(None, "mit license"), (1, "mit license"), (1, "mit license")])
    docs = docs.withColumn("n_words", F.lit("clash")).withColumn("matches", F.lit("clash"))
    rows = licenses.scan_licenses(docs).collect()
    assert sorted((r.doc_id is None, r.n_words, len(r.matches)) for r in rows) == [(False, 2, 1)] * 2 + [(True, 2, 1)]
    assert licenses.scan_licenses(make_docs([])).count() == 0


def template_places(texts, templates, least_share=licenses.LEAST_SHARE):
    """(text, label, start) of every template, by trying every start."""
    files = [WORD.findall(lower(t)) for t in texts]
    of = {w: sum(w in f for f in files) for text, _ in templates.values() for w in text.split()}
    weight = {w: math.log((len(files) + 1) / (n + 0.5)) for w, n in of.items()}
    found = set()
    for i, file in enumerate(files):
        for label, (text, musts) in templates.items():
            notice = text.split()
            for start in range(1 - len(notice), len(file)):
                there = file[max(start, 0) : start + len(notice)]
                same = zip(notice[max(-start, 0) :], there, strict=False)
                share = sum(weight[w] for w, t in same if w == t) / sum(weight[w] for w in notice)
                inside = f" {' '.join(there)} "
                if share >= least_share and all(f" {m} " in inside for m in musts):
                    found.add((i, label, max(start, 0)))
    return found


def found_places(rows):
    return {(i, m.label, m.start) for i, r in rows.items() for m in r.matches if m.kind == "template"}


def test_all_notices_in_one_text(make_docs, prose):
    notices = [text for text, _ in licenses.TEMPLATES.values()]
    texts = [" ".join(notices), " ".join(notices[:6]), " ".join(reversed(notices)), prose(3, 400)]
    rows = scan(make_docs(texts))
    labels = [{m.label for m in rows[i].matches if m.kind == "template" and m.score > 0.999} for i in range(len(texts))]
    assert labels == [set(licenses.TEMPLATES), {"mit", "apache", "gpl", "bsd", "isc", "mpl"}, set(licenses.TEMPLATES), set()]


def test_every_place_of_a_template(make_docs):
    draw = random.Random(6)
    notices = [text.split() for text, _ in licenses.TEMPLATES.values()]
    pool = sorted({w for notice in notices for w in notice})
    texts = []
    for _ in range(60):
        parts = [[w if draw.random() < 0.85 else draw.choice(pool) for w in draw.choice(notices)] for _ in range(4)]
        texts.append(" ".join(w for part in parts for w in part[draw.choice([0, 0, 3]) :]))
    for templates in (licenses.TEMPLATES, {label: (text, ()) for label, (text, _) in licenses.TEMPLATES.items()}):
        rows = {r.doc_id: r for r in licenses.scan_licenses(make_docs(texts), templates=templates).collect()}
        want = template_places(texts, templates)
        assert found_places(rows) == want and len(want) > 60
