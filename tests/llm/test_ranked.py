"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from siteweave.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(A_TO_Z))


def expected(docs, items, k=10):
    counts = [(id_, Counter(terms(text))) for id_, text in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for id_, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms if n_terms else 0
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, id_ is None, id_ or 0, id_))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def asked(llm, docs, items):
    d = llm.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = llm.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in ranked.rank_documents(d, i).collect()), key=repr)


def corpus(seed, n, pool=60):
    draw = random.Random(seed)
    word = lambda: f"w{min(int(draw.expovariate(0.1)), pool)}"
    return [(i, " ".join(word() for _ in range(draw.randrange(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("short", [0, 8, 10**9])
def test_all_scores(llm, monkeypatch, short):
    monkeypatch.setattr(ranked, "SHORT_LIST", short)
    monkeypatch.setattr(ranked, "RANGE_DOCS", 64)
    docs = corpus(1, 400)
    items = [(i, " ".join(f"w{random.Random(i).randrange(61)}" for _ in range(1 + i % 9))) for i in range(25)]
    assert asked(llm, docs, items) == expected(docs, items)


def test_several_passes_and_blocks(llm, monkeypatch):
    monkeypatch.setattr(ranked, "ITEMS_AT_ONCE", 2)
    monkeypatch.setattr(ranked, "BLOCK_DOCS", 16)
    monkeypatch.setattr(ranked, "_TEXT_BYTES", 1000)
    docs, items = corpus(2, 120), [(i, f"w{i} w{i + 3} w1") for i in range(5)]
    assert asked(llm, docs, items) == expected(docs, items)


def test_special_rows(llm):
    long = "É" + "a" * 70_000
    docs = [(1, None), (2, ""), (3, "..."), (None, "Foo bar"), (4, "foo BAR"), (4, "foo bar"), (5, f"{long} foo2 x"), (6, "ÀB c")]
    docs += [(7, "bar " * 3000)]
    items = [(1, "FOO foo bar"), (2, None), (3, "nothing"), (4, long), (None, "àb ÀB"), (1, "foo2"), (1, "foo2")]
    got = asked(llm, docs, items)
    assert got == expected(docs, items)
    assert (None, 1, 6) in [r[:3] for r in got] and [r for r in got if r[0] == 4][0][2] == 5


def test_empty_tables_and_clashing_columns(llm):
    docs, items = corpus(3, 30), [(0, "w1 w2")]
    assert asked(llm, docs, []) == [] and asked(llm, [], items) == []
    assert asked(llm, [(1, None)], items) == []
    d = llm.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score long, terms string")
    i = llm.createDataFrame([(*r, 2) for r in items], "item_id long, text string, rank long")
    assert sorted((tuple(r) for r in ranked.rank_documents(d, i).collect()), key=repr) == expected(docs, items)


def test_skipping_leaves_nothing_out():
    draw = np.random.default_rng(5)
    for case in range(200):
        n = 300
        lists = []
        for size in draw.integers(1, n, 6):
            documents = np.sort(draw.choice(n, size, replace=False))
            scores = draw.integers(0, 50, size)
            lists.append((documents, scores, int(scores.max())))
        total = np.zeros(n, np.int64)
        for documents, scores, _ in lists:
            total[documents] += scores
        least = int(draw.integers(1, max(2, total.max() + 5)))
        found, scores = ranked.score_range(lists, n, least)
        assert found.tolist() == np.flatnonzero(total >= least).tolist(), case
        assert scores.tolist() == total[found].tolist()
