import random

import pytest
from .brute import cut_repeats
from pyspark.sql import functions as F

from siteweave.llm.substrings import WINDOW_WORDS, remove_repeats, repeated_spans


def check(docs, texts, n):
    rows = {r.row.doc_id: r for r in remove_repeats(docs, n=n).collect()}
    for i, (count, left) in enumerate(cut_repeats(texts, n)):
        assert (rows[i].n_words, rows[i].n_removed, rows[i].kept_text) == (count, count - len(left), " ".join(left)), i


def passages(draw, prose, n, pool):
    """Texts with shared passages of lengths around n at random places."""
    shared = [prose(900 + k, n + draw.randrange(-2, n), pool) for k in range(6)]
    texts = []
    for i in range(60):
        parts = [prose(i, draw.randrange(0, 2 * n), pool)]
        for _ in range(draw.randrange(3)):
            parts += [draw.choice(shared), prose(1000 + 7 * i + len(parts), draw.randrange(0, n), pool)]
        texts.append(draw.choice([" ", "\n", "\t "]).join(parts))
    return texts


@pytest.mark.parametrize("n", [2, 3, 5, 8, 9, 16, WINDOW_WORDS])
@pytest.mark.parametrize("pool", [3, 5000])
def test_same_as_brute_force(make_docs, prose, n, pool):
    draw = random.Random(n)
    texts = passages(draw, prose, n, pool)
    texts += [None, "", " \n", "a", "a a a a a a a a a a a a", "b " * (2 * n), texts[0], "é" + texts[1]]
    check(make_docs(texts).repartition(4), texts, n)


def test_windows_at_the_borders(make_docs, prose):
    a, b = prose(1, WINDOW_WORDS), prose(2, WINDOW_WORDS)
    shorter = " ".join(a.split()[1:])
    texts = [a, a + " x", "y " + a, shorter, "z " + shorter, b, b + " " + b]
    check(make_docs(texts), texts, WINDOW_WORDS)


def test_a_very_common_passage_and_a_long_text(make_docs, prose):
    common = prose(5, 60)
    texts = [f"{prose(i, 20)} {common} {prose(2000 + i, 15)}" for i in range(600)]
    texts.append(" ".join(prose(9000 + k, 5000) for k in range(12)) + " " + common)
    check(make_docs(texts).repartition(7), texts, WINDOW_WORDS)


def test_odd_rows(make_docs, prose):
    text = prose(3, 50)
    docs = make_docs([(None, text), (4, text), (4, None)]).withColumns(
        {c: F.lit("own") for c in ("n_words", "n_removed", "kept_text", "key", "spans", "row")}
    )
    out = remove_repeats(docs)
    assert sorted((str(r.row.doc_id), r.n_words, r.n_removed, r.row.n_words) for r in out.collect()) == [
        ("4", 0, 0, "own"),
        ("4", 50, 50, "own"),
        ("None", 50, 50, "own"),
    ]
    assert remove_repeats(make_docs([])).count() == 0
    assert repeated_spans(make_docs([])).count() == 0


def test_a_window_of_one_word_is_refused(make_docs):
    with pytest.raises(ValueError):
        repeated_spans(make_docs(["a"]), n=1)
