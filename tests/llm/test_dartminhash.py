import random

import numpy as np
import pytest
from .brute import multiset_similarity, smallest_reached
from pyspark.sql import functions as F

from siteweave.llm import dartminhash as d


def edited(text, draw, share):
    w = text.split()
    for _ in range(int(len(w) * share)):
        w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
    return " ".join(w)


def weights(bag):
    keys = np.array(sorted(bag), np.uint64)
    return keys, np.zeros(len(keys), np.int64), np.array([bag[int(k)] for k in keys], np.int64)


@pytest.mark.parametrize("pair", range(4))
def test_signatures_agree_as_often_as_texts_are_alike(pair):
    draw = random.Random(pair)
    a = {draw.getrandbits(63): draw.randrange(1, 6) for _ in range(300)}
    b = {k: max(1, n + draw.randrange(-2, 3)) for k, n in a.items() if draw.random() < 0.9}
    b |= {draw.getrandbits(63): draw.randrange(1, 6) for _ in range(30 * pair)}
    union = sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
    similarity = sum(min(n, b.get(k, 0)) for k, n in a.items()) / union
    x, y = (d.dart_signatures(*weights(bag), 1, 4000)[0] for bag in (a, b))
    assert abs((x == y).mean() - similarity) < 0.04
    assert (x != 0).all()


def test_signatures_of_short_and_empty_texts():
    hashes, texts = np.array([5, 5, 9], np.uint64), np.array([0, 2, 2])
    out = d.dart_signatures(hashes, texts, np.array([1, 1, 1]), 4, 96)
    assert (out[[1, 3]] == 0).all() and (out[[0, 2]] != 0).all()
    assert 0.3 < (out[0] == out[2]).mean() < 0.7
    assert d.dart_signatures(hashes[:0], texts[:0], texts[:0], 0).shape == (0, 96)


def classes(docs):
    return {r.doc_id: r for r in d.near_duplicate_classes(docs).collect()}


def test_same_classes_as_brute_force(make_docs, prose):
    draw = random.Random(11)
    texts = {}
    for g in range(12):
        first = prose(g, draw.randrange(60, 400))
        texts[100 * g] = first
        for k in range(1, 8):
            share = draw.choice([0.0, 0.005, 0.01, 0.02, 0.05, 0.2])
            texts[100 * g + k] = edited(draw.choice([t for i, t in texts.items() if i // 100 == g]), draw, share)
    texts |= {5000 + i: prose(500 + i, 80) for i in range(40)}
    texts |= {6000: "a b", 6001: "a b", 6002: "b a", 6003: "a b c d e", 6004: "x", 6005: "", 6006: "", 6007: None, 6008: " \n"}
    pairs = {}

    def linked(i, j):
        if (i // 100 != j // 100) and i < 6000:
            return False
        key = (i, j)
        if key not in pairs:
            pairs[key] = multiset_similarity(texts[i], texts[j]) >= 0.8
        return pairs[key]

    want = smallest_reached(sorted(texts), linked)
    got = classes(make_docs(list(texts.items())).repartition(6))
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i for i, r in got.items() if r.kept} == {i for i, c in want.items() if i == c}


def test_a_chain_is_one_class(make_docs, prose):
    w = prose(1, 400).split()
    texts = [" ".join([f"n{j}" for j in range(18 * i)] + w[18 * i :]) for i in range(12)]
    assert multiset_similarity(texts[0], texts[1]) >= 0.8 and multiset_similarity(texts[0], texts[11]) < 0.5
    assert {r.component_id for r in classes(make_docs(texts)).values()} == {0}


def test_a_large_group_of_near_copies(make_docs, prose):
    draw = random.Random(3)
    first = prose(77, 120)
    texts = [edited(first, draw, 0.01) for _ in range(700)] + [first] * 300 + [prose(1000 + i, 50) for i in range(50)]
    got = classes(make_docs(texts).repartition(8))
    assert {r.component_id for i, r in got.items() if i < 1000} == {0}
    assert sum(r.kept for r in got.values()) == 51


def test_odd_rows(make_docs, prose):
    text = prose(9, 50)
    rows = [(None, text), (5, text), (5, text), (None, "lone words here now ok"), (None, "lone words here now ok"), (8, None), (8, None)]
    docs = make_docs(rows).withColumns({c: F.lit("clash") for c in ("key", "bands", "kept", "slot", "class", "row", "tag")})
    out = d.near_duplicate_classes(docs).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == sorted(
        [("None", "5", False), ("5", "5", True), ("5", "5", False), ("None", "None", True), ("None", "None", False), ("8", "8", True), ("8", "8", True)]
    )
    kept = d.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == sorted(
        [("5", text), ("None", "lone words here now ok"), ("8", None), ("8", None)], key=lambda x: (x[0], x[1] or "")
    )
    assert d.near_duplicate_classes(make_docs([])).count() == 0
    assert d.drop_near_duplicates(make_docs([])).count() == 0


def test_only_one_row_of_each_class_stays(make_docs, prose):
    draw = random.Random(4)
    rows = [(10 * g + k, edited(prose(g, 150), draw, 0.005)) for g in range(20) for k in range(5)]
    docs = make_docs(rows)
    want = sorted(r.doc_id for r in d.near_duplicate_classes(docs).collect() if r.kept)
    assert sorted(r.doc_id for r in d.drop_near_duplicates(docs).collect()) == want == [10 * g for g in range(20)]
