"""Removal of repeated byte strings against a dictionary of all strings."""

import random

import numpy as np
import pytest

from siteweave.llm import columnwise


def expected(rows, n):
    whole = [((10**18 if id_ is None else id_), (text or "").encode()) for id_, text in rows]
    first = {}
    for id_, raw in whole:
        for s in range(len(raw) - n + 1):
            key = raw[s : s + n]
            first[key] = min(first.get(key, (id_, s)), (id_, s))
    out = []
    for (id_, _), (order, raw) in zip(rows, whole, strict=True):
        gone = bytearray(len(raw))
        for s in range(len(raw) - n + 1):
            if (order, s) > first[raw[s : s + n]]:
                gone[s : s + n] = b"\1" * n
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((id_, len(raw), sum(gone), spans, kept))
    return sorted(out, key=repr)


def removed(llm, rows, n=100, parts=3):
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    cut = columnwise.remove_repeated_strings(docs, n=n)
    rows = cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return [(*r[:4], bytes(r[4])) for r in rows]


def same(got, want):
    assert sorted(got, key=repr) == want


def corpus(seed, count):
    draw = random.Random(seed)
    passages = [" ".join(f"p{draw.randrange(10**6)}" for _ in range(draw.randrange(5, 40))) for _ in range(6)]
    rows = []
    for i in range(count):
        text = " ".join(f"w{draw.randrange(10**6)}" for _ in range(draw.randrange(0, 60)))
        for _ in range(draw.randrange(0, 3)):
            at = draw.randrange(len(text) + 1)
            text = text[:at] + draw.choice(passages) + text[at:]
        rows.append((i, text))
    return rows + [(count + k, rows[3][1]) for k in range(5)] + [(count + 9, rows[4][1] * 3)]


def test_against_all_strings(llm):
    rows = corpus(1, 60)
    same(removed(llm, rows), expected(rows, 100))


def test_small_units_segments_and_collections(llm, monkeypatch):
    monkeypatch.setattr(columnwise, "UNIT_BYTES", 700)
    monkeypatch.setattr(columnwise, "SEGMENT", 150)
    monkeypatch.setattr(columnwise, "COLLECTION_BYTES", 300)
    rows = corpus(2, 30)
    same(removed(llm, rows, n=40), expected(rows, 40))


def test_frequent_runs_come_last(llm, monkeypatch):
    monkeypatch.setattr(columnwise, "SAMPLE_ONE_OF", 1)
    monkeypatch.setattr(columnwise, "SAMPLE_LEAST", 3)
    rows = corpus(3, 40)
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    assert len(columnwise.frequent_runs(docs, 10_000))
    same(removed(llm, rows, n=60), expected(rows, 60))


@pytest.mark.parametrize("unit", [300, 4 << 20])
def test_special_rows(llm, monkeypatch, unit):
    monkeypatch.setattr(columnwise, "UNIT_BYTES", unit)
    rows = [(1, None), (2, ""), (3, "a" * 500), (4, "ab" * 90), (5, "a" * 99), (6, "é" * 70), (7, "xé" + "é" * 70)]
    long = "".join(chr(97 + random.Random(4).randrange(26)) for _ in range(250))
    rows += [(None, long), (8, long), (8, long), (9, "start " + long), (9, "other" + long), (9, long), (None, "x" + long)]
    rows += [(10, "日本語" * 40), (11, "本語日" * 40)]
    same(removed(llm, rows), expected(rows, 100))


def test_long_text(llm):
    draw = random.Random(7)
    long = "".join(draw.choice("abcdef gh") for _ in range(columnwise.SEGMENT + 5000))
    rows = [(1, long), (2, long[columnwise.SEGMENT - 300 : columnwise.SEGMENT + 400])]
    got = {r[0]: r for r in removed(llm, rows)}
    assert got[1][2] == 0 and got[1][4] == long.encode() and got[2][2] == 700 and got[2][3] == 1


def test_empty_table_and_clashing_columns(llm):
    assert removed(llm, []) == []
    rows = corpus(5, 12)
    docs = llm.createDataFrame([(*r, 1, "k", 2) for r in rows], "doc_id long, text string, unit long, key string, doc long")
    cut = columnwise.remove_repeated_strings(docs)
    same([(*r[:4], bytes(r[4])) for r in cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()], expected(rows, 100))
    assert cut.select("row.*").columns == docs.columns


def test_rounds_of_a_collection():
    draw = np.random.default_rng(3)
    for _ in range(60):
        n, columns, pieces = 4, 9, 40
        letters = draw.integers(97, 99, (columns, pieces)).astype(np.uint8)
        first = draw.integers(0, columns - n + 1, pieces)
        count = np.array([draw.integers(1, columns - n - f + 2) for f in first])
        place = draw.permutation(pieces)
        got = columnwise.repeated_strings(first, count, letters, place, n)
        for c in range(columns - n + 1):
            strings = {p: letters[c : c + n, p].tobytes() for p in range(pieces) if first[p] <= c < first[p] + count[p]}
            for p in range(pieces):
                want = p in strings and any(strings[q] == strings[p] and place[q] < place[p] for q in strings)
                assert got[c, p] == want
