"""Token alignment against comparing all byte ranges of a document's tokens."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siteweave.llm import alignment

PATHS = alignment.tokenizer_paths()


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers(*PATHS)


def tokens(both, text):
    """((a ids, byte ranges), (b ids, byte ranges)) of a whole text; None if the bytes differ."""
    if not text:
        return None
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    out = []
    for ids, raw in ((a, both.bytes_a), (b, both.bytes_b)):
        if b"".join(raw[i] for i in ids) != (" " + text).encode():
            return None
        ends = np.cumsum([len(raw[i]) for i in ids]).tolist()
        out.append((ids, list(zip([0, *ends[:-1]], ends, strict=True))))
    return out


def expected(both, rows):
    split = [tokens(both, text) for _, text in rows]
    links = []
    for t in split:
        (a, at), (b, bt) = t or (([], []), ([], []))
        links.append([(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(at[i][0], bt[j][0]) < min(at[i][1], bt[j][1])])
    count = Counter(x for part in links for x in part)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (id_, _), t, own in zip(rows, split, links, strict=True):
        (a, at), (b, bt) = t or (([], []), ([], []))
        cuts = [0, *sorted({e for _, e in at} & {e for _, e in bt})]
        groups = [
            ",".join(str(i) for i, (s, e) in zip(a, at, strict=True) if s >= x and e <= y)
            + "|"
            + ",".join(str(i) for i, (s, e) in zip(b, bt, strict=True) if s >= x and e <= y)
            for x, y in zip(cuts, cuts[1:], strict=False)
        ]
        n_best = sum(count[x] == best[x[1]] for x in own)
        out.append((id_, len(a), len(b), len(groups), len(own), n_best, sum(count[x] for x in own), ";".join(groups)))
    return sorted(out, key=repr)


def aligned(llm, rows, parts=2):
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted((tuple(r) for r in alignment.align_documents(docs, *PATHS).collect()), key=repr)


ODD = ["a", "b", " ", "  ", "\n", "\t", "é", "日本", "▁", " ", "'s", "<|endoftext|>", "</s>", "🙂", "1", "́", "ﬁ", "\0", " "]


@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=12).map("".join).filter(bool))
@settings(max_examples=400, deadline=None)
def test_parts_give_the_tokens_of_the_text(both, text):
    assert both.splits
    parts = both.parts(text)
    assert "".join(parts) == " " + text
    a, b = both.encode(parts)
    assert sum(a, []) == both.a.encode(" " + text, add_special_tokens=False).ids
    if "▁" in text:  # reads as a blank, so that the bytes differ and the text has no tokens
        given_back = [b"".join(both.bytes_b[i] for i in ids) == p.encode() for p, ids in zip(parts, b, strict=True)]
        assert not all(given_back) and tokens(both, text) is None
    else:
        assert sum(b, []) == both.b.encode(text)


def test_containers_round_trip():
    draw = np.random.default_rng(1)
    for size in (1, 7, 16, 300, 4096):
        entries = np.unique(draw.integers(0, 40, 2000) * 10_000 + np.minimum(draw.integers(0, size, 2000), draw.integers(0, size, 2000)))
        row, place = entries // 10_000, entries % 10_000
        rows, places = alignment._places(alignment._containers(row, place, 42, size), size)
        assert sorted(zip(rows.tolist(), places.tolist(), strict=True)) == list(zip(row.tolist(), place.tolist(), strict=True))


@pytest.mark.parametrize("unit", [3, 4096])
def test_all_links(llm, both, monkeypatch, unit):
    monkeypatch.setattr(alignment, "UNIT_DOCS", unit)
    monkeypatch.setattr(alignment, "CACHED_PARTS", 50)
    monkeypatch.setattr(alignment, "_TEXT_BYTES", 500)
    draw = random.Random(unit)
    word = lambda: "".join(draw.choice(["the", "re", "tion", "è", "ing ", "zz", "Q", "7"]) for _ in range(draw.randrange(1, 5)))
    rows = [(i, " ".join(word() for _ in range(draw.randrange(1, 80)))) for i in range(40)]
    rows += [(40, "the the the the the"), (41, "the " * 300)]
    assert aligned(llm, rows) == expected(both, rows)


def test_special_rows(llm, both):
    rows = [(1, None), (2, ""), (3, "a▁b c"), (None, "plain words"), (4, "plain words"), (4, "plain words"), (5, " "), (6, "<|endoftext|> </s>")]
    rows += [(7, "x" * 20_000), (8, "日本語 text 🙂")]
    got = aligned(llm, rows)
    assert got == expected(both, rows)
    assert [r[1:] for r in got if r[0] == 3] == [(0, 0, 0, 0, 0, 0, "")]


def test_empty_table_and_clashing_columns(llm, both):
    assert aligned(llm, []) == []
    docs = llm.createDataFrame([(1, "some words here", 5, "g")], "doc_id long, text string, pair long, groups string")
    assert [tuple(r) for r in alignment.align_documents(docs, *PATHS).collect()] == expected(both, [(1, "some words here")])


def test_pair_counts(llm, both):
    rows = [(i, f"common word{i % 3} common") for i in range(9)]
    docs = llm.createDataFrame(rows, "id long, text string")
    table = alignment.written(alignment._aligned(docs, *PATHS), "t")
    got = {(r["a"], r["b"]): (r["documents"], r["links"]) for r in alignment.pair_counts(table.filter("pair IS NOT NULL")).collect()}
    per_doc = []
    for _, text in rows:
        (a, at), (b, bt) = tokens(both, text)
        per_doc.append([(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(at[i][0], bt[j][0]) < min(at[i][1], bt[j][1])])
    assert got == {p: (sum(p in d for d in per_doc), sum(d.count(p) for d in per_doc)) for d in per_doc for p in d}
