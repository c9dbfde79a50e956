import random

import pytest
from .brute import water_levels, words
from pyspark.sql import functions as F

from siteweave.llm import mixing


def sizes_of(rows):
    sizes = {}
    for r in rows:
        s = r.sources[0]
        sizes[s] = sizes.get(s, 0) + r.size
    return sizes


def check(mixed, tolerance=0.02):
    rows = mixed.collect()
    sizes = sizes_of(rows)
    targets = water_levels(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        s = r.sources[0]
        assert r.target == pytest.approx(targets[s]) and r.source_size == sizes[s]
        assert 0 <= r.times <= 3
        taken[s] += r.times * r.size
    for s, n in taken.items():
        largest = max(r.size for r in rows if r.sources[0] == s)
        assert abs(n - targets[s]) <= max(tolerance * targets[s], largest)
    return rows


def test_targets_and_near_them(make_docs, prose):
    draw = random.Random(2)
    sources = ["web", "books", "é", "Z", None, "", "code"]
    rows = [(i, prose(i, draw.randrange(1, 120)), draw.choice([*sources, "web", "web", "web"])) for i in range(1200)]
    docs = make_docs(rows).repartition(5)
    got = {r.doc_id: (r.size, r.times) for r in check(mixing.mix_documents(docs))}
    assert {i: n for i, (n, _) in got.items()} == {i: len(words(t)) for i, t, _ in rows}
    again = mixing.mix_documents(docs.repartition(3)).collect()
    assert {r.doc_id: (r.size, r.times) for r in again} == got
    other = {r.doc_id: (r.size, r.times) for r in mixing.mix_documents(docs, seed=18).collect()}
    assert other != got


def left_out(rows):
    """Per source: words missing or too many, and the smallest document that could have been taken once more."""
    taken, least = {}, {}
    for s in sizes_of(rows):
        of = [r for r in rows if r.sources[0] == s]
        taken[s] = abs(sum(r.times * r.size for r in of) - of[0].target)
        rounds = int(of[0].target / of[0].source_size + 1e-12)
        least[s] = min((r.size for r in of if r.size and r.times == rounds), default=0)
    return taken, least


@pytest.mark.parametrize("seed", range(2))
def test_short_documents_fill_what_long_ones_leave_open(make_docs, seed):
    rows = [(i, "a " * 10, "a") for i in range(6000)] + [(10000 + i, "b " * 30000, "a") for i in range(4)]
    rows += [(20000 + i, "c " * (1 + i % 50), "b") for i in range(4000)]
    mixed = mixing.mix_documents(make_docs(rows), seed=seed, weights=(1, 2)).collect()
    off, least = left_out(mixed)
    for s, n in off.items():
        assert n <= least[s] / 2 + 1e-6


def test_small_sources_stop_at_three_times(make_docs):
    rows = [(i, "a " * 50, "big") for i in range(100)] + [(200, "b c", "tiny"), (201, "d", "tiny"), (202, "e", None)]
    by_id = {r.doc_id: r for r in check(mixing.mix_documents(make_docs(rows)))}
    assert by_id[200].target == 9 and by_id[200].times == by_id[201].times == by_id[202].times == 3


def test_texts_without_words_and_odd_rows(make_docs):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t", None), (None, "x y", "b"), (None, "x y", "b"), (4, "x y", "b")]
    docs = make_docs(rows).withColumns({"size": F.lit("clash"), "times": F.lit("clash"), "key": F.lit(1)})
    assert len(check(mixing.mix_documents(docs))) == 6
    nothing = mixing.mix_documents(make_docs([(1, None, "a"), (2, "", None)])).collect()
    assert [(r.size, r.source_size, r.target, r.times) for r in nothing] == [(0, 0, 0.0, 1)] * 2
    assert mixing.mix_documents(make_docs([])).count() == 0


def test_documents_are_repeated_whole(make_docs, prose):
    docs = make_docs([(i, prose(i, 40), "ab"[i % 2]) for i in range(60)]).withColumn("times", F.lit("own"))
    times = {r.doc_id: r.times for r in mixing.mix_documents(docs).collect()}
    out = mixing.repeat_documents(docs)
    assert out.columns == docs.columns
    count = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert count == {i: n for i, n in times.items() if n}
    assert out.filter("times <> 'own'").count() == 0


def test_overlapping_sources_share_their_documents(llm, prose):
    rows = [(i, prose(i, 50), ["a"] if i % 3 == 0 else ["b", "a"] if i % 3 == 1 else ["b"]) for i in range(300)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, places array<string>")
    mixed = mixing.mix_documents(docs, "places").collect()
    words_of = {}
    for r in mixed:
        words_of[tuple(r.sources)] = words_of.get(tuple(r.sources), 0) + r.size * r.times
    assert set(words_of) == {("a",), ("b",), ("a", "b")}
    # Sources hold 10,000 words each (5,000 in common); together the patterns give what both targets ask for.
    targets = {s: t for r in mixed for s, t in [(r.sources[0], r.target)]}
    assert sum(words_of.values()) == pytest.approx(sum(targets.values()), rel=0.02)
    # Each source by itself: what is its own alone fits into its target, and what both hold fills both up.
    for own, other in (("a", "b"), ("b", "a")):
        assert words_of[(own,)] <= targets[own] * 1.02
        assert words_of[(own,)] + words_of[("a", "b")] >= targets[own] * 0.98
        assert words_of[("a", "b")] - (targets[own] - words_of[(own,)]) == pytest.approx(targets[other] - words_of[(other,)], abs=200)


def test_sources_apart_are_routed_apart(llm, prose, monkeypatch):
    """Every connected part of the patterns comes as a network of its own, also where all have one source."""
    rows = [(i, prose(i, 20), [["a"], ["a", "b"], ["c"], [None], ["d", None], []][i % 6]) for i in range(120)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, places array<string>")
    sized = docs.select(F.array_sort("places").alias("sources"), F.lit(20).cast("long").alias("size"))
    targets = llm.createDataFrame([("a", 800.0), ("b", 1200.0), ("c", 500.0), ("d", 900.0), (None, 600.0)], "source string, target double")
    given = {tuple(r.sources): r.words for r in mixing._pattern_words(sized, targets, 3).collect()}
    assert given[("c",)] == pytest.approx(500)
    assert given[("a",)] + given[("a", "b")] == pytest.approx(2000) and given[("a", "b")] >= 1200 - 1e-6 and given[("a",)] <= 800 + 1e-6
    null = [w for p, w in given.items() if None in p]
    assert sum(null) == pytest.approx(1500) and len(given) == 5


def test_route_prefers_fewer_repeats():
    flow = mixing.route({("a",): 100, ("a", "b"): 100, ("b",): 10}, {"a": 150, "b": 120})
    given = {p: sum(to.values()) for p, to in flow.items()}
    assert sum(flow[p].get("a", 0) for p in flow) == pytest.approx(150)
    assert sum(flow[p].get("b", 0) for p in flow) == pytest.approx(120)
    assert given[("a",)] >= 100 - 1e-6 and given[("a", "b")] >= 100 - 1e-6 and given[("b",)] >= 10 - 1e-6
    assert all(given[p] <= 3 * n + 1e-6 for p, n in {("a",): 100, ("a", "b"): 100, ("b",): 10}.items())


def test_route_undoes_what_blocks_another_source():
    flow = mixing.route({("a", "b"): 10, ("a",): 10}, {"a": 10.0, "b": 10.0}, most_repeats=1)
    assert flow[("a",)]["a"] == pytest.approx(10) and flow[("a", "b")]["b"] == pytest.approx(10)


def test_route_stops_at_what_there_is():
    flow = mixing.route({("a",): 5, ("b",): 0}, {"a": 100.0, "b": 3.0})
    assert flow[("a",)]["a"] == pytest.approx(15) and flow[("b",)]["b"] == 0
