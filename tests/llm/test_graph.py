import random

from .brute import smallest_reached

from siteweave.llm.graph import components


def check(llm, links, kind="long", make=lambda x: x):
    frame = llm.createDataFrame([(make(a), make(b)) for a, b in links], f"a {kind}, b {kind}")
    got = {r.node: r.component for r in components(frame).collect()}
    nodes = sorted({x for a, b in links for x in (a, b) if a != b})
    both = {*links, *[(b, a) for a, b in links]}
    want = smallest_reached(nodes, lambda i, j: (i, j) in both)
    assert got == {make(i): make(c) for i, c in want.items()}


def test_random_graphs(llm):
    draw = random.Random(6)
    check(llm, [(draw.randrange(60), draw.randrange(60)) for _ in range(40)])


def test_path_star_and_loops(llm):
    check(llm, [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)])


def test_keys_of_bytes(llm):
    check(llm, [(3, 1), (2, 3), (7, 8)], "binary", lambda x: bytes([x]))


def test_no_links(llm):
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0
