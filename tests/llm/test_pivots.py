import math
import os
import random

import numpy as np
import pytest
from .brute import smallest_reached

from siteweave.llm.pivots import near_duplicates
from siteweave.sources.tables import read_table

VECTORS = "vec_id long, embedding array<float>, label int, n_links string, node string"


def table(llm, rows):
    return llm.createDataFrame([(i, v, label, "clash", "clash") for i, v, label in rows], VECTORS)


def links_of(rows, least=0.98):
    """Cosines in double precision between usable rows of one label, as a matrix of links."""
    usable = [
        v is not None and label is not None and i is not None and len(v) > 0
        and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for i, v, label in rows
    ]
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i + 1, n):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                linked[i, j] = linked[j, i] = a @ b / math.sqrt((a @ a) * (b @ b)) >= least
    return linked


def near(draw, v, size):
    return [x + draw.gauss(0, size) for x in v]


def test_same_as_brute_force(llm):
    draw = random.Random(2)
    rows, k = [], 0
    for g in range(40):
        v = [draw.gauss(0, 1) for _ in range(24)]
        for _ in range(draw.randrange(1, 8)):
            rows.append((k, near(draw, v, draw.choice([0.0, 0.02, 0.1])), g % 3))
            k += 1
    rows += [(k, None, 1), (k + 1, [0.0] * 24, 1), (k + 2, [math.nan] * 24, 1), (k + 3, [None] * 24, 1)]
    rows += [(k + 4, [1.0] * 24, None), (k + 5, [1.0] * 24, None), (k + 6, [], 1), (k + 7, [1.0, 2.0], 1), (k + 8, [2.0, 4.0], 1)]
    got = {r.vec_id: r for r in near_duplicates(table(llm, rows).repartition(4), block_rows=16).collect()}
    linked = links_of(rows)
    ids = [r[0] for r in rows]
    want = smallest_reached(ids, lambda i, j: linked[i, j])
    found = sum(r.n_links for r in got.values())
    assert found >= 0.97 * linked.sum()
    assert all(got[i].n_links <= linked[i].sum() for i in ids)
    assert sum(got[i].component_id == want[i] for i in ids) >= 0.97 * len(ids)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    for i in range(k, k + 7):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[k + 7].n_links == got[k + 8].n_links == 1


def test_a_large_group_of_near_copies_is_counted_whole(llm):
    draw = random.Random(4)
    v = [draw.gauss(0, 1) for _ in range(16)]
    rows = [(i, near(draw, v, 0.005), 1) for i in range(500)] + [(500 + i, v, 1) for i in range(100)]
    got = near_duplicates(table(llm, rows), block_rows=100).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(r.n_links for r in got) >= 0.97 * 600 * 599
    assert all(r.n_links <= 599 for r in got)


def test_odd_rows(llm):
    rows = [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [-1.0, 0.0], 1)]
    got = sorted(((r.vec_id is None, r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicates(table(llm, rows)).collect()), key=repr)
    assert got == sorted(
        [(False, 3, 2, 2, False), (False, 3, 2, 2, False), (False, 2, 2, 2, True), (False, 2, 0, 2, True), (True, None, 0, None, True)],
        key=repr,
    )
    assert near_duplicates(table(llm, [])).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_recall_on_the_test_tables(llm):
    vectors = read_table(llm, "/root/testdata/sf0.1", "embeddings")
    rows = vectors.collect()
    v = np.array([r.embedding for r in rows], float)
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    label = np.array([r.label for r in rows])
    linked = (v @ v.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    want = {r.vec_id: int(n) for r, n in zip(rows, linked.sum(axis=1), strict=True)}
    got = {r.vec_id: r.n_links for r in near_duplicates(vectors).collect()}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.95 * sum(want.values())
