import math
import random
import re

import duckdb
from pyspark.sql import functions as F

from siteweave.llm import vafile
from siteweave.llm.queries import ORACLES, QUERIES
from siteweave.llm.vafile import build_file, exact_top_k, whole_vectors

VECTORS = "vec_id long, embedding array<float>, label int, score string, rank string"


def table(llm, rows):
    return llm.createDataFrame([(i, v, 0, "clash", "clash") for i, v in rows], VECTORS)


def brute(rows, k, step):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(64 * x) for x in v]
        usable[i] = min(usable.get(i, whole), whole)
    out = set()
    for q, v in usable.items():
        if q % step:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable.items() if i != q and len(w) == len(v)]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def random_vector(draw, n=16):
    return [draw.randrange(-128, 129) / 256 for _ in range(n)]


def found(df):
    return {tuple(r) for r in df.collect()}


def test_same_as_brute_force(llm):
    draw = random.Random(7)
    rows = [(i, random_vector(draw)) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2020, [None] * 16), (2040, [math.nan] * 16), (2060, [math.inf] * 16), (None, rows[0][1])]
    rows += [(2080, [0.5] * 3), (2100, [0.25, -0.5, 0.5]), (2120, []), (2140, []), (2160, [0.0] * 16), (20, rows[20][1])]
    got = exact_top_k(table(llm, rows).repartition(5), F.col("id") % 20 == 0, k=7, block_rows=64, query_rows=8)
    assert found(got) == brute(rows, 7, 20)


def test_fewer_than_k_and_none(llm):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, [1.0, 1.0])]
    assert found(exact_top_k(table(llm, rows), F.col("id") % 20 == 0)) == brute(rows, 20, 20)
    assert found(exact_top_k(table(llm, rows[:1]), F.col("id") % 20 == 0)) == set()
    assert exact_top_k(table(llm, []), F.col("id") % 20 == 0).count() == 0
    assert exact_top_k(table(llm, [(1, [1.0])]), F.col("id") % 20 == 0).count() == 0


def test_every_vector_is_in_the_file(llm):
    draw = random.Random(8)
    rows = [(i, random_vector(draw, 4)) for i in range(300)]
    file = build_file(whole_vectors(table(llm, rows), "vec_id", "embedding", 64.0), block_rows=50)
    blocks = file.collect()
    ids = sorted(i for b in blocks for i in memoryview(b.ids).cast("q"))
    assert ids == list(range(300)) and len(blocks) > 3


def test_rows_that_share_an_id_all_count(llm, tmp_path):
    draw = random.Random(9)
    rows = [(i, random_vector(draw)) for i in range(60)]
    rows += [(i, random_vector(draw)) for i in (1, 2, 20, 20, 40)] + [rows[3], rows[40]]
    table(llm, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = QUERIES["op6_vafile"](llm, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({ORACLES['op6_vafile']})").fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_copies_of_queries_are_not_broadcast(llm):
    """blocks of queries were copied for every block of the file, and the copies sent through the driver."""
    draw = random.Random(10)
    rows = [(i, random_vector(draw)) for i in range(3000)]
    best = exact_top_k(table(llm, rows).repartition(4), F.col("id") % 3 == 0, k=3, block_rows=32, query_rows=16)
    assert found(best) == brute(rows, 3, 3)
    plan = best._jdf.queryExecution().executedPlan().toString()
    broadcasts = re.findall(r"Broadcast\w*Join \[.*", plan)
    assert not [x for x in broadcasts if "block" in x or "part" in x]
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_groups_of_blocks_in_few_cells(llm, monkeypatch):
    """Several blocks of queries and of the file in a cell, of several dimensions, carried from block to block."""
    draw = random.Random(11)
    rows = [(i, random_vector(draw, 3 + i % 3)) for i in range(900)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]
    monkeypatch.setattr(vafile, "parallelism", lambda _: 1)
    for most in (1, 4096, 1 << 20):
        monkeypatch.setattr(vafile, "FILE_BYTES", most)
        monkeypatch.setattr(vafile, "QUERY_BYTES", most)
        assert found(exact_top_k(table(llm, rows).repartition(3), F.col("id") % 4 == 0, k=6, block_rows=32, query_rows=8)) == brute(rows, 6, 4)
