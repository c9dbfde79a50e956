"""Exact top-k search by inner product over a vector-approximation file."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_k
from .common import parallelism, prepare, written

# Vectors in a block of the file, queries in a block, and cells each component falls into.
BLOCK_ROWS = 4096
QUERY_ROWS = 512
CELLS = 32
# Bytes of vectors that a task holds at a time of the file and of the queries, one block of each at least.
FILE_BYTES = 40 << 20
QUERY_BYTES = 16 << 20


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: float, repeats: bool = False) -> DataFrame:
    """(id, v): components times `scale`, rounded down, as doubles.

    Left out are rows without id and vectors that are null or hold null or non-finite
    components. An id counts once: of several vectors with one id the smallest is taken, or,
    with `repeats`, every row stays and has a slot number, to be fixed by writing the table.
    """
    v = F.transform(vec_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    x = F.col(vec_col)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    usable = vectors.filter(F.col(id_col).isNotNull() & x.isNotNull()).filter(sound)
    if repeats:
        return usable.select(F.col(id_col).alias("id"), v.alias("v"), F.monotonically_increasing_id().alias("slot"))
    return usable.select(F.col(id_col).alias("id"), v.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _deal(vectors: DataFrame, parts: str) -> Column:
    """Part of each row by a hash of its slot, or of its id where ids are distinct."""
    return F.pmod(F.xxhash64("slot" if "slot" in vectors.columns else "id"), F.col(parts)).cast("int")


def build_file(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(dim, block, ids, exact, cells, low, high) from (id, v), one row per block of vectors.

    Vectors are dealt by a hash of their id to blocks of about `block_rows`, those of each
    dimension to blocks of their own, so every vector is in the file whatever its length.
    `cells` is a byte per component; `low` and `high` hold the smallest and largest value
    of each component in each cell. The cells' borders come from all vectors of the block.
    """
    sized = vectors.withColumn("dim", F.size("v"))
    blocks = sized.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    # One row per dimension.
    dealt = sized.join(F.broadcast(blocks), "dim").withColumn("block", _deal(vectors, "blocks"))

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids = group["id"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        dim = group["dim"][0].as_py()
        flat = group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        exact = np.asarray(flat, np.float64).reshape(len(ids), dim)
        least, most = exact.min(axis=0), exact.max(axis=0)
        width = np.maximum((most - least) / CELLS, np.finfo(float).tiny)
        cells = np.clip(np.floor((exact - least) / width), 0, CELLS - 1).astype(np.uint8)
        low = np.full((CELLS, dim), np.inf)
        high = np.full((CELLS, dim), -np.inf)
        column = np.arange(dim)
        np.minimum.at(low, (cells, column[None, :]), exact)
        np.maximum.at(high, (cells, column[None, :]), exact)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "block": pa.array([group["block"][0].as_py()], pa.int32()),
                **{
                    name: pa.array([a.tobytes()], pa.binary())
                    for name, a in (("ids", ids), ("exact", exact), ("cells", cells), ("low", low), ("high", high))
                },
            }
        )

    schema = "dim int, block int, ids binary, exact binary, cells binary, low binary, high binary"
    return dealt.select("id", "v", "dim", "block").groupBy("dim", "block").applyInArrow(build, schema)


def _parts(queries: DataFrame, rows: int) -> DataFrame:
    """(dim, parts): into how many blocks the queries of a dimension are dealt; one row per dimension."""
    sized = queries.select(F.size("v").alias("dim"))
    return sized.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts"))


def _query_blocks(queries: DataFrame, rows: int) -> DataFrame:
    """(dim, part, ids, q, least): queries (id, v, least) in blocks; `least` is the score they still need."""
    sized = queries.withColumn("dim", F.size("v"))
    dealt = sized.join(F.broadcast(_parts(queries, rows)), "dim").withColumn("part", _deal(queries, "parts"))

    def gather(group: pa.Table) -> pa.Table:
        dim = group["dim"][0].as_py()
        flat = group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "part": pa.array([group["part"][0].as_py()], pa.int32()),
                "qids": pa.array([group["id"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "q": pa.array([np.asarray(flat, np.float64).tobytes()], pa.binary()),
                "least": pa.array([group["least"].to_numpy().astype(np.float64).tobytes()], pa.binary()),
            }
        )

    schema = "dim int, part int, qids binary, q binary, least binary"
    return dealt.select("id", "v", "least", "dim", "part").groupBy("dim", "part").applyInArrow(gather, schema)


def _bounds(row: dict, upper_only: bool):
    """Bounds of all inner products between a block of queries and a block of the file, from cells alone."""
    dim = row["dim"]
    qids, ids = np.frombuffer(row["qids"], np.int64), np.frombuffer(row["ids"], np.int64)
    q = np.frombuffer(row["q"], np.float64).reshape(len(qids), dim)
    cells = np.frombuffer(row["cells"], np.uint8).reshape(len(ids), dim)
    low = np.frombuffer(row["low"], np.float64).reshape(CELLS, dim)
    high = np.frombuffer(row["high"], np.float64).reshape(CELLS, dim)
    column = np.arange(dim)[None, :]
    lows, highs = low[cells, column], high[cells, column]
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    own = qids[:, None] == ids[None, :]
    upper = up @ highs.T + down @ lows.T
    upper[own] = -np.inf
    if upper_only:
        return qids, ids, q, upper, None
    lower = up @ lows.T + down @ highs.T
    lower[own] = -np.inf
    return qids, ids, q, upper, lower


def _met(
    file: DataFrame,
    queries: DataFrame,
    columns: list[str],
    block_rows: int,
    query_rows: int,
    work: Callable[[Iterator[dict], list[dict]], pa.Table],
    schema: str,
) -> DataFrame:
    """What `work` makes of the queries and the file in blocks, where all of a dimension meet each other.

    Both come in groups of bounded size, dealt to the cells of a grid: a block of queries is copied once for each group of
    the file, and a block of the file once for each group of queries. Both are shuffled; a join would broadcast the copies, whose
    number Spark's size checks don't see.
    """
    n = parallelism(file.sparkSession)
    counts = file.groupBy("dim").agg((F.max("block") + 1).alias("_blocks"))
    counts = counts.join(_parts(queries, query_rows).withColumnRenamed("parts", "_parts"), "dim")
    # How many blocks make a group of bounded size, and into how many groups they go: more of them where that leaves cores idle.
    held = lambda most, rows, size: F.greatest(F.lit(1), F.floor(most / (rows * size * F.greatest("dim", F.lit(1)))))
    in_file, in_queries = held(F.lit(FILE_BYTES), F.lit(block_rows), 9), held(F.lit(QUERY_BYTES), F.lit(query_rows), 8)
    groups = lambda count, most, others: F.least(count, F.greatest(F.ceil(count / most), F.ceil(F.lit(3 * n) / others)))
    rows = groups(F.col("_blocks"), in_file, F.ceil(F.col("_parts") / in_queries)).cast("int")
    grid = counts.withColumn("_rows", rows).withColumn("_columns", groups(F.col("_parts"), in_queries, F.col("_rows")).cast("int"))
    grid = F.broadcast(grid)  # one row per dimension
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    cell = ["dim", "_row", "_column"]
    asked = _query_blocks(queries, query_rows).join(grid, "dim")
    asked = asked.withColumn("_column", F.col("part") % F.col("_columns")).withColumn("_row", every("_rows"))
    stored = file.select("dim", "block", *columns).join(grid, "dim")
    stored = stored.withColumn("_row", F.col("block") % F.col("_rows")).withColumn("_column", every("_columns"))
    asked = asked.select(*cell, "part", "qids", "q", "least").repartition(n, *cell)
    stored = stored.select(*cell, "block", *columns).repartition(n, *cell)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = lambda table: (table.slice(i, 1).to_pylist()[0] for i in range(table.num_rows))
        return work(rows(left), [*rows(right)])

    return asked.groupBy(*cell).cogroup(stored.groupBy(*cell)).applyInArrow(meet, schema)


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    repeats: bool = False,
) -> DataFrame:
    """(query_id, rank, id, score): each query's k best rows but its own, ties to the smaller id.

    Queries are the rows that `is_query` picks by the column `id`. Scores are inner
    products of the vectors' whole parts (see `whole_vectors`), exact as long as they stay
    below 2^53; vectors are compared with those of their own length. A query with fewer
    than k others has them all; without any it has no row, like an empty table.

    An id counts once. With `repeats`, rows that share an id all count: each is a candidate, and
    the query rows of an id share one ranking, without the rows of that id.

    First every query is bounded against every vector by the cells alone: the k-th largest
    lower bound over all blocks is a score that the result reaches. Then, block by block,
    exact vectors are read in order of their bounds, only down to that score and until the
    k-th result of the blocks so far is certain. Groups of queries meet groups of the file
    (see `_met`) block by block, so a task holds `query_rows` x `block_rows` bounds and two
    groups of bounded size whatever the size of the table.
    """
    spark = prepare(vectors.sparkSession)
    whole = written(whole_vectors(vectors, id_col, vec_col, scale, repeats), "vectors")
    file = written(build_file(whole, block_rows), "va_file")
    queries = whole.filter(is_query).withColumn("least", F.lit(float("-inf")))

    def lower_bounds(asked: Iterator[dict], stored: list[dict]) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0))]
        for queries in asked:
            best = None
            for block in stored:
                qids, ids, _, _, lower = _bounds(queries | block, False)
                lower = lower if best is None else np.concatenate([best, lower], axis=1)
                n = min(k, lower.shape[1])
                best = np.partition(lower, lower.shape[1] - n, axis=1)[:, lower.shape[1] - n :]
            if best is not None:
                found.append((np.repeat(qids, best.shape[1]), best.ravel()))
        return pa.table({"id": np.concatenate([i for i, _ in found]), "bound": np.concatenate([b for _, b in found])})

    approximations = ["ids", "cells", "low", "high"]
    bounds = _met(
        file, queries, approximations, block_rows, query_rows, lower_bounds, "id long, bound double"
    ).filter(F.col("bound") > F.lit(float("-inf")))
    ranked = top_k(bounds, ["id"], [F.col("bound").desc()], k, "place")
    least = ranked.filter(F.col("place") == k).select("id", F.col("bound").alias("least"))
    asked = written(queries.drop("least").join(least, "id", "left").fillna(float("-inf"), ["least"]), "queries")

    def exact_scores(asked: Iterator[dict], stored: list[dict]) -> pa.Table:
        nothing = np.empty(0, np.int64)
        out = [(nothing, nothing, np.empty(0))]
        for queries in asked:
            n = len(queries["qids"]) // 8
            best = [(nothing, np.empty(0))] * n
            for block in stored:
                qids, ids, q, upper, _ = _bounds(queries | block, True)
                exact = np.frombuffer(block["exact"], np.float64).reshape(len(ids), queries["dim"])
                least = np.frombuffer(queries["least"], np.float64)
                for j in range(n):
                    got_ids, got = best[j]
                    reach = max(least[j], got[k - 1]) if len(got) >= k else least[j]
                    open_ = np.flatnonzero((upper[j] >= reach) & (upper[j] > -np.inf))
                    open_ = open_[np.argsort(-upper[j, open_], kind="stable")]
                    # Read as many as could be the result, then on while a bound reaches the k-th score.
                    for at in range(0, len(open_), 2 * k):
                        if len(got) >= k and upper[j, open_[at]] < got[k - 1]:
                            break
                        read = open_[at : at + 2 * k]
                        got_ids = np.concatenate([got_ids, ids[read]])
                        got = np.concatenate([got, exact[read] @ q[j]])
                        order = np.lexsort((got_ids, -got))[:k]
                        got_ids, got = got_ids[order], got[order]
                    best[j] = got_ids, got
            if stored:
                out += [(np.full(len(got), qid), got_ids, got) for qid, (got_ids, got) in zip(qids, best, strict=True)]
        query_id, ids, score = (np.concatenate([o[i] for o in out]) for i in range(3))
        return pa.table({"query_id": query_id, "id": ids, "score": score.astype(np.int64)})

    scores = _met(
        file,
        asked,
        [*approximations, "exact"],
        block_rows,
        query_rows,
        exact_scores,
        "query_id long, id long, score long",
    )
    best = top_k(scores, ["query_id"], [F.col("score").desc(), "id"], k, "rank")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
