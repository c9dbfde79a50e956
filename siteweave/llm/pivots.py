"""Near-duplicate vectors by an index of their nearest reference points."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_join
from .common import parallelism, prepare, written
from .graph import components

LEAST_COSINE = 0.98
# Reference points: a bounded sample of the vectors, about the root of their number.
LEAST_PIVOTS, MOST_PIVOTS = 32, 2048
# They are chosen from so many times as many rows, none closer to another than this cosine.
SAMPLED, APART = 4, 0.9
# A vector is described by its nearest pivots, is looked up under the first of them, and
# is compared with those that share enough of its description.
DESCRIBED = 10
PROBED = 4
SHARED = 4
# Rows of a posting list that one task compares with as many others.
BLOCK_ROWS = 1024


def _unit(flat: np.ndarray, rows: int) -> np.ndarray:
    x = np.asarray(flat, np.float64).reshape(rows, -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(groups: DataFrame, most: int = MOST_PIVOTS, apart: float = APART) -> dict[int, np.ndarray]:
    """Reference points per vector length, from a seeded sample of a bounded number of distinct vectors.

    Their number grows with the root of the table, so that posting lists stay short, up to
    `most`. No two have a cosine over `apart`: among points close to each other the order
    would be chance for all vectors near them, such as a large group of near copies.
    """
    n = groups.count()
    wanted = min(most, max(LEAST_PIVOTS, 2 * math.isqrt(n)))
    drawn = groups.select("v").orderBy(F.xxhash64(F.lit(3), "v"), "v").limit(SAMPLED * wanted).collect()
    by_length: dict[int, list] = {}
    for row in drawn:
        by_length.setdefault(len(row["v"]), []).append(row["v"])
    pivots = {}
    for length, rows in by_length.items():
        points = _unit(np.array(rows, np.float64), len(rows))
        chosen = np.empty((0, length))
        for point in points:
            if len(chosen) == wanted:
                break
            if not (chosen @ point > apart).any():
                chosen = np.vstack([chosen, point])
        pivots[length] = chosen
    return pivots


def describe(groups: DataFrame, pivots: dict[int, np.ndarray], described: int = DESCRIBED) -> DataFrame:
    """(node, label, copies, v, near): `near` numbers the nearest pivots, nearest first.

    Vectors of a length that no pivot has are described by nothing but their length.
    """

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("v"))
            lengths = np.diff(column.offsets.to_numpy())
            near: list = [[] for _ in range(batch.num_rows)]
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                points = pivots.get(int(length))
                if points is None:
                    continue
                flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                closeness = _unit(flat, len(rows)) @ points.T
                order = np.argsort(-closeness, axis=1, kind="stable")[:, :described]
                for row, found in zip(rows, order.tolist(), strict=True):
                    near[row] = found
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.list_(pa.int32()))], names=[*batch.schema.names, "near"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in groups.schema.fields)
    return groups.mapInArrow(nearest, f"{fields}, near array<int>")


def _postings(index: DataFrame, probed: int, block_rows: int) -> DataFrame:
    """Blocks of posting lists: (label, dim, pivot, part, parts, and the rows' arrays).

    A vector is posted under each of its `probed` nearest pivots. A list is dealt to parts
    of about `block_rows` rows by a hash, so no part grows with its list.
    """
    near = F.when(F.size("near") > 0, F.slice("near", 1, probed)).otherwise(F.array(F.lit(-1)))
    posted = index.select("*", F.size("v").alias("dim"), F.explode(near).alias("pivot"))
    key = ["label", "dim", "pivot"]
    sizes = posted.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    dealt = split_join(posted, sizes, key).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))

    def gather(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        flat = group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        near = group["near"].to_pylist()
        width = max(map(len, near), default=0)
        table = np.full((len(near), width), -1, np.int32)
        for i, found in enumerate(near):
            table[i, : len(found)] = found
        one = lambda name, kind: pa.array([group[name][0].as_py()], kind)
        return pa.table(
            {
                "label": one("label", group["label"].type),
                "dim": one("dim", pa.int32()),
                "pivot": one("pivot", pa.int32()),
                "parts": one("parts", pa.int32()),
                "part": one("part", pa.int32()),
                "nodes": pa.array([group["node"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "copies": pa.array([group["copies"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "vectors": pa.array([np.asarray(flat, np.float64).tobytes()], pa.binary()),
                "near": pa.array([table.tobytes()], pa.binary()),
            }
        )

    label = index.schema["label"].dataType.simpleString()
    schema = (
        f"label {label}, dim int, pivot int, parts int, part int, nodes binary, copies binary, vectors binary, near binary"
    )
    return dealt.drop("_tag").groupBy(*key, "part").applyInArrow(gather, schema)


def _links_of_pair(row: dict, least: float, shared: int, probed: int):
    """Verified links between two blocks of one posting list: (i, j, nodes, copies of both sides)."""
    sides = []
    for side in ("l", "r"):
        nodes = np.frombuffer(row[f"{side}_nodes"], np.int64)
        sides.append(
            (
                nodes,
                np.frombuffer(row[f"{side}_copies"], np.int64),
                np.frombuffer(row[f"{side}_vectors"], np.float64).reshape(len(nodes), -1),
                np.frombuffer(row[f"{side}_near"], np.int32).reshape(len(nodes), -1),
            )
        )
    (a, a_copies, a_vec, a_near), (b, b_copies, b_vec, b_near) = sides
    pivot = row["pivot"]
    if a_near.shape[1] and b_near.shape[1]:
        # Shared-pivot counts, as a product of the blocks' pivot tables.
        names, both = np.unique(np.concatenate([a_near.ravel(), b_near.ravel()]), return_inverse=True)
        marks = np.zeros((len(a) + len(b), len(names)), np.float32)
        rows = np.concatenate([np.repeat(np.arange(len(a)), a_near.shape[1]), len(a) + np.repeat(np.arange(len(b)), b_near.shape[1])])
        marks[rows, both] = 1
        need = min(shared, a_near.shape[1], b_near.shape[1])
        candidates = (marks[: len(a)] @ marks[len(a) :].T) >= need
    else:
        candidates = np.ones((len(a), len(b)), bool)
    if row["l_part"] == row["r_part"]:
        candidates &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
    norms = [np.sqrt((v * v).sum(axis=1)) for v in (a_vec, b_vec)]
    candidates &= a_vec @ b_vec.T / (norms[0][:, None] * norms[1][None, :]) >= least
    i, j = np.nonzero(candidates)
    if len(i) and a_near.shape[1]:
        # A pair meets in every list that both are posted under; it counts in the first of them.
        mine, theirs = a_near[i, :probed], b_near[j, :probed]
        common = (mine[:, :, None] == theirs[:, None, :]).any(axis=2)
        here = np.where(common, mine, np.iinfo(np.int32).max).min(axis=1) == pivot
        i, j = i[here], j[here]
    return i, j, a, b, a_copies, b_copies


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the given links connect, one per node at most."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = np.array([x for x in parent if root(x) != x], np.int64)
    return nodes, np.array([root(int(x)) for x in nodes], np.int64)


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    least: float = LEAST_COSINE,
    described: int = DESCRIBED,
    probed: int = PROBED,
    shared: int = SHARED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept).

    Vectors of equal label and length link if their cosine, in double precision, is at
    least `least`. `n_links` counts the other rows a row links with, `component_id` is the
    smallest id it reaches, `kept` marks the row that has it. Vectors that are null, zero
    or hold null or non-finite components, and rows without label or id, link with nothing
    and are kept. Rows that repeat a vector link with each other like any others; rows that
    repeat id, label and vector all get the same values. An empty table gives no rows.

    Equal vectors are folded first. Each distinct one is described by its nearest pivots
    and posted under the first few; two are compared if they meet in a list and share
    enough pivots, and link only by their exact cosine. Long lists are compared in blocks
    whose links are counted where they are found: a task returns a count per vector and
    the links of a spanning forest, never the pairs. All links are found among pairs that
    meet, so recall is the index's; the tests measure it against brute force.
    """
    spark = prepare(vectors.sparkSession)
    x = F.col(vec_col)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    links_at_all = x.isNotNull() & F.coalesce(sound & F.exists(x, lambda c: c != 0), F.lit(False))
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.when(links_at_all & F.col(id_col).isNotNull(), F.col(label_col)).alias("label"),
        F.transform(x, lambda c: c.cast("double")).alias("v"),
    )
    rows = written(rows.withColumn("v", F.when(F.col("label").isNotNull(), F.col("v"))), "rows")
    able = rows.filter("label IS NOT NULL")
    folded = able.groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"))
    groups = written(folded.withColumn("node", F.monotonically_increasing_id()), "groups")

    pivots = choose_pivots(groups)
    index = describe(groups.select("node", "label", "copies", "v"), pivots, described)
    blocks = written(_postings(index, probed, block_rows), "postings")

    key = ["label", "dim", "pivot"]
    side = lambda s: blocks.select(
        *key, *[F.col(c).alias(f"{s}_{c}") for c in ("part", "nodes", "copies", "vectors", "near")], "parts"
    )
    # Every block meets the blocks of its list that do not come before it.
    left = side("l").withColumn("r_part", F.explode(F.sequence(F.col("l_part"), F.col("parts") - 1))).drop("parts")
    pairs = left.join(side("r").drop("parts"), [*key, "r_part"]).repartition(
        parallelism(spark), *key, "l_part", "r_part"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                i, j, a, b, a_copies, b_copies = _links_of_pair(batch.slice(k, 1).to_pylist()[0], least, shared, probed)
                if not len(i):
                    continue
                nodes, place = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
                counts = np.zeros(len(nodes), np.int64)
                np.add.at(counts, place, np.concatenate([b_copies[j], a_copies[i]]))
                child, parent = _spanning(a[i], b[j])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([nodes, child]), pa.int64()),
                        pa.array(np.concatenate([counts, np.zeros(len(child), np.int64)]), pa.int64()),
                        pa.array([None] * len(nodes) + parent.tolist(), pa.int64()),
                    ],
                    names=["node", "links", "parent"],
                )

    found = written(pairs.mapInArrow(compare, "node long, links long, parent long"), "links")
    reached = components(found.filter("parent IS NOT NULL").select(F.col("node").alias("a"), F.col("parent").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        groups.join(counts, "node", "left")
        .join(reached, "node", "left")
        .select("id", "label", "v", "copies", "links", F.coalesce("component", "node").alias("component"))
    )
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    told = split_join(named, smallest, "component").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = split_join(rows, told, ["label", "v"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))
