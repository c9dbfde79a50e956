"""Near-duplicate texts by DartMinHash signatures and banded joining."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_join
from .common import (
    binary_column,
    find_words,
    mix,
    parallelism,
    prepare,
    salted,
    text_key,
    whole_row,
    window_hashes,
    window_starts,
    word_hashes,
    written,
)
from .graph import components

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
# A pair at the least similarity shares no band with probability (1 - 0.8^4)^24, about 3 in a million.
BANDS, BAND_ROWS = 24, 4
# Members that one task compares with a leader's text.
MEMBERS = 512
# Text on each side of a block of comparisons.
BLOCK_BYTES = 1 << 21


def shingles(words: np.ndarray, first: np.ndarray, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of n words; a shorter text that has words is one shingle."""
    at, texts = window_starts(first, n)
    hashes = window_hashes(words, n)[at] if len(at) else np.empty(0, np.uint64)
    length = np.diff(first)
    short = np.flatnonzero((length > 0) & (length < n))
    whole = np.array(
        [int(mix(window_hashes(words[first[t] : first[t + 1]], length[t]) + np.uint64(length[t]))[0]) for t in short],
        np.uint64,
    )
    return np.concatenate([hashes, whole]), np.concatenate([texts, short])


def weighted(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, weight): distinct shingles of each text with how often they occur in it."""
    order = np.lexsort((hashes, texts))
    hashes, texts = hashes[order], texts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    begins = np.flatnonzero(new)
    return hashes[begins], texts[begins], np.diff(np.append(begins, len(hashes)))


def _exponential(keys: np.ndarray) -> np.ndarray:
    """Waiting times with mean 1 from 64-bit hashes."""
    return -np.log(((keys >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))


def dart_signatures(
    hashes: np.ndarray, texts: np.ndarray, weights: np.ndarray, count: int, coordinates: int = BANDS * BAND_ROWS
) -> np.ndarray:
    """count x coordinates: the earliest dart in every coordinate of each text's signature.

    Every element has one unit of area per unit of weight, and darts fall on each unit at
    random times, one per unit of time on average, drawn from hashes of element and unit
    alone. Only darts before a time limit are thrown, chosen so that a text of total weight
    w gets about k ln k + 2k of them: short waiting times are found in one step per unit,
    so that a long text costs little more than reading it. A dart belongs to a hashed
    coordinate, which keeps its earliest one. Where a coordinate stays empty, the text's
    limit is doubled. Two texts agree in a coordinate with the probability of their
    weighted Jaccard similarity. Texts without elements get all zeros.
    """
    k = coordinates
    out = np.zeros((count, k), np.uint64)
    unit, unit_text = _units(hashes, texts, weights)
    total = np.bincount(unit_text, minlength=count)
    todo = total > 0
    limit = (k * math.log(k) + 2 * k) / np.maximum(total, 1)
    while todo.any():
        active = todo[unit_text]
        keys, of = unit[active], unit_text[active]
        times = _exponential(salted(keys, 1))
        slots, darts, step = [], [], 2
        while True:
            early = times < limit[of]
            keys, of, times = keys[early], of[early], times[early]
            if not len(keys):
                break
            dart = salted(keys, step)
            slots.append(of.astype(np.uint64) * np.uint64(k) + salted(dart, 1) % np.uint64(k))
            # The leading bits of a time in order stand for the dart itself.
            darts.append(times.view(np.uint64) >> np.uint64(16))
            keys = dart
            times = times + _exponential(salted(dart, 2))
            step = 3 if step == 2 else step
        slot = np.concatenate(slots) if slots else np.empty(0, np.uint64)
        time = np.concatenate(darts) if darts else np.empty(0, np.uint64)
        order = np.lexsort((time, slot))
        slot, time = slot[order], time[order]
        new = np.ones(len(slot), bool)
        new[1:] = slot[1:] != slot[:-1]
        slot, time = slot[new].astype(np.int64), time[new]
        filled = np.bincount(slot // k, minlength=count)
        done = todo & (filled == k)
        here = done[slot // k]
        out.reshape(-1)[slot[here]] = time[here]
        todo &= ~done
        limit[todo] *= 2
    return out


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """count x bands: one hash per band of each signature."""
    parts = signatures.reshape(len(signatures), bands, rows)
    keys = salted(np.arange(bands, dtype=np.uint64), 11)[None, :]
    for r in range(rows):
        keys = mix(keys ^ mix(parts[:, :, r] + np.uint64(r)))
    return keys


def _read(column) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = binary_column(column)
    starts, ends, first = find_words(data, offsets)
    return word_hashes(data, starts, ends), first


def signed(docs: DataFrame, id_col: str, text_col: str, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(id, key, n_words, bands): a row per document; `key` stands for its whole text."""
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, first = _read(batch.column(2))
            elements = weighted(*shingles(words, first))
            keys = band_keys(dart_signatures(*elements, batch.num_rows, bands * rows), bands, rows).view(np.int64)
            offsets = pa.array(np.arange(batch.num_rows + 1) * bands, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(first), pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.ravel(), pa.int64())),
                ],
                names=["id", "key", "n_words", "bands"],
            )

    picked = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    return picked.mapInArrow(sign, f"id {id_type}, key binary, n_words long, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(member, leader, similarity) of the pairs at least that similar, from whole texts.

    A leader's text goes once to each of the tasks that hold its members; a leader with
    very many members is dealt to several.
    """
    spark = pairs.sparkSession
    many = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    dealt = split_join(pairs, many, "leader").withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int"))
    members = split_join(dealt.select("member", "leader", "part"), texts.withColumnRenamed("key", "member"), "member")
    leaders = many.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    leaders = split_join(leaders, texts.withColumnRenamed("key", "leader"), "leader")
    both = members.select("leader", "part", F.col("member"), "text").unionByName(
        leaders.select("leader", "part", F.lit(None).cast("binary").alias("member"), "text")
    )
    # The leader's own text comes first among its rows.
    ordered = both.repartition(parallelism(spark), "leader", "part").sortWithinPartitions("leader", "part", "member")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            words, first = _read(batch.column(3))
            hashes, texts_of, weights = weighted(*shingles(words, first))
            borders = np.searchsorted(texts_of, np.arange(batch.num_rows + 1))
            leader, member = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = []
            for i in range(batch.num_rows):
                mine = slice(borders[i], borders[i + 1])
                if member[i] is None:
                    own = (hashes[mine].copy(), weights[mine].copy())
                    continue
                h, w = hashes[mine], weights[mine]
                _, x, y = np.intersect1d(h, own[0], assume_unique=True, return_indices=True)
                shared = int(np.minimum(w[x], own[1][y]).sum())
                union = int(w.sum() + own[1].sum()) - shared
                if union and shared >= least * union:
                    rows.append((member[i], leader[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                names=["member", "leader"],
            )

    return ordered.mapInArrow(compare, "member binary, leader binary")


def _buckets(folded: DataFrame) -> DataFrame:
    """(bucket, key, rank, leader) of every bucket that several texts share; of buckets with the same texts one.

    A text ranks by the number of texts in all its buckets together: in a group of near copies
    the text that the others were made from shares most. The leader is the first by rank.
    """
    filed = folded.select("key", F.explode("bands").alias("bucket"))
    crowded = filed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    members = written(split_join(filed, crowded, "bucket").distinct(), "filed")
    fingerprint = F.sum(F.xxhash64("key").cast("decimal(38,0)"))
    alike = members.groupBy("bucket").agg(fingerprint.alias("print"), F.count(F.lit(1)).alias("n"))
    one = alike.groupBy("print", "n").agg(F.min("bucket").alias("bucket"), F.count(F.lit(1)).alias("times"))
    single = split_join(members, one.select("bucket", "n", "times"), "bucket")
    ranks = single.groupBy("key").agg(F.struct(F.sum(F.col("n") * F.col("times")).alias("n"), "key").alias("rank"))
    ranked = written(split_join(single.select("bucket", "key"), ranks, "key"), "ranked")
    first = ranked.groupBy("bucket").agg(F.max("rank").alias("first"))
    return split_join(ranked, first, "bucket").select("bucket", "key", "rank", F.col("first.key").alias("leader"))


def _classes(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(node, component) of the texts that link with another one, by text key.

    First the leader of each bucket is compared with its other members, which links groups
    of copies whatever their size with one comparison per member and bucket. Members that are not
    of the leader's class after that are compared with all others of their bucket, block by block.
    """
    asked = written(members.filter("key <> leader").select("leader", F.col("key").alias("member")).distinct(), "asked")
    found = _verified(asked, texts, least).select(F.col("member").alias("a"), F.col("leader").alias("b"))
    links = written(found, "links")
    classes = components(links)
    more = written(_links_of_rest(members, classes, texts, least), "more_links")
    return components(links.union(more))


def _links_of_rest(members: DataFrame, classes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(a, b): links that connect the members that are not of their leader's class with the others.

    Both sides of a bucket are dealt to blocks of about `BLOCK_BYTES` of text, and a task
    compares two blocks at a time by a product of their shingle tables. It returns links of a
    spanning forest, never the pairs.
    """
    spark = members.sparkSession

    def classed(rows: DataFrame, key: str, name: str) -> DataFrame:
        named = classes.select(F.col("node").alias(key), F.col("component").alias(name))
        return split_join(rows, named, key, "left").withColumn(name, F.coalesce(name, key))

    sized = split_join(members.select("bucket", "key", "leader"), texts.select("key", F.octet_length("text").alias("bytes")), "key")
    named = classed(classed(sized, "key", "class"), "leader", "leader_class")
    named = written(named.withColumn("rest", F.col("class") != F.col("leader_class")), "named")
    parts = lambda rows: F.ceil(F.sum(F.when(rows, F.col("bytes"))) / BLOCK_BYTES).cast("int")
    open_ = named.groupBy("bucket").agg(
        parts(F.col("rest")).alias("l_parts"),
        parts(F.col("key") != F.col("leader")).alias("r_parts"),
        F.count_if("rest").alias("n_rest"),
        F.count(F.lit(1)).alias("n"),
    ).filter("n_rest > 0 AND n > 2").select("bucket", "l_parts", "r_parts")
    dealt = split_join(named, open_, "bucket")
    part = lambda parts: F.pmod(F.xxhash64("key"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = dealt.filter("rest").select("bucket", part("l_parts").alias("l"), every("r_parts").alias("r"), F.lit(0).alias("side"), "key")
    right = dealt.filter("key <> leader").select(
        "bucket", every("l_parts").alias("l"), part("r_parts").alias("r"), F.lit(1).alias("side"), "key"
    )
    block = ["bucket", "l", "r"]
    rows = split_join(left.union(right), texts, "key").select(*block, "side", "key", "text")
    ordered = rows.repartition(parallelism(spark), *block).sortWithinPartitions(*block, "side")

    return ordered.mapInArrow(_compare_blocks(least), "a binary, b binary")


def _compare_blocks(least: float):
    """A function over rows (bucket, l, r, side, key, text), sorted, to the links of each block pair."""

    def links(held) -> list[tuple[bytes, bytes]]:
        (left_keys, left_units), (right_keys, right_units) = held
        if not left_keys or not right_keys:
            return []
        alike = _alike(left_units, right_units, least)
        i, j = np.nonzero(alike & (np.array(left_keys)[:, None] != np.array(right_keys)[None, :]))
        root: dict[bytes, bytes] = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        out = []
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            a, b = find(left_keys[x]), find(right_keys[y])
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((left_keys[x], right_keys[y]))
        return out

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, (([], []), ([], []))
        for batch in batches:
            words, first = _read(batch.column(5))
            hashes, texts, weights = weighted(*shingles(words, first))
            units, of = _units(hashes, texts, weights)
            borders = np.searchsorted(of, np.arange(batch.num_rows + 1))
            names = list(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True))
            found = []
            for i, (side, key) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                if names[i] != name:
                    found += links(held)
                    name, held = names[i], (([], []), ([], []))
                held[side][0].append(key)
                held[side][1].append(units[borders[i] : borders[i + 1]].copy())
            yield _pairs(found)
        yield _pairs(links(held))

    return compare


def _pairs(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _units(hashes: np.ndarray, texts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every unit of weight, so that the units that two texts share are their common weight."""
    copy = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights) - weights, weights)
    return mix(np.repeat(hashes, weights) + mix(copy.astype(np.uint64))), np.repeat(texts, weights)


def _alike(left: list[np.ndarray], right: list[np.ndarray], least: float, columns: int = 4096) -> np.ndarray:
    """Which texts on the left and the right, given by their units, are at least that similar."""
    sizes = [np.array([len(u) for u in side]) for side in (left, right)]
    rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
    names, at = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    at = at[: len(rows[0])], at[len(rows[0]) :]
    # Only units that both sides hold can be shared.
    both = (np.bincount(at[0], minlength=len(names)) > 0) & (np.bincount(at[1], minlength=len(names)) > 0)
    place = np.cumsum(both) - 1
    shared = np.zeros((len(left), len(right)), np.float64)
    sides = []
    for r, a in zip(rows, at, strict=True):
        keep = both[a]
        order = np.argsort(place[a[keep]], kind="stable")
        sides.append((r[keep][order], place[a[keep]][order]))
    for low in range(0, int(both.sum()), columns):
        tables = []
        for n, (r, p) in zip(sizes, sides, strict=True):
            part = slice(*np.searchsorted(p, [low, low + columns]))
            table = np.zeros((len(n), columns), np.float32)
            table[r[part], p[part] - low] = 1
            tables.append(table)
        shared += tables[0] @ tables[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    return (union > 0) & (shared >= least * union)


def near_duplicate_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = LEAST_SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per document: (id, text_key, n_words, component_id, class_size, kept).

    Documents link if the weighted Jaccard similarity of their five-word shingles (words
    between white space, a shingle weighs as often as it occurs) is at least `least`; equal
    texts always link. `component_id` is the smallest id a document reaches by links,
    `class_size` how many rows its class has, `kept` marks one row of each class, one with that id.
    A text of one to four words is one shingle. Documents without words, null ones among
    them, link with nothing and are kept. Rows without id are compared like others, but
    are kept only where a class has no other. Repeated rows are one class, of which one
    row is kept. Other columns play no part, an empty table gives no rows.

    Equal texts are folded by their digest. Texts that agree in a band of their DartMinHash
    signatures meet in a bucket, where whole texts are compared; see `_classes`.
    """
    prepare(docs.sparkSession)
    slot = F.monotonically_increasing_id()
    signatures = written(signed(docs, id_col, text_col, bands, rows).withColumn("slot", slot), "signatures")
    folded = signatures.filter("n_words > 0").groupBy("key").agg(F.first("bands").alias("bands"))
    members = written(_buckets(folded), "members")
    # Joined alike at every size: the texts are dealt out, not the keys sent to them.
    touched = members.select("key").distinct().hint("merge")
    whole = docs.select(text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    shared = split_join(whole, touched, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    classes = _classes(members, written(shared, "texts"), least).withColumnRenamed("node", "key")

    named = split_join(signatures.drop("bands"), classes, "key", "left")
    named = named.withColumn("class", F.when(F.col("n_words") > 0, F.coalesce("component", "key")))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "slot")
    sizes = (
        named.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("class_size"))
    )
    alone = F.col("first").isNull()
    return split_join(named, sizes, "class", "left").select(
        F.col("id").alias(id_col),
        F.col("key").alias("text_key"),
        "n_words",
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (alone | (F.col("slot") == F.col("first.slot"))).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SIMILARITY
) -> DataFrame:
    """The documents, whole rows, that `near_duplicate_classes` keeps."""
    judged = near_duplicate_classes(docs, id_col, text_col, least)
    kept = written(
        judged.filter("kept AND n_words > 0")
        .groupBy("text_key")
        .agg(F.min("component_id").alias("kept_id"))
        .withColumnRenamed("text_key", "key"),
        "kept",
    )
    tag = F.xxhash64("key")
    worded = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.filter(worded).select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), text_key(text_col).alias("key"))
    rows = keyed.withColumn("tag", tag).join(kept.withColumn("tag", tag), ["key", "tag"])
    # Rows alike in id and text are one class: any one of them stays, found where the join has put them.
    rows = rows.filter(F.col("id").eqNullSafe(F.col("kept_id"))).dropDuplicates(["key", "tag"])
    # Texts without words are all kept and meet nothing, so they need no join.
    return rows.select("row.*").unionByName(docs.filter(~worded))
