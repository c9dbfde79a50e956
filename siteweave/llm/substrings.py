"""Remove passages that repeat, found by windows of doubled length."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import split_join
from .common import (
    binary_array,
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

WINDOW_WORDS = 35
# Hashes that one task compares.
BUCKET_KEYS = 1 << 20
_KEY_BYTES = 16


def _unit() -> int:
    """A number for a batch of texts; its rows are written once, so it need not be reproducible."""
    return uuid.uuid4().int >> 65


def _blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _first_smallest(values: np.ndarray, reach: int) -> np.ndarray:
    """Index of the first smallest of `reach` values from each place on, as far as there are so many."""
    best = np.arange(len(values))
    span = 1
    while 2 * span <= reach:
        a, b = best[: len(best) - span], best[span:]
        best = np.where(values[a] <= values[b], a, b)
        span *= 2
    if span < reach:
        a, b = best[: len(best) - (reach - span)], best[reach - span :]
        best = np.where(values[a] <= values[b], a, b)
    return best


def _distinct(keys: np.ndarray, buckets: int):
    """(distinct keys, place of each key among them, how often each occurs, their bucket), by bucket and key.

    `keys` has a row of one or two 64-bit numbers per key.
    """
    bucket = (keys[:, 0] >> np.uint64(33)).astype(np.int64) % buckets
    order = np.lexsort((*keys.T, bucket))
    ordered, bucket = keys[order], bucket[order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    return ordered[begins], place, np.diff(np.append(begins, len(order))), bucket[begins]


def repeated_keys(table: DataFrame, width: int, buckets: int) -> DataFrame:
    """(unit, replies): which of each unit's distinct keys occur in another unit too.

    `table` has (unit, keys), `width` 64-bit numbers to a key. A unit sends each of its
    distinct keys once, packed by bucket, so that a key that is everywhere costs one entry
    per unit; a bucket's task sorts them and answers a bit for each.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = np.frombuffer(raw.as_buffer(), np.uint64).reshape(-1, width) if raw.as_buffer().size else None
                if keys is None:
                    continue
                distinct, _, _, bucket = _distinct(keys, buckets)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                parts = np.split(distinct, cuts)
                names = bucket[np.concatenate([[0], cuts])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array([unit] * len(parts), pa.int64()),
                        pa.array([_blob(p) for p in parts], pa.binary()),
                    ],
                    names=["bucket", "unit", "keys"],
                )

    def judge(group: pa.Table) -> pa.Table:
        raw = [k.as_buffer() for k in group["keys"]]
        sizes = np.array([b.size // (8 * width) for b in raw])
        keys = np.concatenate([np.frombuffer(b, np.uint64) for b in raw]).reshape(-1, width)
        order = np.lexsort(keys.T)
        same = (keys[order[1:]] == keys[order[:-1]]).all(axis=1)
        shared = np.zeros(len(keys), bool)
        shared[order[1:]] |= same
        shared[order[:-1]] |= same
        answers = [np.packbits(part).tobytes() for part in np.split(shared, np.cumsum(sizes)[:-1])]
        return pa.table(
            {
                "unit": group["unit"],
                "bucket": group["bucket"],
                "n": pa.array(sizes, pa.int64()),
                "bits": pa.array(answers, pa.binary()),
            }
        )

    sent = table.select("unit", "keys").mapInArrow(send, "bucket long, unit long, keys binary")
    answered = sent.groupBy("bucket").applyInArrow(judge, "unit long, bucket long, n long, bits binary")
    # As many answers as the unit has buckets.
    return answered.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("bucket", "n", "bits"))).alias("replies"))


def _flags(keys: np.ndarray, replies: list[dict], buckets: int) -> np.ndarray:
    """Whether each of a unit's keys occurs again, in the unit or in another one."""
    _, place, counts, _ = _distinct(keys, buckets)
    return _by_place(place, counts, replies)


def _by_place(place: np.ndarray, counts: np.ndarray, replies: list[dict]) -> np.ndarray:
    shared = np.concatenate([np.unpackbits(np.frombuffer(r["bits"], np.uint8))[: r["n"]] for r in replies]).astype(bool)
    return (shared | (counts > 1))[place]


def _anchors(texts: DataFrame, n: int) -> DataFrame:
    """One row per batch of texts: what the first two levels need of its anchors.

    An anchor is the run of `base` words with the smallest hash in some window of n words,
    so equal windows have equal anchors at equal places, and about one run in fourteen is one. Each
    carries the hash of its run and those of the runs of double length that end and begin with it.
    """
    base = math.ceil(n / 4)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_column(batch.column(1))
            starts, ends, first = find_words(data, offsets)
            words = word_hashes(data, starts, ends)
            at, _ = window_starts(first, n)
            if not len(at):
                continue
            runs = window_hashes(words, base)
            anchors = np.unique(_first_smallest(runs, n - base + 1)[at])
            of = np.searchsorted(first, anchors, side="right") - 1
            long_runs = window_hashes(words, 2 * base) if len(words) >= 2 * base else np.empty(0, np.uint64)
            longer = np.append(long_runs, np.uint64(0))
            half = lambda h: ((h >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)
            right = np.where(
                anchors + 2 * base <= first[of + 1], half(longer[np.minimum(anchors, len(longer) - 1)]), 0
            )
            left = np.where(anchors - base >= first[of], half(longer[np.maximum(anchors - base, 0)]), 0)
            held, per_text = np.unique(of, return_counts=True)
            keys = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_unit()], pa.int64()),
                    pa.array([b"".join(keys[t] for t in held)], pa.binary()),
                    pa.array([_blob(np.diff(first)[held].astype(np.uint32))], pa.binary()),
                    pa.array([_blob(per_text.astype(np.uint32))], pa.binary()),
                    pa.array([_blob(runs[anchors])], pa.binary()),
                    pa.array([_blob(right.astype(np.uint32))], pa.binary()),
                    pa.array([_blob(left.astype(np.uint32))], pa.binary()),
                    pa.array([_blob((anchors - first[of]).astype(np.uint32))], pa.binary()),
                    pa.array([len(anchors)], pa.int64()),
                ],
                names=["unit", "texts", "lengths", "per_text", "keys", "right", "left", "place", "n"],
            )

    schema = (
        "unit long, texts binary, lengths binary, per_text binary, keys binary, right binary, left binary, "
        "place binary, n long"
    )
    return texts.select("key", "text").mapInArrow(find, schema)


def _doubled(table: DataFrame, buckets: int) -> DataFrame:
    """Units with the anchors whose run repeats, and the keys of their doubled runs."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys = np.frombuffer(r["keys"], np.uint64)
                alive = _flags(keys.reshape(-1, 1), r["replies"], buckets)
                if not alive.any():
                    continue
                of = np.repeat(np.arange(len(r["per_text"]) // 4), np.frombuffer(r["per_text"], np.uint32))[alive]
                keys, place = keys[alive], np.frombuffer(r["place"], np.uint32)[alive]
                doubled, sides, owners = [], [], []
                for side in ("right", "left"):
                    half = np.frombuffer(r[side], np.uint32)[alive]
                    there = np.flatnonzero(half)
                    doubled.append(mix(keys[there] ^ salted(half[there].astype(np.uint64), 1 + len(sides))))
                    sides.append(np.full(len(there), len(sides), np.uint8))
                    owners.append(there)
                owner = np.concatenate(owners)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["unit"]], pa.int64()),
                        pa.array([r["texts"]], pa.binary()),
                        pa.array([r["lengths"]], pa.binary()),
                        pa.array([_blob(of[owner].astype(np.uint32))], pa.binary()),
                        pa.array([_blob(place[owner])], pa.binary()),
                        pa.array([_blob(np.concatenate(sides))], pa.binary()),
                        pa.array([_blob(np.concatenate(doubled))], pa.binary()),
                        pa.array([len(owner)], pa.int64()),
                    ],
                    names=["unit", "texts", "lengths", "text", "place", "side", "keys", "n"],
                )

    schema = "unit long, texts binary, lengths binary, text binary, place binary, side binary, keys binary, n long"
    return table.mapInArrow(extend, schema)


def _spans(begin: np.ndarray, end: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite the spans [begin, end) of each text: (begin, end, text), sorted."""
    order = np.lexsort((begin, of))
    begin, end, of = begin[order], end[order], of[order]
    # Moved apart by text, so that one running maximum serves all.
    step = int(end.max()) + 2
    b, e = begin + of * step, end + of * step
    reach = np.maximum.accumulate(e)
    new = np.ones(len(b), bool)
    new[1:] = b[1:] > reach[:-1]
    starts = np.flatnonzero(new)
    last = np.append(starts[1:], len(b)) - 1
    return begin[starts], reach[last] - of[starts] * step, of[starts]


def _span_rows(begin, end, of, keys: list[bytes]) -> pa.RecordBatch:
    """A row per text that has spans: (key, spans as pairs of 64-bit numbers)."""
    held, at = np.unique(of, return_index=True)
    pairs = np.column_stack([begin, end]).astype(np.int64)
    blobs = [_blob(p) for p in np.split(pairs, at[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array([keys[t] for t in held], pa.binary()), pa.array(blobs, pa.binary())], names=["key", "spans"]
    )


def _candidates(table: DataFrame, n: int, buckets: int) -> DataFrame:
    """(key, spans): where windows of n words can begin that hold a repeated doubled run."""
    base = math.ceil(n / 4)

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys = np.frombuffer(r["keys"], np.uint64)
                alive = _flags(keys.reshape(-1, 1), r["replies"], buckets)
                of = np.frombuffer(r["text"], np.uint32)[alive].astype(np.int64)
                place = np.frombuffer(r["place"], np.uint32)[alive].astype(np.int64)
                right = np.frombuffer(r["side"], np.uint8)[alive] == 0
                last = np.frombuffer(r["lengths"], np.uint32).astype(np.int64)[of] - n
                begin = np.maximum(np.where(right, place + 2 * base, place + base) - n, 0)
                end = np.minimum(np.where(right, place, place - base), last) + 1
                some = begin < end
                if some.any():
                    texts = [r["texts"][k : k + _KEY_BYTES] for k in range(0, len(r["texts"]), _KEY_BYTES)]
                    yield _span_rows(*_spans(begin[some], end[some], of[some]), texts)

    return table.mapInArrow(widen, "key binary, spans binary")


def _in_spans(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of all places in the spans of a batch's rows."""
    data, offsets = binary_column(batch.column(column))
    pairs = np.frombuffer(data.tobytes(), np.int64).reshape(-1, 2)
    of = np.repeat(np.arange(batch.num_rows), np.diff(offsets) // 16)
    size = pairs[:, 1] - pairs[:, 0]
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(pairs[:, 0], size) + within, np.repeat(of, size)


def _whole_windows(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """One row per batch of texts (key, text, spans): the 128-bit hashes of the windows that begin in the spans."""

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_column(batch.column(1))
            starts, ends, first = find_words(data, offsets)
            words = word_hashes(data, starts, ends)
            place, of = _in_spans(batch, 2)
            at = first[of] + place
            keys = np.column_stack([window_hashes(words, n)[at], window_hashes(words, n, other=True)[at]])
            _, among, counts, _ = _distinct(keys, buckets)
            held, per_text = np.unique(of, return_counts=True)
            names = batch.column(0).to_pylist()
            spans = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_unit()], pa.int64()),
                    pa.array([_blob(keys)], pa.binary()),
                    pa.array([_blob(among.astype(np.uint32))], pa.binary()),
                    pa.array([np.packbits(counts > 1).tobytes()], pa.binary()),
                    pa.array([[names[t] for t in held]], pa.list_(pa.binary())),
                    pa.array([[spans[t] for t in held]], pa.list_(pa.binary())),
                ],
                names=["unit", "keys", "among", "again", "texts", "spans"],
            )

    schema = "unit long, keys binary, among binary, again binary, texts array<binary>, spans array<binary>"
    return texts.select("key", "text", "spans").mapInArrow(hash_windows, schema)


def _covered(table: DataFrame, n: int) -> DataFrame:
    """(key, spans): words covered by windows that occur again."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                counts = 1 + np.unpackbits(np.frombuffer(r["again"], np.uint8)).astype(np.int64)
                size = sum(reply["n"] for reply in r["replies"])
                alive = _by_place(np.frombuffer(r["among"], np.uint32), counts[:size], r["replies"])
                pairs = [np.frombuffer(s, np.int64).reshape(-1, 2) for s in r["spans"]]
                of = np.concatenate([np.full(int((p[:, 1] - p[:, 0]).sum()), t) for t, p in enumerate(pairs)])
                place = np.concatenate([np.arange(b, e) for p in pairs for b, e in p])
                if alive.any():
                    begin = place[alive]
                    yield _span_rows(*_spans(begin, begin + n, of[alive]), r["texts"])

    return table.mapInArrow(cover, "key binary, spans binary")


def repeated_spans(docs: DataFrame, text_col: str = "text", n: int = WINDOW_WORDS) -> DataFrame:
    """(key, spans) of the texts with repeats: the words that some repeated window of n words covers.

    Three levels, each run being twice as long as at the one before (the last one is cut
    to n words): runs of a quarter of the window, chosen so that equal windows choose alike,
    that occur once are dropped; the others are extended to both sides to runs of half a
    window, and again those that occur once are dropped; only windows around the remaining
    ones are hashed whole. Hashes decide: 64 bits at the first levels, which only choose, 128 at the last.
    """
    if n < 2:
        raise ValueError("a window has at least two words")
    spark = prepare(docs.sparkSession)
    texts = docs.select(text_key(text_col).alias("key"), F.col(text_col).alias("text"))

    def bucket_count(table: DataFrame) -> int:
        total = table.agg(F.sum("n")).first()[0] or 0
        return max(parallelism(spark), math.ceil(total / BUCKET_KEYS))

    first = written(_anchors(texts, n), "anchors")
    buckets = bucket_count(first)
    second = written(_doubled(split_join(first, repeated_keys(first, 1, buckets), "unit"), buckets), "doubled")
    buckets = bucket_count(second)
    found = _candidates(split_join(second, repeated_keys(second, 1, buckets), "unit"), n, buckets)
    # Copies of a text have the same candidates.
    places = written(found.groupBy("key").agg(F.first("spans").alias("spans")), "candidates")
    # A window for each place in the spans; as many buckets as for all anchors are enough for those.
    buckets = 2 * bucket_count(first)
    third = written(_whole_windows(split_join(texts, places, "key"), n, buckets), "windows")
    answered = split_join(third.drop("keys"), repeated_keys(third, 2, buckets), "unit")
    return written(_covered(answered, n).groupBy("key").agg(F.first("spans").alias("spans")), "covered")


def remove_repeats(docs: DataFrame, text_col: str = "text", n: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: (row, n_words, n_removed, kept_text); `row` holds all its columns.

    Words are runs between white space, unchanged. A word goes if it is covered by a window
    of n words whose sequence also begins anywhere else, in the same document or another,
    as the input has it; `kept_text` is the other words joined by one blank. Null and empty
    texts have no words. Repeated rows repeat each other's windows. All rows stay, whatever
    their ids; an empty table stays empty.
    """
    removed = repeated_spans(docs, text_col, n)
    keyed = docs.select(whole_row(docs).alias("row"), text_key(text_col).alias("key"))
    joined = split_join(keyed, removed, "key", "left").select("row", "spans")
    schema = T.StructType(
        [
            joined.schema["row"],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_column(pc.struct_field(batch.column(0), [text_col]))
            starts, ends, first = find_words(data, offsets)
            place, of = _in_spans(batch, 1)
            gone = np.zeros(len(starts), bool)
            gone[first[of] + place] = True
            before = np.concatenate([[0], np.cumsum(gone)])
            raw, kept = data.tobytes(), []
            for t in range(batch.num_rows):
                a, b = first[t], first[t + 1]
                words = raw[offsets[t] : offsets[t + 1]].split()
                if before[b] > before[a]:
                    words = [w for w, g in zip(words, gone[a:b].tolist(), strict=True) if not g]
                kept.append(b" ".join(words))
            sizes = np.cumsum([0, *map(len, kept)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(before[first[1:]] - before[first[:-1]], pa.int64()),
                    binary_array(np.frombuffer(b"".join(kept), np.uint8), sizes).cast(pa.string()),
                ],
                names=["row", "n_words", "n_removed", "kept_text"],
            )

    return joined.mapInArrow(cut, schema)
