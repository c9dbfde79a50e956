"""Remove repeated byte strings found by building a collection's transform column by column."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import split_join
from .common import _powers, binary_column, mix, parallelism, prepare, salted, whole_row, window_starts, written

STRING_BYTES = 100
# A string's anchor is the first of its runs of so many bytes that has the smallest hash.
ANCHOR_BYTES = 12
# Windows of a long text that are cut into pieces together, and bytes of a unit of texts.
SEGMENT = 1 << 20
UNIT_BYTES = 2 << 20
# Bytes of text whose pieces make a collection; pieces overlap, which makes about three times as many.
COLLECTION_BYTES = 4 << 20
# Frequent anchors come last in the choice. They are looked for in one of so many texts,
# where they occur so often at least, and they are so many at most.
SAMPLE_ONE_OF = 512
SAMPLE_LEAST = 16
MOST_FREQUENT = 1 << 20

_LAST = np.iinfo(np.int64).max


def _settled(df: DataFrame) -> DataFrame:
    """The rows in an order that a repeated read gives again: a scan is left as it is, else a table is written."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return df if "FileScan" in plan and "Exchange" not in plan and "Join" not in plan else written(df, "documents")


def run_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the run of ANCHOR_BYTES (9 to 16) from each place on; the last places run into zeros."""
    padded = np.concatenate([data, np.zeros(24, np.uint8)])
    n = len(data)
    words = np.empty(n + 8, np.uint64)
    for r in range(8):
        count = len(words[r::8])
        words[r::8] = padded[r : r + 8 * count].view("<u8")
    rest = words[8:] & np.uint64((1 << 8 * (ANCHOR_BYTES - 8)) - 1)
    return mix(words[:n] ^ mix(rest + np.uint64(0x9E3779B97F4A7C15)))


def _sample_runs(texts: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_column(batch.column(0))
            for begin in range(0, len(data), UNIT_BYTES):
                part = data[begin : begin + UNIT_BYTES + ANCHOR_BYTES - 1]
                at, _ = window_starts(np.clip(offsets - begin, 0, len(part)), ANCHOR_BYTES)
                runs, n = np.unique(run_hashes(part)[at], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(n)], names=["run", "n"])

    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_ONE_OF)) == 0)
    return sample.select("text").mapInArrow(count, "run long, n long")


def frequent_runs(texts: DataFrame, size: int) -> np.ndarray:
    """Hashes of runs that occur very often, sorted.

    They only shape the choice of anchors, so that pieces are dealt evenly; results are the
    same whatever they are.
    """
    least = max(SAMPLE_LEAST, math.ceil(size / SAMPLE_ONE_OF / MOST_FREQUENT))
    found = _sample_runs(texts).groupBy("run").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    runs = [r[0] for r in found.select("run").collect()]  # as many as the bound says, by the size of the sample
    return np.sort(np.array(runs, np.int64).view(np.uint64))


def _anchors(data: np.ndarray, runs: np.ndarray, frequent: np.ndarray, n: int) -> np.ndarray:
    """The anchor's place for the string of n bytes that begins at each place, as far as such strings fit."""
    rank = runs >> np.uint64(33)
    if len(frequent):
        short = np.zeros(1 << 20, bool)
        short[frequent >> np.uint64(44)] = True
        maybe = np.flatnonzero(short[runs >> np.uint64(44)])
        at = np.minimum(np.searchsorted(frequent, runs[maybe]), len(frequent) - 1)
        rank[maybe[frequent[at] == runs[maybe]]] |= np.uint64(1 << 31)
    best = rank << np.uint64(32) | np.arange(len(data), dtype=np.uint64)
    reach, span = n - ANCHOR_BYTES + 1, 1
    while 2 * span <= reach:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < reach:
        best = np.minimum(best[: len(best) - (reach - span)], best[reach - span :])
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _united(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans [begin, end) united, also where one begins as another ends."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    reach = np.maximum.accumulate(end)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    starts = np.flatnonzero(new)
    return begin[starts], reach[np.append(starts[1:], len(begin)) - 1]


def _pack_spans(of: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bytes:
    return np.stack([of, begin, end]).astype("<i8").tobytes()


def _unpack_spans(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8").reshape(3, -1)


# What a piece is, besides its bytes.
_PIECE = np.dtype([("segment", "<u4"), ("anchor", "<i8"), ("doc", "<i8"), ("before", "u1"), ("strings", "u1")])


def _pack_pieces(about: np.ndarray) -> bytes:
    """Column by column, as steps from piece to piece, which are small."""
    steps = [np.diff(about[f], prepend=about[f].dtype.type(0)) for f in _PIECE.names]
    return len(about).to_bytes(8, "little") + b"".join(s.tobytes() for s in steps)


def _unpack_pieces(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(what the pieces are, their bytes)."""
    size, at = int.from_bytes(raw[:8], "little"), 8
    about = np.empty(size, _PIECE)
    for name in _PIECE.names:
        kind = _PIECE[name]
        about[name] = np.cumsum(np.frombuffer(raw, kind, size, at), dtype=kind)
        at += size * kind.itemsize
    return about, np.frombuffer(raw, np.uint8, offset=at)


def _pieces(texts: DataFrame, frequent: np.ndarray, collections: int, n: int) -> DataFrame:
    """(collection, unit, head, body): the pieces of every unit of texts, packed by collection.

    A piece is a run of strings of n bytes that share their anchor. Its collection follows from
    the anchor's bytes, so that equal strings meet, at equal distances from their anchors. Pieces
    alike in a unit are sent once, the first of them; the strings of the others are known to repeat.
    A unit's head has its texts and those spans, and travels with the pieces of one collection.
    """

    def cut_unit(segments: list[tuple[int, bytes, int, bytes]]) -> pa.RecordBatch:
        import xxhash
        import zstandard

        press = zstandard.ZstdCompressor(level=6)
        docs, names, bases, raw = zip(*segments, strict=True)
        docs, bases = np.array(docs, np.int64), np.array(bases, np.int64)
        # Texts that come again give the same unit, so a task that is run again gives the same numbers.
        unit = xxhash.xxh3_64_intdigest(b"".join(names) + bases.tobytes()) >> 1
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum(list(map(len, raw)))])
        at, of = window_starts(offsets, n)
        rows = []
        spans = np.empty((3, 0), np.int64)
        if len(at):
            runs = run_hashes(data)
            anchor = _anchors(data, runs, frequent, n)[at]
            new = np.ones(len(at), bool)
            new[1:] = anchor[1:] != anchor[:-1]
            begins = np.flatnonzero(new)
            first, last = at[begins], at[np.append(begins[1:], len(at)) - 1]
            anchor, of = anchor[begins], of[begins]
            shift = bases[of] - offsets[of]  # from places in the unit to places in the document
            order_of = np.unique(docs, return_inverse=True)[1].astype(np.int64)
            place = order_of[of] << 40 | (anchor + shift)
            same = [salted((anchor - first).astype(np.uint64), 3) + salted((last - first).astype(np.uint64), 4)] * 2
            letter = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            for k, base in enumerate((0x9E3779B97F4A7C15, 0xD1342543DE82EF95)):
                up, down = _powers(base, len(data))
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letter[data] * up[:-1], dtype=np.uint64)])
                same[k] = mix(same[k] + (sums[last + n] - sums[first]) * down[first])
            order = np.lexsort((place, *same))
            head = np.ones(len(order), bool)
            head[1:] = (same[0][order[1:]] != same[0][order[:-1]]) | (same[1][order[1:]] != same[1][order[:-1]])
            group = np.cumsum(head) - 1
            again = np.zeros(len(order), bool)
            again[order] = place[order] > place[order[np.flatnonzero(head)]][group]
            spans = np.stack([of[again], (first + shift)[again], (last + shift)[again] + n])
            sent = np.flatnonzero(~again)
            target = (mix(runs[anchor[sent]] + np.uint64(1)) % np.uint64(collections)).astype(np.int64)
            order = np.argsort(target, kind="stable")
            sent, target = sent[order], target[order]
            about = np.empty(len(sent), _PIECE)
            about["segment"], about["anchor"] = of[sent], (anchor + shift)[sent]
            about["doc"], about["before"] = docs[of[sent]], (anchor - first)[sent]
            about["strings"] = (last - first)[sent] + 1
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(target)) + 1, [len(sent)]])
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = sent[low:high]
                length = last[own] - first[own] + n
                places = np.repeat(first[own] - (np.cumsum(length) - length), length) + np.arange(length.sum())
                body = _pack_pieces(about[low:high]) + data[places].tobytes()
                rows.append((int(target[low]), unit, None, press.compress(body)))
        united = _pack_spans(*spans)
        known = len(segments).to_bytes(8, "little") + b"".join(names) + bases.astype("<i8").tobytes() + united
        rows.append((unit % collections, unit, press.compress(known), None))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.binary()),
                pa.array([r[3] for r in rows], pa.binary()),
            ],
            names=["collection", "unit", "head", "body"],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, size, held = [], 0, set()
        for batch in batches:
            data, offsets = binary_column(batch.column(2))
            for i, (doc, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                low, high = int(offsets[i]), int(offsets[i + 1])
                if high - low < n or key in held:
                    continue
                held.add(key)
                for base in range(0, high - low - n + 1, SEGMENT):
                    raw = data[low + base : min(low + base + SEGMENT + n - 1, high)].tobytes()
                    if size + len(raw) > UNIT_BYTES and segments:
                        yield cut_unit(segments)
                        segments, size, held = [], 0, {key}
                    segments.append((_LAST if doc is None else doc, key, base, raw))
                    size += len(raw)
        if segments:
            yield cut_unit(segments)

    return texts.select("doc", "key", "text").mapInArrow(cut, "collection int, unit long, head binary, body binary")


def repeated_strings(
    first: np.ndarray, count: np.ndarray, letters: np.ndarray, place: np.ndarray, n: int
) -> np.ndarray:
    """repeated[c, p]: whether the string of n bytes at column c of piece p also occurs in a piece of smaller place.

    The pieces are the documents of a collection whose strings lie over columns: piece p has
    bytes in the columns from first[p] on, `count[p]` strings of n bytes, and letters[:, p]. From the last column to
    the first, every round inserts one symbol per piece before its suffix: the symbols in the order of
    the suffixes are the transform's segment of this column; where two symbols that are equal and next to
    each other come from, the smallest common prefix between them, plus one, is that of the new
    suffixes. As symbols of different columns count as different, suffixes of a round go
    to a segment of their own, and a round reads the segment written before and nothing else.
    """
    pieces = len(first)
    end = first + count - 1 + n
    columns = len(letters)
    repeated = np.zeros((columns - n + 1, pieces), bool)
    entering = np.argsort(end, kind="stable")
    bounds = np.searchsorted(end[entering], np.arange(columns + 2))
    order, common = np.empty(0, np.int64), np.empty(0, np.int16)
    for column in range(columns - 1, -1, -1):
        new = entering[bounds[column + 1] : bounds[column + 2]]
        order = np.concatenate([new, order])
        common = np.concatenate([np.zeros(len(new), np.int16), common])
        here = np.flatnonzero(first[order] <= column)
        if not len(here):
            order, common = order[:0], common[:0]
            continue
        segment = letters[column][order[here]]
        moved = np.argsort(segment, kind="stable")
        at, symbol = here[moved], segment[moved]
        smallest = np.minimum.reduceat(np.append(common, np.int16(0)), at + 1)
        common = np.zeros(len(at), np.int16)
        equal = symbol[1:] == symbol[:-1]
        common[1:][equal] = smallest[:-1][equal] + 1
        order = order[at]
        if column <= columns - n:
            alike = common >= n
            if alike.any():
                either = alike.copy()
                either[:-1] |= alike[1:]
                members = order[either]
                heads = np.flatnonzero(~alike[either])
                sizes = np.diff(np.append(heads, len(members)))
                least = np.repeat(np.minimum.reduceat(place[members], heads), sizes)
                repeated[column, members] = place[members] > least
    return repeated


def _judged(pieces: DataFrame, n: int) -> DataFrame:
    """(unit, head, spans): per unit the spans that a collection finds to repeat; heads are passed on."""
    reach = n - ANCHOR_BYTES

    def judge(group: pa.Table) -> pa.Table:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        units, abouts, bodies = [], [], []
        for unit, raw in zip(group["unit"].to_pylist(), group["body"].to_pylist(), strict=True):
            if raw is None:
                continue
            about, body = _unpack_pieces(unpress.decompress(raw))
            units.append(unit)
            abouts.append(about)
            bodies.append(body)
        heads = group.filter(pc.is_valid(group["head"]))
        found = {"unit": heads["unit"].to_pylist(), "head": heads["head"].to_pylist(), "spans": [None] * len(heads)}
        if abouts:
            of_unit = np.repeat(np.arange(len(abouts)), list(map(len, abouts)))
            about = np.concatenate(abouts)
            first = reach - about["before"].astype(np.int64)
            count = about["strings"].astype(np.int64)
            letters = np.zeros((reach + n, len(about)), np.uint8)
            low = 0
            for part, body in zip(abouts, bodies, strict=True):
                high = low + len(part)
                length = count[low:high] - 1 + n
                piece = np.repeat(np.arange(low, high), length)
                column = np.arange(len(body)) - np.repeat(np.cumsum(length) - length - first[low:high], length)
                letters[column, piece] = body
                low = high
            _, doc = np.unique(about["doc"], return_inverse=True)
            place = doc.astype(np.int64) << 40 | about["anchor"]
            repeated = repeated_strings(first, count, letters, place, n)
            some = np.flatnonzero(repeated.any(axis=0))
            flags = np.zeros((len(some), len(repeated) + 2), np.int8)
            flags[:, 1:-1] = repeated[:, some].T
            steps = np.diff(flags, axis=1)
            row, begin = np.nonzero(steps == 1)
            _, end = np.nonzero(steps == -1)
            piece = some[row]
            shift = about["anchor"][piece] - reach
            spans = np.stack([about["segment"][piece].astype(np.int64), begin + shift, end - 1 + shift + n])
            owner = of_unit[piece]
            for u in np.unique(owner).tolist():
                found["unit"].append(units[u])
                found["head"].append(None)
                found["spans"].append(_pack_spans(*spans[:, owner == u]))
        return pa.table(
            {
                "unit": pa.array(found["unit"], pa.int64()),
                "head": pa.array(found["head"], pa.binary()),
                "spans": pa.array(found["spans"], pa.binary()),
            }
        )

    return pieces.groupBy("collection").applyInArrow(judge, "unit long, head binary, spans binary")


def _by_text(judged: DataFrame) -> DataFrame:
    """(key, spans): the spans of each text that has any, as a list of one entry per segment."""

    def gather(group: pa.Table) -> pa.Table:
        import zstandard

        heads = [h for h in group["head"].to_pylist() if h is not None]
        known = zstandard.ZstdDecompressor().decompress(heads[0])  # a unit's heads are all alike
        size = int.from_bytes(known[:8], "little")
        names = [known[8 + 16 * k : 24 + 16 * k] for k in range(size)]
        bases = np.frombuffer(known, "<i8", size, 8 + 16 * size)
        parts = [_unpack_spans(known[8 + 24 * size :])]
        parts += [_unpack_spans(s) for s in group["spans"].to_pylist() if s is not None]
        of, begin, end = np.concatenate(parts, axis=1)
        order = np.argsort(of, kind="stable")
        of, begin, end = of[order], begin[order], end[order]
        held, at = np.unique(of, return_index=True)
        packed = [
            np.stack(_united(b, e)).astype("<i8").tobytes()
            for b, e in zip(np.split(begin, at[1:]), np.split(end, at[1:]), strict=True)
            if len(b)
        ]
        return pa.table(
            {
                "key": pa.array([names[s] for s in held.tolist()], pa.binary()),
                "base": pa.array(bases[held], pa.int64()),
                "spans": pa.array(packed, pa.binary()),
            }
        )

    spans = judged.groupBy("unit").applyInArrow(gather, "key binary, base long, spans binary")
    # Rows alike in id and text have the same spans, so one of them is enough.
    once = spans.groupBy("key", "base").agg(F.first("spans").alias("spans"))
    return once.groupBy("key").agg(F.collect_list("spans").alias("spans"))


def remove_repeated_strings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = STRING_BYTES
) -> DataFrame:
    """One row per document: (row, n_bytes, n_removed, n_spans, kept); `row` holds all its columns.

    A byte of a text's UTF-8 goes if a string of n bytes that covers it also starts earlier: in a document of
    smaller id, or in a document of the same id at a smaller place. Strings are judged on the
    input and never cross documents. `kept` is the other bytes, joined; it need not be UTF-8.
    `n_spans` counts the maximal runs of removed bytes.

    The texts are cut into pieces around anchors, so that equal strings come to the same collection
    at the same distance from their anchor; a collection's pieces are sorted column by column
    (`repeated_strings`). Texts travel once as pieces, about three times their size before they are
    compressed. 31 bits of hashes choose anchors; 128 bits decide only which pieces of a unit are alike.

    Null and empty texts have no bytes. A null id comes after all others. Rows alike in id and text are
    one document; rows of one id and different texts don't make each other's strings at equal
    places repeat. Every row stays; an empty table stays empty.
    """
    if not ANCHOR_BYTES < n <= ANCHOR_BYTES + 255:
        raise ValueError(f"strings have more than {ANCHOR_BYTES} bytes and at most {ANCHOR_BYTES + 255}")
    spark = prepare(docs.sparkSession)
    docs = _settled(docs)
    doc, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    named = F.concat(F.coalesce(doc.cast("string"), F.lit("null")), F.lit(" "), text)
    key = F.substring(F.unhex(F.sha2(named, 256)), 1, 16).alias("key")
    texts = docs.select(doc.alias("doc"), key, text.alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    collections = max(parallelism(spark), math.ceil(size / COLLECTION_BYTES))
    pieces = _pieces(texts, frequent_runs(texts, size), collections, n)
    # A task for each collection, none of which is larger than the others by much.
    spans = written(_by_text(_judged(pieces.repartitionById(collections, "collection"), n)), "spans")
    keyed = docs.select(whole_row(docs).alias("row"), key)
    joined = split_join(keyed, spans, "key", "left").select("row", "spans")
    schema = T.StructType(
        [joined.schema["row"], *T.StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept binary").fields]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_column(pc.struct_field(batch.column(0), [text_col]))
            raw = data.tobytes()
            kept, removed, runs = [], [], []
            for i, blobs in enumerate(batch.column(1).to_pylist()):
                whole = raw[offsets[i] : offsets[i + 1]]
                if not blobs:
                    kept.append(whole)
                    removed.append(0)
                    runs.append(0)
                    continue
                pairs = np.concatenate([np.frombuffer(b, "<i8").reshape(2, -1) for b in blobs], axis=1)
                begin, end = _united(pairs[0], pairs[1])
                low, high = [0, *end.tolist()], [*begin.tolist(), len(whole)]
                kept.append(b"".join([whole[a:b] for a, b in zip(low, high, strict=True)]))
                removed.append(int((end - begin).sum()))
                runs.append(len(begin))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return joined.mapInArrow(cut, schema)
