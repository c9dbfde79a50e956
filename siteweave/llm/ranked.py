"""Ranked lexical search: short lists summed first, long lists skipped through."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_column, byte_table, find_words, prepare, slices, written

TOP = 10
# Documents, and places in lists, of one block of the index.
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 1 << 22
# Documents of a block that are scored together.
RANGE_DOCS = 2048
# Lists of at most so many documents of a range are summed before the others are read.
SHORT_LIST = 64
# Items that are asked in one pass over the index, and the bytes of their texts.
ITEMS_AT_ONCE = 4096
ITEM_BYTES = 8 << 20
_TEXT_BYTES = 4 << 20

# Terms are runs of ASCII letters and digits and of all that is not ASCII.
IN_TERMS = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def find_terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all terms of the texts, first): `first` tells where each text's terms begin; A-Z is lower-cased."""
    data, offsets = binary_column(column)
    data = _LOWER[data]
    starts, ends, first = find_words(data, offsets, IN_TERMS)
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = np.ascontiguousarray(data[IN_TERMS[data]])
    terms = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(letters)]
    )
    return terms, first


def _index(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Blocks of documents: their ids and sizes, and the lists of the vocabulary's terms in them."""

    def block(parts: list) -> pa.RecordBatch:
        ids, sizes, terms, places, counts = zip(*parts, strict=True)
        sizes, terms = np.concatenate(sizes), np.concatenate(terms)
        places, counts = np.concatenate(places), np.concatenate(counts)
        # Within a part the lists lie by term and document, and parts follow each other.
        order = np.argsort(terms, kind="stable")
        held, lengths = np.unique(terms, return_counts=True)
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([np.count_nonzero(sizes)], pa.int64()),
                pa.array([sizes.sum()], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays(ids)),
                one(sizes, pa.int64()),
                one(held, pa.int32()),
                one(lengths, pa.int32()),
                pa.array([places[order].astype("<u4").tobytes()], pa.binary()),
                pa.array([counts[order].astype("<u4").tobytes()], pa.binary()),
            ],
            names=["n_docs", "n_terms", "ids", "sizes", "terms", "lengths", "places", "counts"],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs_held, held = [], 0, 0
        for batch in batches:
            for part in slices(batch, 1, _TEXT_BYTES):
                terms, first = find_terms(part.column(1))
                sizes = np.diff(first)
                which = pc.index_in(terms, value_set=vocabulary)
                hit = np.flatnonzero(pc.is_valid(which).to_numpy(zero_copy_only=False))
                term = pc.fill_null(which, 0).to_numpy(zero_copy_only=False)[hit].astype(np.int64)
                of = np.searchsorted(first, hit, side="right") - 1
                keys, counts = np.unique(term << 32 | of, return_counts=True)
                if parts and (docs_held + len(sizes) > BLOCK_DOCS or held + len(keys) > BLOCK_POSTINGS):
                    yield block(parts)
                    parts, docs_held, held = [], 0, 0
                parts.append((part.column(0), sizes, keys >> 32, (keys & 0xFFFFFFFF) + docs_held, counts))
                docs_held, held = docs_held + len(sizes), held + len(keys)
        if parts:
            yield block(parts)

    schema = (
        "n_docs long, n_terms long, ids array<long>, sizes array<long>, terms array<int>, lengths array<int>, "
        "places binary, counts binary"
    )
    return docs.mapInArrow(build, schema)


class _Best:
    """The k best documents of an item so far."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.missing = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """The score that a document must reach to be among them, where equal scores may still go by id."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, missing = np.concatenate([self.ids, ids]), np.concatenate([self.missing, missing])
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


def score_range(lists: list[tuple[np.ndarray, np.ndarray, int]], n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a range of n documents that reach `least`, and maybe some that don't.

    `lists` holds (documents, scores, largest score) per term. Short lists are summed term
    at a time into accumulators, which from then on are one iterator with a bound of its own. It and
    the long lists are ordered by their bounds: those that together stay below `least` give
    no candidates; they are only probed for the documents of the others, largest bound first, as long as
    a document can still reach `least`.
    """
    total = np.zeros(n, np.int64)
    short = [x for x in lists if len(x[0]) <= SHORT_LIST]
    iterators = [x for x in lists if len(x[0]) > SHORT_LIST]
    if short:
        for documents, scores, _ in short:
            total[documents] += scores
        documents = np.flatnonzero(total)
        scores = total[documents]
        iterators.append((documents, scores, int(scores.max(initial=0))))
        total[documents] = 0
    iterators.sort(key=lambda x: x[2])
    reach, rest = 0, 0
    while rest < len(iterators) and reach + iterators[rest][2] < least:
        reach += iterators[rest][2]
        rest += 1
    seen = np.zeros(n, bool)
    for documents, scores, _ in iterators[rest:]:
        total[documents] += scores
        seen[documents] = True
    found = np.flatnonzero(seen)
    scores = total[found]
    for documents, more, bound in reversed(iterators[:rest]):
        alive = scores + reach >= least
        found, scores = found[alive], scores[alive]
        if not len(found):
            break
        at = np.searchsorted(documents, found)
        at[at == len(documents)] = 0
        scores = scores + np.where(documents[at] == found, more[at], 0)
        reach -= bound
    alive = scores >= least
    return found[alive], scores[alive]


def _search(blocks: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, n_docs: int, n_terms: int, k: int):
    """(item, doc_id, score): the k best documents of every item among those that a task reads."""

    def ranges(row: dict):
        """Per range of documents: (first, ids, missing, lists by term)."""
        sizes = np.array(row["sizes"], np.int64)
        places = np.frombuffer(row["places"], "<u4").astype(np.int64)
        counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        terms, lengths = np.array(row["terms"], np.int64), np.array(row["lengths"], np.int64)
        of = np.repeat(np.arange(len(terms)), lengths)
        length_part = 100 - 75 + (75 * sizes * n_docs) // n_terms
        scores = weight[terms[of]] * ((1_000_000_000 * counts) // (1000 * counts + 8 * length_part[places]))
        keys = of << 32 | places
        for begin in range(0, len(sizes), RANGE_DOCS):
            edges = np.arange(len(terms), dtype=np.int64) << 32
            low, high = np.searchsorted(keys, edges + begin), np.searchsorted(keys, edges + begin + RANGE_DOCS)
            some = np.flatnonzero(high > low)
            lists = {}
            for t in some.tolist():
                part = scores[low[t] : high[t]]
                lists[int(terms[t])] = (places[low[t] : high[t]] - begin, part, int(part.max()))
            yield begin, min(RANGE_DOCS, len(sizes) - begin), lists

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in items]
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                listed = row.column("ids").flatten()
                missing = pc.is_null(listed).to_numpy(zero_copy_only=False)
                ids = pc.fill_null(listed, 0).to_numpy(zero_copy_only=False)
                whole = {c: row.column(c)[0].as_py() for c in ("sizes", "terms", "lengths", "places", "counts")}
                for begin, n, lists in ranges(whole):
                    for i, (terms, times) in enumerate(items):
                        asked = [
                            (lists[t][0], lists[t][1] * q, lists[t][2] * q) if q > 1 else lists[t]
                            for t, q in zip(terms, times, strict=True)
                            if t in lists
                        ]
                        if asked:
                            found, scores = score_range(asked, n, best[i].least)
                            if len(found):
                                best[i].add(scores, ids[found + begin], missing[found + begin])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(items)), [len(b.scores) for b in best]), pa.int32()),
                pa.array(
                    np.concatenate([b.ids for b in best] + [np.empty(0, np.int64)]),
                    pa.int64(),
                    mask=np.concatenate([b.missing for b in best] + [np.empty(0, bool)]),
                ),
                pa.array(np.concatenate([b.scores for b in best] + [np.empty(0, np.int64)]), pa.int64()),
            ],
            names=["item", "doc_id", "score"],
        )

    return blocks.mapInArrow(search, "item int, doc_id long, score long")


def _rank_slice(docs: DataFrame, asked: pa.Table, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    terms, first = find_terms(asked.column("text").combine_chunks())
    vocabulary = terms.unique()
    if not len(vocabulary):
        return None
    numbers = pc.index_in(terms, value_set=vocabulary).to_numpy(zero_copy_only=False)
    items = []
    for i in range(asked.num_rows):
        held, times = np.unique(numbers[first[i] : first[i + 1]], return_counts=True)
        items.append((held.tolist(), times.tolist()))
    blocks = written(_index(docs, vocabulary), "blocks")
    whole = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = whole[0] or 0, whole[1] or 0
    if not n_terms:
        return None
    held = blocks.select(F.inline(F.arrays_zip("terms", "lengths"))).groupBy("terms").agg(F.sum("lengths").alias("n"))
    weight = np.zeros(len(vocabulary), np.int64)
    # One row per term of the items of this pass.
    for term, n in held.collect():
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
    found = _search(blocks, items, weight, n_docs, n_terms, k)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame(
        list(enumerate(asked.column("id").to_pylist())), f"item int, item_id {_spark_type(asked)}"
    )
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _spark_type(asked: pa.Table) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(asked.schema.field("id").type).simpleString()


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = TOP,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0.

    Documents are dealt into blocks; a block holds the lists of the items' terms over its
    documents. Each task searches its blocks for all items of a pass, going through
    ranges of documents and keeping the k best, whose last score lets it skip. The items of one
    pass are bounded by number and bytes, and with them all that reaches the driver
    or is sent to all tasks; more items take more passes.

    Null and empty texts have no terms: such documents are never found and don't count, such
    items get no rows, and so do items none of whose terms occur. Equal scores go by ascending
    id, a null id last. Rows that repeat a document's id are documents of their own; items that
    share an id each give their rows. Empty tables give none.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{doc_text}`").alias("text"))
    asked = items.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{item_text}`").alias("text"))
    n, size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    passes = max(1, math.ceil(n / ITEMS_AT_ONCE), math.ceil((size or 0) / ITEM_BYTES))
    # Dealt by number, so that rows that are alike don't meet in one pass.
    asked = written(asked.withColumn("pass", F.pmod(F.monotonically_increasing_id(), F.lit(passes))), "items")
    out = None
    for i in range(passes):
        table = asked.filter(F.col("pass") == i).select("id", "text").toArrow()
        ranked = _rank_slice(texts, table, k) if table.num_rows else None
        if ranked is not None:
            out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        kind = asked.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out
