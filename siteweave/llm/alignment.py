"""Align the tokens of two tokenizers and score the alignment by inverted pair bitmaps."""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import split_join
from .common import prepare, slices, written

# Documents of one unit, whose places in it are the bits of the bitmaps, and (pair, document) entries of a unit.
UNIT_DOCS = 4096
UNIT_ENTRIES = 1 << 22
# Parts of texts, and links in them, that are remembered.
CACHED_PARTS = 300_000
CACHED_LINKS = 1 << 22
_TEXT_BYTES = 4 << 20
# A pair of ids is one number.
_B_BITS = 24


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The byte for which each character stands in a byte-level vocabulary: itself if visible, else from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Tokenizers:
    """Both tokenizers, and whether they can be asked for parts of texts.

    A blank and what follows it up to the next run of blanks is a part. The byte-level tokenizer
    never joins a character and a blank behind it, and neither does the piece tokenizer
    unless some piece of its vocabulary does; then a text's tokens are those of its parts.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes_a[i] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        with open(path_a) as file:
            how = json.load(file)
        cut = how.get("pre_tokenizer") or {}
        by_words = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        joined = any(re.search("[^▁]▁", p) for p in pieces)
        as_given = self._text_b("a  b ") == "  a  b ".replace("  a", " a")
        self.splits = bool(by_words and not how.get("normalizer") and not joined and as_given)

    def _text_b(self, text: str) -> str:
        return b"".join(self.bytes_b[i] for i in self.b.encode(text)).decode("utf-8", "replace")

    def parts(self, text: str) -> list[str]:
        return re.findall(" +[^ ]*", " " + text) if self.splits else [" " + text]

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        ids_a = [e.ids for e in self.a.encode_batch(parts, add_special_tokens=False)]
        # The piece tokenizer puts a blank before a text, but none where the text is empty.
        ids_b = self.b.encode([p[1:] for p in parts], num_threads=1)
        blank = self.b.encode("a ")[len(self.b.encode("a")) :]
        return ids_a, [blank if p == " " else ids for p, ids in zip(parts, ids_b, strict=True)]


def link_tokens(ids_a: list[int], ids_b: list[int], ends_a: list[int], ends_b: list[int]) -> tuple[str, list[int], int]:
    """(groups as text, the linked pairs, number of groups) of tokens that cover the same bytes."""
    groups, links = [], []
    i = j = from_a = from_b = 0
    while i < len(ids_a):
        links.append(ids_a[i] << _B_BITS | ids_b[j])
        a, b = ends_a[i], ends_b[j]
        i += a <= b
        j += b <= a
        if a == b:
            groups.append(f"{','.join(map(str, ids_a[from_a:i]))}|{','.join(map(str, ids_b[from_b:j]))}")
            from_a, from_b = i, j
    return ";".join(groups), links, len(groups)


class _Parts(dict):
    """Numbers of parts of texts, and what is known of each part."""

    def __init__(self, tokenizers: Tokenizers):
        super().__init__()
        self.tokenizers = tokenizers
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new, self.groups, self.links = [], [], array("q")
        self.sizes = array("q")  # n_a, n_b, n_groups, end among the links; a part that is not given back: -1

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.new.append(part)
        return number

    def learn(self) -> None:
        """Encode the parts that are new."""
        if not self.new:
            return
        t = self.tokenizers
        for part, a, b in zip(self.new, *t.encode(self.new), strict=True):
            raw_a, raw_b = [t.bytes_a[i] for i in a], [t.bytes_b[i] for i in b]
            if (raw := part.encode()) == b"".join(raw_a) == b"".join(raw_b) and raw:
                ends_a, ends_b = list(accumulate(map(len, raw_a))), list(accumulate(map(len, raw_b)))
                groups, links, n = link_tokens(a, b, ends_a, ends_b)
                self.links.extend(links)
                self.groups.append(groups)
                self.sizes.extend((len(a), len(b), n, len(self.links)))
            else:
                self.groups.append("")
                self.sizes.extend((-1, 0, 0, len(self.links)))
        self.new = []


def _containers(row: np.ndarray, place: np.ndarray, rows: int, size: int) -> pa.Array:
    """A compressed bitmap per row: its places as 16-bit numbers, or `size` bits where those are shorter.

    `row` ascends, and so do the places of a row. Bitmaps have an even number of bytes.
    """
    wide = 2 * ((size + 15) // 16)
    n = np.bincount(row, minlength=rows)
    dense = 2 * n >= wide
    offsets = np.concatenate([[0], np.cumsum(np.where(dense, wide, 2 * n))])
    out = np.zeros(offsets[-1], np.uint8)
    within = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    listed = ~dense[row]
    out.view("<u2")[offsets[row[listed]] // 2 + within[listed]] = place[listed]
    r, p = row[~listed], place[~listed]
    np.add.at(out, offsets[r] + p // 8, (1 << (p % 8)).astype(np.uint8))
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)]
    return pa.Array.from_buffers(pa.binary(), rows, buffers)


def _places(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of all bits in compressed bitmaps."""
    wide = 2 * ((size + 15) // 16)
    raw = column.buffers()[2]
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    length = np.diff(offsets)
    dense = length == wide
    listed = np.flatnonzero(~dense)
    n = length[listed] // 2
    at = np.repeat(offsets[listed], n) + 2 * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    rows, places = [np.repeat(listed, n)], [data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8]
    full = np.flatnonzero(dense)
    for k in range(0, len(full), 1024):
        some = full[k : k + 1024]
        bits = np.unpackbits(data[offsets[some][:, None] + np.arange(wide)], axis=1, bitorder="little")
        r, p = np.nonzero(bits)
        rows.append(some[r])
        places.append(p)
    return np.concatenate(rows), np.concatenate(places)


def _postings(keys: list[np.ndarray], counts: list[np.ndarray], unit: int, size: int) -> dict[str, pa.Array]:
    """One row per pair of a unit: the bitmap of its documents, and planes of how often more than once.

    Every slice of texts gives sorted (pair, document) entries; they are merged, which ORs their bitmaps.
    """
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, more = key[order], count[order] - 1
    pair, place = key >> 16, key & 0xFFFF
    new = np.ones(len(key), bool)
    new[1:] = pair[1:] != pair[:-1]
    row = np.cumsum(new) - 1
    pairs = pair[new]
    links = np.add.reduceat(more + 1, np.flatnonzero(new))
    most = np.maximum.reduceat(more, np.flatnonzero(new))
    planes = np.zeros(len(pairs), np.int64)
    while (most >> planes).any():
        planes += (most >> planes) > 0
    ends = np.concatenate([[0], np.cumsum(planes)])
    plane_rows, plane_places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(int(planes.max())):
        held = np.flatnonzero(more >> k & 1)
        plane_rows.append(ends[row[held]] + k)
        plane_places.append(place[held])
    plane_row, plane_place = np.concatenate(plane_rows), np.concatenate(plane_places)
    order = np.argsort(plane_row, kind="stable")
    bitmaps = _containers(plane_row[order], plane_place[order], int(ends[-1]), size)
    n = len(pairs)
    return {
        "unit": pa.array(np.full(n, unit), pa.int64()),
        "size": pa.array(np.full(n, size), pa.int32()),
        "pair": pa.array(pairs, pa.int64()),
        "documents": _containers(row, place, n, size),
        "planes": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), bitmaps),
        "n_documents": pa.array(np.bincount(row), pa.int64()),
        "n_links": pa.array(links, pa.int64()),
    }


_DOCUMENT = "unit long, place int, id {id}, n_a long, n_b long, n_groups long, n_tied long, groups string"
_POSTING = "size int, pair long, documents binary, planes array<binary>, n_documents long, n_links long"


def _aligned(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents (pair is null) and rows of postings (id is null), by unit."""
    schema = T.StructType.fromDDL(f"{_DOCUMENT.format(id=texts.schema['id'].dataType.simpleString())}, {_POSTING}")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(schema)
        parts = _Parts(Tokenizers(path_a, path_b))

        def rows(columns: dict[str, pa.Array]) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays(
                [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields],
                names=fields.names,
            )

        unit, held, keys, counts = uuid.uuid4().int >> 65, 0, [], []
        for batch in batches:
            for part in slices(batch, 1, _TEXT_BYTES):
                if held and (held + part.num_rows > UNIT_DOCS or sum(map(len, keys)) > UNIT_ENTRIES):
                    if keys:
                        yield rows(_postings(keys, counts, unit, held))
                    unit, held, keys, counts = uuid.uuid4().int >> 65, 0, [], []
                if len(parts) > CACHED_PARTS or len(parts.links) > CACHED_LINKS:
                    parts.reset()
                numbers = [
                    np.array([parts[p] for p in parts.tokenizers.parts(text)] if text else [], np.int64)
                    for text in part.column(1).to_pylist()
                ]
                parts.learn()
                first = np.concatenate([[0], np.cumsum([len(n) for n in numbers])]).astype(np.int64)
                of_part = np.concatenate(numbers) if len(numbers) else np.empty(0, np.int64)
                sizes = np.array(parts.sizes, np.int64).reshape(-1, 4)
                doc = np.repeat(np.arange(len(numbers)), np.diff(first))
                good = np.ones(len(numbers), bool)
                good[doc[sizes[of_part, 0] < 0]] = False
                ends = np.concatenate([[0], sizes[:, 3]])
                n_links = np.diff(ends)

                def total(values, first=first, good=good):
                    sums = np.concatenate([[0], np.cumsum(values)])
                    return np.where(good, sums[first[1:]] - sums[first[:-1]], 0)

                yield rows(
                    {
                        "unit": pa.array(np.full(part.num_rows, unit), pa.int64()),
                        "place": pa.array(held + np.arange(part.num_rows), pa.int32()),
                        "id": part.column(0),
                        "n_a": pa.array(total(sizes[of_part, 0])),
                        "n_b": pa.array(total(sizes[of_part, 1])),
                        "n_groups": pa.array(total(sizes[of_part, 2])),
                        "n_tied": pa.array(total(n_links[of_part])),
                        "groups": pa.array(
                            [";".join([parts.groups[p] for p in n.tolist()]) if g else "" for n, g in zip(numbers, good, strict=True)],
                            pa.string(),
                        ),
                    }
                )
                use = good[doc]
                of_part, doc = of_part[use], doc[use]
                n = n_links[of_part]
                at = np.repeat(ends[of_part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                key = np.array(parts.links, np.int64)[at] << 16 | np.repeat(doc + held, n)
                if len(key):
                    key, count = np.unique(key, return_counts=True)
                    keys.append(key)
                    counts.append(count)
                held += part.num_rows
        if keys:
            yield rows(_postings(keys, counts, unit, held))

    return texts.mapInArrow(align, schema)


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, a, b, documents, links, best): how many documents and links hold a pair of ids.

    The units' bitmaps hold different documents, so their population counts add up; they are summed
    in every task before the shuffle. `best` tells whether no pair of the same B id has more links.
    """
    counted = postings.groupBy("pair").agg(F.sum("n_documents").alias("documents"), F.sum("n_links").alias("links"))
    counted = written(
        counted.select(
            "pair",
            F.shiftright("pair", _B_BITS).cast("int").alias("a"),
            F.col("pair").bitwiseAND((1 << _B_BITS) - 1).cast("int").alias("b"),
            "documents",
            "links",
        ),
        "pairs",
    )
    most = counted.groupBy("b").agg(F.max("links").alias("most"))
    return split_join(counted, most, "b").select(*counted.columns, (F.col("links") == F.col("most")).alias("best"))


def _returned(postings: DataFrame, pairs: DataFrame) -> DataFrame:
    """(unit, place, n_best, count_sum): what the postings of a unit give back to its documents."""

    def give(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        size = group["size"][0].as_py()
        links = group["links"].to_numpy()
        best = group["best"].to_numpy().astype(np.int64)
        n_best, count_sum = np.zeros(size, np.int64), np.zeros(size, np.int64)

        def add(bitmaps: pa.Array, row: np.ndarray, times: np.ndarray) -> None:
            at, place = _places(bitmaps, size)
            np.add.at(count_sum, place, links[row[at]] * times[at])
            np.add.at(n_best, place, best[row[at]] * times[at])

        documents, planes = group["documents"].chunk(0), group["planes"].chunk(0)
        add(documents, np.arange(len(links)), np.ones(len(links), np.int64))
        ends = np.array(planes.offsets, np.int64)
        row = np.repeat(np.arange(len(links)), np.diff(ends))
        plane = np.arange(len(row)) - (ends[:-1] - ends[0])[row]
        add(planes.flatten(), row, 1 << plane)
        return pa.table(
            {
                "unit": pa.array(np.full(size, group["unit"][0].as_py()), pa.int64()),
                "place": pa.array(np.arange(size), pa.int32()),
                "n_best": pa.array(n_best),
                "count_sum": pa.array(count_sum),
            }
        )

    held = postings.select("unit", "size", "pair", "documents", "planes")
    scored = split_join(held, pairs.select("pair", "links", "best"), "pair").drop("pair")
    return scored.groupBy("unit").applyInArrow(give, "unit long, place int, n_best long, count_sum long")


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per document: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    A (byte-level) encodes a blank and the text, B (pieces) the text, both without special tokens.
    Tokens of A and B are linked where their bytes overlap; the places where both end cut them
    into groups, written as `a1,a2|b1;a3|b2`. Of each pair of ids an inverted bitmap per unit of
    documents is kept, with planes for links beyond the first; their counts are joined back to
    the postings, which give every document the number of its links whose pair is the best of its
    B id (`n_best`) and the sum of its links' counts (`count_sum`). `groups` may turn the text of the groups
    into what is kept of it, such as a digest.

    Null and empty texts, and texts that the tokens of A or B don't give back byte by byte, have no tokens: zeros and
    an empty text. Every row counts, also repeated ones and those without id. An empty table gives
    none. Only the two named columns are read.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    table = _aligned(texts, path_a, path_b)
    if groups is not None:
        table = table.withColumn("groups", F.when(F.col("pair").isNull(), groups(F.col("groups"))))
    table = written(table, "alignment")
    postings = table.filter("pair IS NOT NULL")
    given = _returned(postings, pair_counts(postings))
    rows = table.filter("pair IS NULL").join(given, ["unit", "place"], "left")
    return rows.select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_tied").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups",
    )
