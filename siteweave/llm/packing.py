"""Pack tokenised documents into sequences by vector best fit."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import assign_uid
from .common import Memo, binary_column, prepare, written

MAX_TOKENS = 2048
END_ID = 0
# Parts of texts whose ids are remembered.
CACHED_WORDS = 400_000
_PIECES = "piece int, start long, length long, ids binary"


def _encoder(path: str):
    """bytes of a text -> its ids as little-endian 32-bit words.

    The tokenizer that is meant works on each part of a text by itself: a run of letters, a
    digit, a run of signs. So a text's ids are those of its parts in order, and parts are remembered.
    """
    import json
    import re
    from array import array

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # How the tokenizer cuts lower-cased Latin-1 text.
    letter, number, blank = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t\n\x0b\x0c\r"
    parts_of = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{blank}{letter}{number}]+").findall
    # Byte-level vocabularies write a byte as its own character if that is visible, else as one from 256 on.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    letters = {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}

    def packed_ids(ids) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()

    def part(text: str) -> bytes:
        written = text if text.isascii() and text.isprintable() else "".join([letters[b] for b in text.encode()])
        return packed_ids([token.id for token in tokenizer.model.tokenize(written)])

    # How a tokenizer of this kind reads a text. Any other is asked for whole texts.
    reads = {
        "normalizer": {
            "type": "Sequence",
            "normalizers": [
                {"type": "NFC"},
                {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                {"type": "Lowercase"},
            ],
        },
        "pre_tokenizer": {
            "type": "Sequence",
            "pretokenizers": [
                {
                    "type": "Split",
                    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                    "behavior": "Removed",
                    "invert": True,
                },
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
    }
    with open(path) as file:
        how = json.load(file)
    if any(how.get(part) != reads[part] for part in reads):
        return lambda raw: packed_ids(tokenizer.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def plain(text: str) -> bool:
        """Outside Latin-1 normal forms and letter cases are left to the tokenizer, and so are other blanks.

        A special token's name is one token wherever it stands.
        """
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return "\x85" not in text and "\xa0" not in text and "<|" not in text

    def run(raw: bytes) -> bytes:
        text = raw.decode("utf-8", "replace")
        if plain(text):
            return b"".join([parts[p] for p in parts_of(text.lower())])
        return packed_ids(tokenizer.encode(text, add_special_tokens=False).ids)

    parts, runs = Memo(part, CACHED_WORDS), Memo(run, CACHED_WORDS)

    def encode(raw: bytes) -> bytes:
        text = raw.decode("utf-8", "replace")
        if plain(text):
            return b"".join([parts[p] for p in parts_of(text.lower())])
        # Runs of characters between blanks don't meet each other either.
        return b"".join([runs[word] for word in raw.split()])

    return encode


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """(id, piece, start, length, ids): every document's ids and an end id, cut into pieces.

    Only documents of more than `max_tokens` ids are cut; the last piece may be shorter.
    A null or empty text is the end id alone. `ids` are little-endian 32-bit words.
    """
    prepare(docs.sparkSession)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    limit = 4 * max_tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            data, offsets = binary_column(batch.column(1))
            raw = data.tobytes()
            rows, piece, ids = [], [], []
            for i in range(batch.num_rows):
                whole = encode(raw[offsets[i] : offsets[i + 1]]) + end
                cuts = [whole[k : k + limit] for k in range(0, len(whole), limit)]
                rows += [i] * len(cuts)
                piece += range(len(cuts))
                ids += cuts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array([max_tokens * p for p in piece], pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=[id_col, "piece", "start", "length", "ids"],
            )

    return docs.select(id_col, text_col).mapInArrow(cut, f"`{id_col}` {id_type}, {_PIECES}")


def best_fit(
    counts: Mapping[int, int],
    max_tokens: int = MAX_TOKENS,
    max_documents: int = MAX_TOKENS,
    max_attention: int = MAX_TOKENS**2,
    weights: Sequence[float] = (1.0, 0.05, 0.05),
    score: str = "norm",
) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, from, to, first sequence, offset).

    Pieces number `from` .. `to` - 1 of that length go one each into consecutive
    sequences, from `first sequence` on, at `offset`. Longest lengths are placed first.

    A sequence has three capacities: tokens, documents, and attention cost (the sum of
    squared lengths). Among sequences with room under all three, `norm` takes the one
    whose residual vector after the placing has the smallest weighted norm, `dot` the one
    whose residual has the largest weighted dot product with the piece. The default
    capacities for documents and attention never cost a sequence. Like sequences are
    handled as one group, so the work and the result depend on the number of
    lengths, at most `max_tokens`, and not on the number of pieces.
    """
    if max(counts, default=0) > max_tokens:
        raise ValueError("a piece is longer than a sequence")
    if any(n and length**2 > max_attention for length, n in counts.items()) or max_documents < 1:
        raise ValueError("a piece does not fit into an empty sequence")
    full = np.array([max_tokens, max_documents, max_attention], float)
    scale = np.sqrt(np.asarray(weights, float)) / full
    # Groups of like sequences: residual capacities, number of sequences, the first one's number.
    left = np.empty((64, 3))
    many = np.empty(64, np.int64)
    first = np.empty(64, np.int64)
    groups, sequences, places = 0, 0, []

    def add(residual, n, start):
        nonlocal left, many, first, groups
        if groups == len(many):
            left, many, first = (np.concatenate([x, np.empty_like(x)]) for x in (left, many, first))
        left[groups], many[groups], first[groups] = residual, n, start
        groups += 1

    for length in sorted(counts, reverse=True):
        piece = np.array([length, 1, length**2], float)
        done, total = 0, counts[length]
        while done < total:
            fits = np.flatnonzero((left[:groups] >= piece).all(axis=1))
            if len(fits):
                if score == "norm":
                    rest = (left[fits] - piece) * scale
                    g = fits[np.argmin((rest**2).sum(axis=1))]
                else:
                    g = fits[np.argmax((left[fits] * scale) @ (piece * scale))]
                n = int(min(many[g], total - done))
                if n < many[g]:
                    add(left[g].copy(), many[g] - n, first[g] + n)
                    many[g] = n
                places.append((length, done, done + n, int(first[g]), int(max_tokens - left[g, 0])))
                left[g] -= piece
            else:
                # Open as many sequences as the remaining pieces fill, each taking all it holds.
                holds = int(min(max_tokens // length, max_documents, max_attention // length**2))
                n = -(-(total - done) // holds)
                add(full - piece, n, sequences)
                places.append((length, done, done + n, sequences, 0))
                sequences += n
            done += n
        # Sequences without room for even one token are never looked at again.
        room = np.flatnonzero((left[:groups] >= 1).all(axis=1))
        left[: len(room)], many[: len(room)], first[: len(room)] = left[room], many[room], first[room]
        groups = len(room)
    return places


def pack(
    pieces: DataFrame,
    id_col: str = "doc_id",
    max_tokens: int = MAX_TOKENS,
    **capacities,
) -> DataFrame:
    """Pieces with their (sequence_id, offset); `capacities` as for `best_fit`.

    The pieces are kept and numbered once, longest first, without gathering a length's
    pieces in one task; the driver sees only the number of pieces of each length. A
    row's place then follows from its number. Rows without ids or with repeated ones are
    pieces like any other; an empty table gives no sequences.
    """
    kept = written(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}
    places = best_fit(counts, max_tokens, **capacities)
    numbered = assign_uid(kept, [F.col("length").desc(), *[c for c in kept.columns if c != "length"]], "_number")
    # Pieces before each length's first one, then the number from which each place holds.
    before, begins = 0, {}
    for length in sorted(counts, reverse=True):
        begins[length] = before
        before += counts[length]
    table = np.array(
        sorted((begins[n] + a, first, offset) for n, a, _, first, offset in places) or np.empty((0, 3)), np.int64
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(batch.schema.get_field_index("_number")).to_numpy() - 1
            row = np.searchsorted(table[:, 0], number, side="right") - 1
            columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "_number"]
            names = [name for name in batch.schema.names if name != "_number"]
            sequence = pa.array(table[row, 1] + number - table[row, 0], pa.int64())
            offset = pa.array(table[row, 2], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, sequence, offset], names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return numbered.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places of all documents' pieces, with a checksum (crc32) of the ids instead of the ids."""
    pieces = token_pieces(docs, tokenizer, id_col, text_col)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), id_col).select(
        id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed pieces' ids in order; a sequence has a bounded number of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
