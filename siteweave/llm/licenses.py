"""Find licences in texts by a positional index of the rarest words of their phrases."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, byte_table, find_words, prepare, word_hashes

# Phrases that name a licence, and its label.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Public licence notices by label, each with phrases that must occur in it.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge",),
    ),
    "apache": (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing",
        ("in compliance with the license",),
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("gnu general public license",),
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("for any purpose with or without fee",),
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license",
        ("mozilla public license",),
    ),
    "cc-by": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-sa": ("licensed under cc by sa 4 0", ("cc by sa",)),
    "cc-by-nc": ("licensed under cc by nc 4 0", ("cc by nc",)),
}

# Share of a template's weight that has to stand in place.
LEAST_SHARE = 0.6

_SEPARATORS = bytes(b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A))
_WORD_BYTES = byte_table(_SEPARATORS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_MATCH = pa.struct(
    [
        ("label", pa.string()),
        ("kind", pa.string()),
        ("start", pa.int64()),
        ("words", pa.int64()),
        ("score", pa.float64()),
    ]
)


def _word_key(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])


def word_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> tuple[int, dict[str, int]]:
    """(documents, documents that hold each word of the vocabulary), counted over all documents.

    The vocabulary is that of the templates, so what comes to the driver does not grow with the data.
    """
    keys = np.array([_word_key(w) for w in vocabulary], np.uint64)
    order = np.argsort(keys)
    keys = keys[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(len(keys), np.int64), 0
        for batch in batches:
            data, offsets = binary_column(batch.column(0))
            data = _LOWER[data]
            starts, ends, first = find_words(data, offsets, _WORD_BYTES)
            words = word_hashes(data, starts, ends)
            at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
            hits = np.flatnonzero(keys[at] == words)
            texts = np.searchsorted(first, hits, side="right") - 1
            held = np.unique(texts * len(keys) + at[hits]) % len(keys)
            seen += np.bincount(held, minlength=len(keys))
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(len(keys))], pa.int32()), pa.array([rows, *seen], pa.int64())], names=["word", "n"]
        )

    counted = docs.select(text_col).mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counted.collect()}
    return found.get(-1, 0), {vocabulary[int(order[i])]: found.get(i, 0) for i in range(len(keys))}


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, tuple[str, tuple[str, ...]]] = TEMPLATES,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """One row per document: (id, n_words, matches).

    Words are runs of digits, letters a to z (A to Z lower-cased) and characters outside
    ASCII. A match is (label, kind, start, words, score): of kind `phrase` at every place
    where a phrase's words stand in a row (score 1), of kind `template` where a template's
    words stand in place to at least `least_share` of their weight and all its key phrases
    occur within; the score is that share.

    A word weighs by its rarity among all documents, counted first. The index has the places of
    every word of every template. In a file the words are looked up from the rarest on: a place
    of the file minus a place in the template is a start, and starts get the word's weight. Words are
    looked up until the others weigh less than `least_share`, so a start that none of them
    gave can't reach it; from then on the starts that are there are intersected with the places of
    one more word at a time, as long as they can reach it. The key phrases of those that do are verified, again
    by places. No place that meets the definition is missed.

    Null and empty texts have no words and no matches. Rows without id and repeated rows
    are scanned like others, other columns play no part, an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    phrase_words = [(p.split(), label) for p, label in phrases.items()]
    notices = [(text.split(), [m.split() for m in musts if m.split()], label) for label, (text, musts) in templates.items()]
    listed = [words for words, _ in phrase_words] + [part for words, musts, _ in notices for part in (words, *musts)]
    vocabulary = sorted({w for words in listed for w in words})
    total, held = word_frequencies(docs, vocabulary, text_col)
    weight = {w: math.log((total + 1) / (held[w] + 0.5)) for w in vocabulary}
    rank = {w: n for n, w in enumerate(sorted(vocabulary, key=lambda w: (-weight[w], w)))}

    def rarest(words: list[str]) -> int:
        return min(range(len(words)), key=lambda i: rank[words[i]])

    phrase_index: dict[str, list] = {}
    for words, label in phrase_words:
        i = rarest(words)
        phrase_index.setdefault(words[i], []).append((i, words, label))
    # Per template: its postings (word, places, weight of all of them) from the rarest word on, and
    # how many of them give starts.
    indexed = []
    anchors = set(phrase_index)
    for words, _, _ in notices:
        postings = []
        for word in sorted(set(words), key=rank.get):
            filed = [i for i, w in enumerate(words) if w == word]
            postings.append((word, filed, weight[word] * len(filed)))
        whole = rest = sum(weight[w] for w in words)
        opening = 0
        # A little more than the share, as sums are rounded.
        while opening < len(postings) and rest >= least_share * whole * (1 - 1e-9):
            rest -= postings[opening][2]
            opening += 1
        indexed.append((postings, opening, whole))
        anchors.update(word for word, _, _ in postings[:opening])
    keys = np.array([_word_key(w) for w in vocabulary], np.uint64)
    order = np.argsort(keys)
    opens = np.array([w in anchors for w in vocabulary])

    def standing(phrase: list[str], places: dict[str, set[int]], low: int, high: int) -> bool:
        """Whether the phrase's words stand in a row somewhere from `low` on, before `high`."""
        first = places.get(phrase[0], ())
        return any(
            low <= k <= high - len(phrase) and all(k + j in places.get(w, ()) for j, w in enumerate(phrase)) for k in first
        )

    def template_starts(n: int, places: dict[str, set[int]]) -> list[tuple[int, float]]:
        postings, opening, whole = indexed[n]
        need, left, votes = least_share * whole * (1 - 1e-9), whole, {}
        for k, (word, filed, heavy) in enumerate(postings):
            found = places.get(word, ())
            if k < opening:
                for place in found:
                    for i in filed:
                        votes[place - i] = votes.get(place - i, 0.0) + weight[word]
            else:
                for start in votes:
                    votes[start] += weight[word] * sum(start + i in found for i in filed)
            left -= heavy
            votes = {start: vote for start, vote in votes.items() if vote + left >= need}
            if not votes and k >= opening - 1:
                return []
        words = notices[n][0]
        shares = [(s, sum(weight[w] for i, w in enumerate(words) if s + i in places.get(w, ())) / whole) for s in votes]
        return [(start, share) for start, share in shares if share >= least_share]

    def matches(places: dict[str, set[int]], n_words: int) -> list[dict]:
        found = []
        for word, filed in phrase_index.items():
            for at in places.get(word, ()):
                for i, phrase, label in filed:
                    if all(at - i + j in places.get(w, ()) for j, w in enumerate(phrase)):
                        found.append((label, "phrase", at - i, len(phrase), 1.0))
        for n, (words, musts, label) in enumerate(notices):
            for start, share in template_starts(n, places):
                low, high = max(start, 0), min(start + len(words), n_words)
                if all(standing(must, places, low, high) for must in musts):
                    found.append((label, "template", low, high - low, min(1.0, share)))
        return [dict(zip(("label", "kind", "start", "words", "score"), f, strict=True)) for f in sorted(found)]

    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_column(batch.column(1))
            data = _LOWER[data]
            starts, ends, first = find_words(data, offsets, _WORD_BYTES)
            hashes = word_hashes(data, starts, ends)
            at = order[np.minimum(np.searchsorted(keys, hashes, sorter=order), len(keys) - 1)]
            vocal = np.flatnonzero(keys[at] == hashes)
            texts = np.searchsorted(first, vocal, side="right") - 1
            out: list[list] = [[] for _ in range(batch.num_rows)]
            # Only files with a word that gives starts are looked at.
            for text in np.unique(texts[opens[at[vocal]]]):
                low, high = np.searchsorted(texts, [text, text + 1])
                places: dict[str, set[int]] = {}
                for place in vocal[low:high].tolist():
                    word = vocabulary[at[place]]
                    if data[starts[place] : ends[place]].tobytes() == word.encode():
                        places.setdefault(word, set()).add(place - int(first[text]))
                out[text] = matches(places, int(first[text + 1] - first[text]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(first), pa.int64()), pa.array(out, pa.list_(_MATCH))],
                names=[id_col, "n_words", "matches"],
            )

    match_type = "array<struct<label:string,kind:string,start:long,words:long,score:double>>"
    return docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {id_type}, n_words long, matches {match_type}")
