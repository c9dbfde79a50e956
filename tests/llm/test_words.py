"""Words and hashes as arrays, against plain string work."""

import random

import numpy as np
import pyarrow as pa
import pytest

from siteweave.llm import common
from siteweave.llm.common import binary_column, find_words, mix, window_hashes, window_starts, word_hashes

TEXTS = ["", None, " a  b\tc\n", "é ñandú ü", "one", "\x0b\x0c", "a b c d", "x" * 70_000 + " y " + "x" * 70_000, "z"]


def parsed(texts):
    data, offsets = binary_column(pa.array(texts, pa.string()))
    starts, ends, first = find_words(data, offsets)
    return data, starts, ends, first


def test_words_of_each_text():
    data, starts, ends, first = parsed(TEXTS)
    for i, text in enumerate(TEXTS):
        got = [data[s:e].tobytes() for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
        assert got == (text or "").encode().split()


def test_words_of_a_sliced_column_and_of_nothing():
    column = pa.array(["skip me", None, "a b", "c"], pa.string()).slice(1)
    data, offsets = binary_column(column)
    starts, ends, first = find_words(data, offsets)
    assert [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)] == [b"a", b"b", b"c"]
    assert first.tolist() == [0, 0, 2, 3]
    data, offsets = binary_column(pa.array([], pa.string()))
    assert find_words(data, offsets)[2].tolist() == [0]


@pytest.mark.parametrize("slice_bytes", [1 << 17, 1 << 21])
def test_equal_words_have_equal_hashes(monkeypatch, slice_bytes):
    monkeypatch.setattr(common, "SLICE_BYTES", slice_bytes)
    draw = random.Random(1)
    texts = [*TEXTS, " ".join("ab"[: draw.randrange(1, 3)] * draw.randrange(1, 9) + "é" for _ in range(60_000))]
    data, starts, ends, _ = parsed(texts)
    names = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
    hashes = word_hashes(data, starts, ends)
    by_name = {}
    for name, h in zip(names, hashes.tolist(), strict=True):
        assert by_name.setdefault(name, h) == h
    assert len(set(by_name.values())) == len(by_name)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_windows_stay_in_their_text(n):
    texts = ["a b c d e f", "", "a b", "b c d e f g", "c"]
    data, starts, ends, first = parsed(texts)
    words = word_hashes(data, starts, ends)
    at, of = window_starts(first, n)
    hashes = window_hashes(words, n)[at].tolist()
    names = [(tuple(t.split()[i : i + n]), k, i) for k, t in enumerate(texts) for i in range(len(t.split()) - n + 1)]
    assert of.tolist() == [k for _, k, _ in names]
    seen = {}
    for (name, _, _), h in zip(names, hashes, strict=True):
        assert seen.setdefault(name, h) == h
    assert len(set(seen.values())) == len(seen)


def test_memo_keeps_what_is_asked_for():
    calls = []
    memo = common.Memo(lambda k: calls.append(k) or k * 2, 2)
    assert [memo[k] for k in "abacadab"] == [k * 2 for k in "abacadab"]
    assert len(memo) <= 2
    assert mix(np.array([1], np.uint64))[0] != 1
