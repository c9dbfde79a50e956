import random
import zlib
from collections import Counter

import numpy as np
import pytest

from siteweave.llm import packing

TEXTS = [
    "Hello, World! It's 42 don't <|endoftext|> x_1",
    "",
    None,
    "   \n\t ",
    "Straße ŒUVRE ΑΣΣ İI é ² ½ a\x85b c\xa0d \x00\x1c",
    "the cat " * 1500,
    "the cat " * 1500,
    "z" * 9000,
    "short",
    "a<|startoftext|>b <|endoftext|>c <| x",
]


@pytest.fixture(scope="module")
def tokenizer():
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def placed(rows):
    """Check that sequences are filled without gaps or overlaps; returns their lengths."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.MAX_TOKENS
    return [sum(n for _, n in parts) for parts in by_sequence.values()]


def test_pieces_are_the_tokenizers_ids(make_docs, tokenizer):
    docs = make_docs(TEXTS).repartition(2)
    rows = packing.packed_documents(docs, packing.tokenizer_path()).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    want = {}
    for i, text in enumerate(TEXTS):
        ids = ids_of(tokenizer, text)
        for p in range(0, len(ids), 2048):
            part = ids[p : p + 2048]
            want[i, p // 2048] = (p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert got == want and len(rows) == len(want)
    lengths = placed(rows)
    assert len(lengths) == -(-sum(n for _, n, _ in want.values()) // 2048)


def test_sequences_hold_the_ids(make_docs, tokenizer):
    pieces = packing.token_pieces(make_docs(TEXTS), packing.tokenizer_path())
    packed = packing.pack(pieces)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = whole[r.sequence_id][r.offset : r.offset + r.length]
        assert part.tolist() == ids_of(tokenizer, TEXTS[r.doc_id])[r.start : r.start + r.length]


def test_rows_without_id_repeated_rows_and_clashing_names(make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(None, "a b"), (None, "a b"), (7, None), (7, None)])
    docs = docs.withColumn("sequence_id", F.lit("x")).withColumn("length", F.lit("y"))
    rows = packing.packed_documents(docs, packing.tokenizer_path()).collect()
    assert len(rows) == 4 and len(placed(rows)) == 1


def test_empty_table(make_docs):
    assert packing.packed_documents(make_docs([]), packing.tokenizer_path()).count() == 0


def fill(places):
    bins = {}
    for length, a, b, first, offset in places:
        for k in range(b - a):
            bins.setdefault(first + k, []).append((offset, length))
    return bins


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("limits", [{}, {"max_documents": 3}, {"max_attention": 2048 * 1100}, {"max_documents": 5, "max_attention": 2048**2}])
def test_every_capacity_holds(score, limits):
    draw = np.random.default_rng(4)
    lengths = np.minimum(draw.geometric(0.004, 3000), 1400)
    counts = Counter(lengths.tolist())
    bins = fill(packing.best_fit(counts, score=score, **limits))
    assert Counter(n for parts in bins.values() for _, n in parts) == counts
    for parts in bins.values():
        assert sum(n for _, n in parts) <= 2048
        assert len(parts) <= limits.get("max_documents", 2048)
        assert sum(n * n for _, n in parts) <= limits.get("max_attention", 2048**2)
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
    if not limits:
        assert len(bins) <= 1.01 * lengths.sum() / 2048 + 1


def test_work_does_not_grow_with_the_pieces():
    counts = {n: 10**9 + n for n in range(1, 2049)}
    places = packing.best_fit(counts)
    assert len(places) < 100_000
    assert sum(b - a for _, a, b, _, _ in places) == sum(counts.values())


def test_pieces_that_fit_nowhere():
    with pytest.raises(ValueError):
        packing.best_fit({2049: 1})
    with pytest.raises(ValueError):
        packing.best_fit({100: 1}, max_attention=99)
    assert packing.best_fit({}) == []


def test_other_tokenizers_are_asked_for_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    draw = random.Random(2)
    texts = ["Hello World, it is 2024", "", " \t\n two  blanks", "ÀÉ\u00a0é 123's"]
    texts += ["".join(draw.choice("aB é1 \n'.s") for _ in range(draw.randrange(40))) for _ in range(300)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        tokenizer, encode = Tokenizer.from_file(path), packing._encoder(path)
        for text in texts:
            assert np.frombuffer(encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
