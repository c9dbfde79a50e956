"""What the operators share: settings, row numbers, words and their hashes as arrays.

Texts stay UTF-8 bytes and a batch is worked on as a whole: words are found and
hashed with array operations over the bytes of all its texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path, tune

# Rows that travel to a Python worker at a time; texts can be long.
BATCH_ROWS = 512
# Bytes hashed at a time, and the length from which a word is hashed by itself.
SLICE_BYTES = 1 << 21
LONG_WORD = 1 << 16

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_OTHER_BASE = 0xD1342543DE82EF95


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, so that they are made once and outlive executors."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame):
    """All columns as one struct, so that no name of theirs can meet a name of an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Memo(dict):
    """Values by key, made when first asked for; a bounded number of those asked for last is kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def text_key(col: str = "text"):
    """128 bits that stand for a whole text; null counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(col), F.lit("")), 256)), 1, 16)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def salted(h: np.ndarray, salt: int) -> np.ndarray:
    return mix(h + np.uint64((salt * _BASE) & _MASK))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, base, np.uint64)
    down = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def binary_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, offsets) of a text or binary column; null counts as empty."""
    values = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_table(separators: bytes) -> np.ndarray:
    """True at the bytes that belong to words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


# The white space of the contracts: a blank and the controls 09 to 0D.
NOT_SPACE = byte_table(b" \t\n\x0b\x0c\r")


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = NOT_SPACE):
    """(starts, ends, first): byte ranges of all words, and the first word of each text.

    `first` has one more entry than there are texts; no word reaches into another text.
    """
    inside = table[data]
    if not len(inside):
        nothing = np.empty(0, np.int64)
        return nothing, nothing, np.zeros(len(offsets), np.int64)
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[borders] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[borders - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word, by prefix sums over slices of the bytes."""
    import xxhash

    letter = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    out = np.empty(len(starts), np.uint64)
    length = ends - starts
    up = down = None
    at = 0
    while at < len(starts):
        upto = int(np.searchsorted(starts, starts[at] + SLICE_BYTES - LONG_WORD))
        upto = max(upto, at + 1)
        low = int(starts[at])
        short = np.flatnonzero(length[at:upto] < LONG_WORD) + at
        for w in np.flatnonzero(length[at:upto] >= LONG_WORD) + at:
            out[w] = xxhash.xxh3_64_intdigest(data[starts[w] : ends[w]].tobytes())
        if len(short):
            high = int(ends[short[-1]])
            n = min(high - low, SLICE_BYTES + LONG_WORD)
            if up is None or len(up) <= n:
                up, down = _powers(_BASE, max(n, 1 << 16))
            part = data[low : low + n]
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(letter[part] * up[: len(part)], out=sums[1:])
            s, e = starts[short] - low, ends[short] - low
            out[short] = (sums[e] - sums[s]) * down[s]
        at = upto
    return mix(out + length.astype(np.uint64))


def window_hashes(words: np.ndarray, n: int, other: bool = False) -> np.ndarray:
    """Hash of the n words from each word on; windows that run out of words are left out.

    Windows may cross texts; `window_starts` names those that don't. `other` gives a
    second, independent hash.
    """
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(_OTHER_BASE if other else _BASE, len(words))
    sums = np.empty(len(words) + 1, np.uint64)
    sums[0] = 0
    values = salted(words, 7) if other else words
    np.cumsum(values * up[: len(words)], out=sums[1:])
    return mix((sums[n:] - sums[:count]) * down[:count])


def window_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word indexes at which n words of one text begin, the text of each)."""
    length = np.diff(first)
    fits = np.maximum(length - (n - 1), 0)
    texts = np.repeat(np.arange(len(length)), fits)
    within = np.arange(int(fits.sum())) - np.repeat(np.cumsum(fits) - fits, fits)
    return np.repeat(first[:-1], fits) + within, texts


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column from the bytes of its values and their offsets."""
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.binary())


def slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> list[pa.RecordBatch]:
    """The batch as runs of rows whose texts have at most `most_bytes`, or one longer text each."""
    _, offsets = binary_column(batch.column(column))
    out, at = [], 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        out.append(batch.slice(at, upto - at))
        at = upto
    return out
