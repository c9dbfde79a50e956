"""Toxic texts by compression distance between two trained zstandard dictionaries."""

from __future__ import annotations

import dataclasses
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_column, prepare, whole_row, written

# Bound of the labelled sample that a model is fitted on, rows of each class.
TOXIC_ROWS, ORDINARY_ROWS = 1600, 4000
DICTIONARY_BYTES = 8192
# Words that go into each dictionary's training samples, four to a sample.
TOXIC_WORDS, ORDINARY_WORDS = 6000, 20_000
GRAM = 5
# How much more often a run of letters has to be in toxic texts than in ordinary ones.
LEAST_RATIO = 10.0
# Toxic texts it has to be in: this share of them, but no more than a few, and at the least the smaller share.
FEW_TEXTS, FEW_SHARE, LEAST_SHARE = 5, 2 / 5, 1 / 50
MOST_GRAMS = 5000
# Distances are told apart up to this many bytes.
MOST_BYTES = 24
# A window that is so many bytes nearer to toxic counts as a toxic word.
TELLING_BYTES = 8
# Added to shares before their logarithm; strength of the regression's ridge.
LEAST_PART, RIDGE = 1e-3, 0.1
# Added to the words of a text, so that one window says little in a short one.
PRIOR_WORDS = 20
CACHED_WINDOWS = 300_000

_SEED = 5


def _carrier() -> bytes:
    """Bytes that both dictionaries end with and every window begins with.

    They cost a single match, and make sure that a window of a few bytes is really
    compressed and not stored as it is.
    """
    return np.random.default_rng(_SEED).integers(128, 256, 48, dtype=np.uint8).tobytes()


def expand(words: list[bytes]) -> list[bytes]:
    """Every byte followed by a hash of it and the byte before, blanks around each word.

    That doubles what a literal costs and leaves the cost of a match as it is, so that
    the lengths of two compressed windows tell more about what the dictionaries hold.
    """
    pair = np.random.default_rng(_SEED + 1).integers(0, 256, (256, 256), dtype=np.uint8)
    joined = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8)
    out = np.empty(2 * len(joined), np.uint8)
    out[0::2] = joined
    out[1] = pair[32, joined[0]]
    out[3::2] = pair[joined[:-1], joined[1:]]
    raw = out.tobytes()
    ends = 2 * np.cumsum([len(w) + 2 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def _compressor(dictionary: bytes):
    import zstandard

    # A trained dictionary stays one with the carrier after it: the rest of it is plain content.
    held = zstandard.ZstdCompressionDict(dictionary + _carrier())
    settings = zstandard.ZstdCompressionParameters(
        window_log=15,
        chain_log=12,
        hash_log=12,
        search_log=4,
        min_match=4,
        target_length=16,
        strategy=zstandard.STRATEGY_GREEDY,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)


def train(words: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of the words; of too few to train on, the words themselves."""
    import zstandard

    spread = expand(words)
    samples = [b"".join(spread[i : i + 4]) for i in range(0, len(spread), 4)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


@dataclasses.dataclass(frozen=True)
class Model:
    """Two dictionaries, and what the share of windows over each distance weighs; without weights all scores are 0."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...] = ()
    bias: float = 0.0

    def distances(self):
        """A function from windows to how many bytes shorter the toxic dictionary makes each."""
        carrier = _carrier()
        toxic, ordinary = _compressor(self.toxic), _compressor(self.ordinary)

        def measure(words: list[bytes]) -> list[int]:
            windows = [carrier + w for w in expand(words)]
            a, b = ordinary.multi_compress_to_buffer(windows), toxic.multi_compress_to_buffer(windows)
            return [len(a[i]) - len(b[i]) for i in range(len(windows))]

        return measure


def _words(data: bytes) -> list[bytes]:
    return data.decode("utf-8", "replace").lower().encode().split()


def _texts(column) -> Iterator[list[bytes]]:
    data, offsets = binary_column(column)
    raw = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield _words(raw[a:b])


def _grams(words: list[bytes]) -> list[bytes]:
    """Runs of letters within words, as often as they occur."""
    padded = [b" " + word + b" " for word in words]
    return [p[i : i + GRAM] for p in padded for i in range(len(p) - GRAM + 1)]


def _sample(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str, text_col: str) -> DataFrame:
    """(toxic, part, text) of a bounded seeded sample of labelled rows; part 0 is for the dictionaries.

    Only the ids of the sample, bounded by its size, are sent to the documents.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull()).filter(train_rows)
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max("toxic").alias("_toxic"))
    known = known.withColumn("_draw", F.xxhash64(F.lit(_SEED), "_id"))
    pick = lambda kind, n: known.filter(F.col("_toxic") == kind).orderBy("_draw", "_id").limit(n)
    picked = pick(1, TOXIC_ROWS).union(pick(0, ORDINARY_ROWS))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "_id").select(
        F.col("_toxic").cast("int").alias("toxic"), F.pmod(F.shiftright("_draw", 7), F.lit(2)).cast("int").alias("part"), "text"
    )


def _counted(sample: DataFrame, of, name: str) -> DataFrame:
    """(name, toxic, n, texts): how often something occurs in texts of part 0, and in how many, per class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        texts: Counter = Counter()
        for batch in batches:
            for words, toxic in zip(_texts(batch.column(1)), batch.column(0).to_pylist(), strict=True):
                found = Counter((x, toxic) for x in of(words))
                counts.update(found)
                texts.update(found.keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in counts], pa.binary()),
                pa.array([k[1] for k in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
                pa.array([texts[k] for k in counts], pa.int64()),
            ],
            names=[name, "toxic", "n", "texts"],
        )

    part = sample.filter("part = 0").select("toxic", "text")
    counted = part.mapInArrow(count, f"{name} binary, toxic int, n long, texts long")
    return counted.groupBy(name, "toxic").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))


def fit(
    docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Train the dictionaries and calibrate the thresholds on labelled rows.

    At most `TOXIC_ROWS` and `ORDINARY_ROWS` seeded rows are used, half of them for the
    dictionaries and half for the thresholds; what comes to the driver is bounded by the
    word counts above. Labels of rows that `train_rows` leaves out are never seen.

    The ordinary dictionary is trained on the commonest words of ordinary texts, the toxic
    one on those words of toxic texts that hold a run of letters which is much commoner
    among their words than in ordinary texts, and in several of them; where there is no such run, on all words of toxic texts. A text's windows are its words. The calibration rows tell what the
    share of windows over each threshold weighs.
    Without labelled rows of both kinds nothing can be told apart, and every score is 0.
    """
    prepare(docs.sparkSession)
    sample = written(_sample(docs, labels, train_rows, id_col, text_col), "sample")
    size = {r["toxic"]: r["count"] for r in sample.filter("part = 0").groupBy("toxic").count().collect()}
    if not size.get(0) or not size.get(1):
        return Model(b"", b"")

    held = _counted(sample, _grams, "gram")
    side = lambda kind, c: F.sum(F.when(F.col("toxic") == kind, F.col(c)).otherwise(0))
    sides = held.groupBy("gram").agg(side(1, "n").alias("n1"), side(0, "n").alias("n0"), side(1, "texts").alias("texts"))
    all_ = sides.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    ratio = (F.col("n1") + 0.5) / ((all_["n1"] or 0) + 1) / ((F.col("n0") + 0.5) / ((all_["n0"] or 0) + 1))
    least = max(min(FEW_TEXTS, size[1] * FEW_SHARE), size[1] * LEAST_SHARE)
    strong = sides.filter((F.col("texts") >= least) & (ratio >= LEAST_RATIO))
    grams = {bytes(r["gram"]) for r in strong.orderBy(ratio.desc(), "gram").limit(MOST_GRAMS).collect()}

    def telling(words: list[bytes]) -> list[bytes]:
        return [w for w in words if not grams or not grams.isdisjoint(_grams([w]))]

    def commonest(counts: DataFrame, kind: int, n: int) -> list[bytes]:
        rows = counts.filter(F.col("toxic") == kind).orderBy(F.col("n").desc(), "word").limit(n).collect()
        # Common words stand several times in the samples, in a mixed order.
        words = [bytes(r["word"]) for r in rows for _ in range(min(8, r["n"]))]
        return [words[i] for i in np.random.default_rng(_SEED).permutation(len(words))]

    toxic = commonest(_counted(sample, telling, "word"), 1, TOXIC_WORDS)
    ordinary = commonest(_counted(sample, lambda words: words, "word"), 0, ORDINARY_WORDS)
    if not toxic or not ordinary:
        return Model(b"", b"")
    model = Model(train(toxic), train(ordinary))

    rows = _histograms(sample.filter("part = 1"), ["toxic"], "text", model).collect()
    labels_ = np.array([r["toxic"] for r in rows], int)
    over = np.array([r["over"] for r in rows], float).reshape(len(rows), MOST_BYTES + 1)
    words = np.array([r["n_words"] for r in rows], float)
    weights, bias = _calibrated(over / (words + PRIOR_WORDS)[:, None], labels_)
    return dataclasses.replace(model, weights=weights, bias=bias)


def _calibrated(shares: np.ndarray, labels: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Weights of the logarithms of the shares over each distance, and a bias: a ridge logistic regression.

    Calling a clean text toxic counts twice as much as the reverse.
    """
    if labels.min(initial=1) == labels.max(initial=0):
        return (), 0.0
    x = np.log(shares + LEAST_PART)
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    per_row = np.where(labels == 1, (labels == 0).sum() / (labels == 1).sum() / 2, 1.0)
    ridge = np.append(np.full(x.shape[1], RIDGE), 1e-6)
    w = np.zeros(a.shape[1])
    for _ in range(30):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (per_row * (p - labels)) + ridge * w
        bend = (a * (per_row * p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-6)
        w = w - np.linalg.solve(bend, slope)
    weights = w[:-1] / spread
    return tuple(weights.tolist()), float(w[-1] - (weights * middle).sum())


def _histograms(docs: DataFrame, keep: list[str], text_col: str, model: Model) -> DataFrame:
    """The columns to keep, n_words, and over[b]: how many windows are at least b bytes nearer to toxic."""
    counted = [T.StructField("n_words", T.LongType()), T.StructField("over", T.ArrayType(T.LongType()))]
    schema = T.StructType([*[docs.schema[c] for c in keep], *counted])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = model.distances()
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = list(_texts(batch.column(len(keep))))
            new = list({w for words in texts for w in words if w not in known})
            if len(known) + len(new) > CACHED_WINDOWS:
                known.clear()
                new = list({w for words in texts for w in words})
            for i in range(0, len(new), 4096):
                part = new[i : i + 4096]
                known.update(zip(part, [min(max(d, 0), MOST_BYTES) for d in measure(part)], strict=True))
            over = np.zeros((len(texts), MOST_BYTES + 1), np.int64)
            for t, words in enumerate(texts):
                if words:
                    distance = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    over[t] = np.bincount(distance, minlength=MOST_BYTES + 1)[::-1].cumsum()[::-1]
            offsets = pa.array(np.arange(len(texts) + 1) * (MOST_BYTES + 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)],
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(over.ravel(), pa.int64())),
                ],
                names=[*keep, "n_words", "over"],
            )

    return docs.select(*keep, text_col).mapInArrow(score, schema)


def score_toxicity(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns to keep with (n_words, toxic_words, score); score is 0.5 at even odds.

    Every word of the whole text is a window; `toxic_words` are those at least
    `TELLING_BYTES` nearer to toxic. Null and empty texts have none and score like a text without any.
    Repeated rows score alike; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    counted = _histograms(docs, keep, text_col, model)
    hits = F.get("over", F.lit(TELLING_BYTES)).alias("toxic_words")
    if not model.weights:
        return counted.select(*keep, "n_words", hits, F.lit(0.0).alias("score"))
    parts = F.transform("over", lambda n: F.log(n / (F.col("n_words") + PRIOR_WORDS) + F.lit(LEAST_PART)))
    weighed = F.zip_with(parts, F.array(*[F.lit(w) for w in model.weights]), lambda x, w: x * w)
    odds = F.aggregate(weighed, F.lit(model.bias), lambda total, x: total + x)
    return counted.select(*keep, "n_words", hits, (1 / (1 + F.exp(-odds))).alias("score"))


def in_training(id_col: str = "doc_id") -> Column:
    """Rows whose labels may be learnt: crc32 of the id as text is no multiple of 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, whole rows, that score below even odds. Rows without id or text are judged like others."""
    model = fit(docs, labels, in_training(id_col), id_col, text_col)
    rows = docs.select(whole_row(docs).alias("row"), F.col(text_col).alias("text"))
    return score_toxicity(rows, model, ["row"]).filter("score < 0.5").select("row.*")
