"""Quality of texts: logistic regression on hashed word n-grams, learned by follow-the-regularised-leader.

A text is the sparse vector of its word n-grams: words and pairs of words, and the same of the words'
shapes (runs of capitals, small letters, digits and other signs). A pair of one word twice is one
feature whatever the word. Each of these four kinds has length one, so long and short texts compare. The model
is one weight per bucket, most of them 0; a score is the logistic function of the sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.session import settle

#: Labelled rows that the model is fitted on at most, chosen by a digest of their key.
SAMPLE_ROWS = 8_000
BUCKETS = 1 << 18
EPOCHS = 4
THRESHOLD = 0.3
#: Bytes of a text that are hashed at a time.
BLOCK_BYTES = 1 << 20
BATCH_ROWS = 256

_GAP = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: What a byte is in a shape: a sign is itself, letters beyond ASCII count as small ones.
_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SHAPE[128:] = ord("a")
_IN_WORD = np.isin(_SHAPE, [ord("A"), ord("a"), ord("0")])
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TWICE = np.uint64(0xD1B54A32D192ED03)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _polynomial(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range of values: a polynomial in the place from the range's start, modulo 2^64."""
    lengths = ends - starts
    if not len(values) or not len(lengths):
        return np.zeros(len(lengths), np.uint64)
    powers = np.cumprod(np.full(int(lengths.max(initial=1)), _ODD))
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    summed = np.concatenate([[np.uint64(0)], np.cumsum(values * powers[place])])
    return _mixed(summed[ends] - summed[starts])


def _kept(keep: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges after only the marked values are kept."""
    before = np.concatenate([[0], np.cumsum(keep)])
    return before[starts], before[ends]


def hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of bytes without white space: its start, the hash of its letters and digits in lower case, and of its shape."""
    solid = np.zeros(len(text) + 2, bool)
    solid[1:-1] = ~_GAP[text]
    starts, ends = np.flatnonzero(solid[1:] & ~solid[:-1]), np.flatnonzero(solid[:-1] & ~solid[1:])
    solid, first = solid[1:-1], starts
    text = text[solid]
    starts, ends = _kept(solid, starts, ends)
    of_word = _IN_WORD[text]
    words = _polynomial(_LOWER[text[of_word]], *_kept(of_word, starts, ends))
    shape = _SHAPE[text]
    changes = np.ones(len(text), bool)
    changes[1:] = shape[1:] != shape[:-1]
    changes[starts] = True
    return first, words, _polynomial(shape[changes], *_kept(changes, starts, ends))


def _pairs(h: np.ndarray, twice: bool) -> np.ndarray:
    left, right = h[:-1], h[1:]
    pair = _mixed(left * _ODD + right)
    return np.where(left == right, _TWICE, pair) if twice else pair


def grams(words: np.ndarray, shapes: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams by kind; kinds start from different seeds."""
    kinds = [words, shapes, _pairs(words, True), _pairs(shapes, False)]
    return [(_mixed(h + np.uint64(n + 1)) % np.uint64(BUCKETS)).astype(np.int64) for n, h in enumerate(kinds)]


def _blocks(text: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a long text, cut behind white space where there is some."""
    start = 0
    while start < len(text):
        stop = min(len(text), start + BLOCK_BYTES)
        if stop < len(text):
            gaps = np.flatnonzero(_GAP[text[start:stop]])
            stop = start + int(gaps[-1]) + 1 if len(gaps) else stop
        yield text[start:stop]
        start = stop


def long_vector(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text of any length, block by block; memory is bounded by the buckets."""
    dense = [np.zeros(BUCKETS, np.int64) for _ in range(4)]
    last = [np.zeros(0, np.uint64)] * 2
    for block in _blocks(np.frombuffer(text, np.uint8)):
        _, *found = hashes(block)
        new = grams(*found)
        joined = grams(*(np.concatenate([a, b]) for a, b in zip(last, found)))
        for total, counted in zip(dense, [*new[:2], *joined[2:]]):
            total += np.bincount(counted, minlength=BUCKETS)
        last = [b[-1:] if len(b) else a for a, b in zip(last, found)]
    at = [np.flatnonzero(d) for d in dense]
    values = [np.sqrt(d[a] / max(1, d.sum())) for d, a in zip(dense, at)]
    return np.concatenate(at), np.concatenate(values)


def _together(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and value of all n-grams of several short texts."""
    joined = np.frombuffer(b" ".join(texts), np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    first, *found = hashes(joined)
    of = np.searchsorted(begins, first, "right") - 1
    within = of[:-1] == of[1:]
    out = []
    for kind, buckets in enumerate(grams(*found)):
        mine = of if kind < 2 else of[:-1][within]
        buckets = buckets if kind < 2 else buckets[within]
        keys, counts = np.unique(mine * BUCKETS + buckets, return_counts=True)
        totals = np.bincount(mine, minlength=len(texts))
        out.append((keys // BUCKETS, keys % BUCKETS, np.sqrt(counts / totals[keys // BUCKETS])))
    return tuple(map(np.concatenate, zip(*out)))


def vectors(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The texts as sparse vectors, some at a time: (number of the first, text, bucket, value).

    Texts are counted from that first one. A value is the root of the n-gram's share among those of its
    kind in the text. A text without words has no entries. About one block of text is held as arrays.
    """
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and size + len(texts[stop]) <= BLOCK_BYTES:
            size += len(texts[stop])
            stop += 1
        if stop > start:
            yield start, *_together(texts[start:stop])
        else:
            at, values = long_vector(texts[start])
            yield start, np.zeros(len(at), np.int64), at, values
            stop = start + 1
        start = stop


@dataclass
class Ftrl:
    """FTRL-proximal with a rate per weight. The last weight is the constant one and has no L1 penalty."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.2
    l2: float = 0.1

    def __post_init__(self):
        self.z, self.n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.arange(BUCKETS + 1)[at] == BUCKETS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        """One update. Buckets that two kinds share appear twice and take both parts."""
        at, place = np.unique(np.append(at, BUCKETS), return_inverse=True)
        values = np.bincount(place, np.append(values, 1.0))
        w = self.weights(at)
        g = (sigmoid(w @ values) - label) * values
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _small(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


def _vectors(df: DataFrame) -> DataFrame:
    """(key, label, at, values) of rows (key, label, text as binary)."""
    kind = df.schema["key"].dataType.simpleString()

    def run(source):
        for batch in _small(source):
            made = [(b"", b"")] * batch.num_rows
            for start, of, at, values in vectors(batch.column("text").to_pylist()):
                order = np.argsort(of, kind="stable")
                counts = np.bincount(of)
                borders = np.cumsum(counts)[:-1]
                parts = zip(np.split(at[order].astype(np.uint32), borders), np.split(values[order].astype(np.float32), borders))
                made[start : start + len(counts)] = [(a.tobytes(), v.tobytes()) for a, v in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label")] + [pa.array([m[i] for m in made], pa.binary()) for i in (0, 1)],
                names=["key", "label", "at", "values"],
            )

    return df.mapInArrow(run, f"key {kind}, label int, at binary, values binary")


def _content(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def fit(
    df: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", sample: int = SAMPLE_ROWS, epochs: int = EPOCHS
) -> np.ndarray:
    """Weights of the buckets, and the constant one.

    Learns from at most `sample` labelled rows of `df`, chosen by the digest of their key: labels other
    than 0 and 1, null keys, and keys with both labels are left out; of texts with one key the least
    vector counts. The rows stream through one task in the order of their digests, once per epoch; it
    holds the model and one batch. Without labelled rows all weights are 0.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key is not null and label in (0, 1)")
    known = known.groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    chosen = known.orderBy(F.md5(F.col("key").cast("string")), "key").limit(sample)
    texts = df.select(F.col(key).alias("key"), _content(text).alias("text")).join(F.broadcast(chosen), "key")
    vectors = _vectors(texts.select("key", "label", "text"))
    # Repeated rows are reduced where they are, before anything moves.
    rows = vectors.groupBy("key", "label").agg(F.min(F.struct("at", "values")).alias("v"))
    rows = settle(rows.select(F.md5(F.col("key").cast("string")).alias("digest"), "label", "v.at", "v.values"), "quality-sample")

    def learn(source):
        model, seen = Ftrl(), 0
        for batch in _small(source):
            for row in batch.to_pylist():
                model.learn(np.frombuffer(row["at"], np.uint32).astype(np.int64), np.frombuffer(row["values"], np.float32), row["label"])
                seen += 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([model.weights().tobytes()], pa.binary())], names=["weights"])

    ordered = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).repartition(1).sortWithinPartitions("epoch", "digest")
    found = ordered.select("at", "values", "label").mapInArrow(learn, "weights binary").first()
    return np.frombuffer(found["weights"]) if found else np.zeros(BUCKETS + 1)


def rate(df: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row. The model has a fixed size and is broadcast; texts do not move."""
    shared = df.sparkSession.sparkContext.broadcast(weights)
    rows = df.select(F.col(key).alias("key"), _content(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(source):
        w = shared.value
        for batch in _small(source):
            dots = np.full(batch.num_rows, w[BUCKETS])
            for start, of, at, values in vectors(batch.column("text").to_pylist()):
                summed = np.bincount(of, w[at] * values)
                dots[start : start + len(summed)] += summed
            scores = sigmoid(dots)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores, pa.float64())], names=["key", "score"])

    return rows.mapInArrow(run, f"key {kind}, score double")


def classify(
    df: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE_ROWS
) -> DataFrame:
    """One row per row of `df`: key, score (the probability of label 1) and predicted (1 from `threshold` on).

    Scores see the text alone. A null text counts as empty and gets the score of a text without words,
    which the constant weight gives. Repeated rows and null keys keep a row each; extra columns are not
    read; an empty table gives an empty result; without labelled rows all scores are 0.5.
    """
    weights = fit(df, labels, label, key, text, sample)
    return rate(df, weights, key, text).select(
        F.col("key").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
