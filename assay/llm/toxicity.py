"""Toxicity categories by a chain of linear classifiers on hashed word features."""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.session import settle

#: Labelled rows that the chain is fitted on at most, chosen by a digest of their key.
SAMPLE_ROWS = 8_000
FOLDS = 4
BUCKETS = 1 << 18
PREFIXES = (5, 6, 7)
PENALTY = 1e-3
STEPS = 40
COLUMNS = 2_000  # that a model uses at most, those that tell its classes apart best
LEAST_T = 4.0
THRESHOLD = 0.5
DENSE = 4  # dense features, before the probabilities of earlier categories
CACHE_ENTRIES = 200_000

_LETTERS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")


def bucket(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) % BUCKETS


def word_buckets(token: str) -> list[int]:
    """Hashed features of a token in lower case: its words, their first letters, and its other signs."""
    names = []
    for word in _LETTERS.findall(token):
        names.append("w" + word)
        names += [f"p{n}{word[:n]}" for n in PREFIXES if len(word) > n]
    rest = _LETTERS.sub("", token).strip(".,")
    if rest:
        names.append("s" + rest[:4])
    return [bucket(n) for n in names]


class Features(dict):
    """Buckets of a token."""

    def __missing__(self, token: str) -> np.ndarray:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[token] = found = np.array(word_buckets(token), np.int64)
        return found


def dense(tokens: list[str]) -> list[float]:
    n = len(tokens)
    return [1.0, np.log1p(n) / 10, len(set(tokens)) / n if n else 0.0, 1.0 if n else 0.0]


def featurise(text: str, cache: Features) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Buckets, values (counts over the root of the number of tokens), dense features."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint32), np.empty(0, np.float32), dense(tokens)
    found, counts = np.unique(np.concatenate(list(map(cache.__getitem__, tokens))), return_counts=True)
    return found.astype(np.uint32), (counts / np.sqrt(len(tokens))).astype(np.float32), dense(tokens)


class Rows:
    """A sparse matrix by rows, with dense columns beside it. Only columns in `used` count."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, list[float]]], more: np.ndarray):
        self.n = len(rows)
        self.of = np.repeat(np.arange(self.n, dtype=np.int32), [len(r[0]) for r in rows])
        self.at = np.concatenate([r[0] for r in rows]) if rows else np.empty(0, np.uint32)
        self.values = np.concatenate([r[1] for r in rows]) if rows else np.empty(0)
        self.dense = np.column_stack([np.array([r[2] for r in rows]).reshape(self.n, DENSE), more])
        self.used, self.scale = np.arange(BUCKETS), np.ones(BUCKETS)

    def narrow(self, labels: np.ndarray) -> None:
        """Leave the buckets whose means differ most between the classes, by Welch's t, at one scale."""

        def moments(chosen):
            n = max(1, int(chosen.sum()))
            values = np.where(chosen[self.of], self.values, 0)
            mean = np.bincount(self.at, values, BUCKETS) / n
            return mean, (np.bincount(self.at, values**2, BUCKETS) / n - mean**2 + 1e-6) / n

        (mean1, var1), (mean0, var0) = moments(labels > 0), moments(labels == 0)
        t = np.abs(mean1 - mean0) / np.sqrt(var1 + var0)
        best = np.argsort(-t, kind="stable")[:COLUMNS]
        self.used = np.sort(best[t[best] >= LEAST_T])
        place = np.full(BUCKETS, -1)
        place[self.used] = np.arange(len(self.used))
        kept = place[self.at] >= 0
        self.of, self.at, self.values = self.of[kept], place[self.at[kept]], self.values[kept]
        squares = np.bincount(self.at, self.values**2, len(self.used)) / max(1, self.n)
        self.scale = 1 / np.sqrt(squares + 1e-12)
        self.values = self.values * self.scale[self.at]

    def widen(self, weights: np.ndarray) -> np.ndarray:
        """Weights of narrowed columns as weights of all."""
        out = np.zeros(BUCKETS)
        out[self.used] = weights[: len(self.used)] * self.scale
        return np.concatenate([out, weights[len(self.used) :]])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.of, self.values * weights[self.at], self.n)
        return sparse + self.dense @ weights[len(self.used) :]

    def pull(self, errors: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.at, self.values * errors[self.of], len(self.used))
        return np.concatenate([sparse, errors @ self.dense])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: Rows, labels: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """Logistic regression with an L2 penalty, by limited-memory BFGS with step halving."""

    def loss(w):
        z = rows.scores(w)
        value = np.mean(np.logaddexp(0, z) - labels * z) + penalty / 2 * (w @ w)
        return value, rows.pull((sigmoid(z) - labels) / rows.n) + penalty * w

    rows.narrow(labels)
    w = np.zeros(len(rows.used) + rows.dense.shape[1])
    if not rows.n:
        return rows.widen(w)
    value, gradient = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, kept = -gradient, []
        for s, y in reversed(past):
            a = (s @ direction) / (s @ y)
            direction -= a * y
            kept.append((a, s, y))
        if past:
            s, y = past[-1]
            direction *= (s @ y) / (y @ y)
        for a, s, y in reversed(kept):
            direction += (a - (y @ direction) / (s @ y)) * s
        slope, step = gradient @ direction, 1.0
        while step > 1e-6:
            new_value, new_gradient = loss(w + step * direction)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        if step <= 1e-6 or value - new_value < 1e-7:
            break
        s, y = step * direction, new_gradient - gradient
        if s @ y > 1e-12:
            past = [*past, (s, y)][-8:]
        w, value, gradient = w + s, new_value, new_gradient
    return rows.widen(w)


def _load(group: pd.DataFrame, earlier: int) -> tuple[Rows, np.ndarray]:
    rows = [(np.frombuffer(a, np.uint32), np.frombuffer(v, np.float32), list(d)) for a, v, d in zip(group["at"], group["values"], group["dense"])]
    more = np.array([list(p) for p in group["earlier"]]).reshape(len(rows), earlier)
    return Rows(rows, more), group["label"].to_numpy().astype(float)


def _solver(earlier: int):
    def solve(group: pd.DataFrame) -> pd.DataFrame:
        """The model without the fold left out, and its probabilities for that fold."""
        out = int(group["left_out"].iloc[0])
        group = group.sort_values("key", kind="stable")
        held_out = group["fold"] == out
        weights = fit(*_load(group[~held_out], earlier))
        held, _ = _load(group[held_out], earlier)
        rated = sigmoid(held.scores(weights)) if held.n else np.empty(0)
        return pd.DataFrame(
            {
                "left_out": [out],
                "weights": [weights.tobytes() if out < 0 else b""],
                "keys": [group["key"][held_out].tolist()],
                "rated": [rated.tolist()],
            }
        )

    return solve


def fit_chain(df: DataFrame, labels: DataFrame, categories: Sequence[str], key: str = "doc_id", text: str = "text") -> list[np.ndarray]:
    """Weights of each category's model, in order.

    The probabilities of earlier categories that a later model learns from are out of fold: those of a
    row come from a model that has not seen the row's fold. The models that score are fitted on all
    folds. Of rows with one key the least features count, of its labels the least, so the sample has one
    row for a key however often it occurs. Each fit is one task over the bounded sample (`SAMPLE_ROWS`); folds are fitted side by side.
    """
    known = labels.select(F.col(key).alias("key"), *[F.col(c).cast("int").alias(f"l{i}") for i, c in enumerate(categories)])
    known = known.where(" and ".join(["key is not null", *[f"l{i} in (0, 1)" for i in range(len(categories))]]))
    marks = F.struct(*[f"l{i}" for i in range(len(categories))])
    known = known.groupBy("key").agg(F.min(marks).alias("marks")).select("key", "marks.*")
    digest = F.md5(F.col("key").cast("string"))
    chosen = known.orderBy(digest, "key").limit(SAMPLE_ROWS)
    fold = F.pmod(F.crc32(F.reverse(digest)), F.lit(FOLDS)).cast("int")
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    n = len(categories)

    def run(source):
        cache = Features()
        for batch in source:
            made = [featurise(t.as_py() or "", cache) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("fold"), batch.column("labels")]
                + [pa.array([m[0].tobytes() for m in made], pa.binary()), pa.array([m[1].tobytes() for m in made], pa.binary())]
                + [pa.array([m[2] for m in made], pa.list_(pa.float64()))],
                names=["key", "fold", "labels", "at", "values", "dense"],
            )

    kind = texts.schema["key"].dataType.simpleString()
    made = texts.select("key", "text", fold.alias("fold"), F.array(*[f"l{i}" for i in range(n)]).alias("labels")).mapInArrow(
        run, f"key {kind}, fold int, labels array<int>, at binary, values binary, dense array<double>"
    )
    # One row for each key, before anything moves, so that a repeated key neither weighs more nor multiplies rows.
    one = made.groupBy("key", "fold", "labels").agg(F.min(F.struct("at", "values", "dense")).alias("v"))
    sample = settle(one.select("key", "fold", "labels", "v.*"), "toxicity-sample").withColumn("earlier", F.array().cast("array<double>"))
    chain = []
    for c in range(n):
        # One group per fold to leave out, and one that leaves out none.
        groups = sample.withColumn("label", F.col("labels")[c]).withColumn(
            "left_out", F.explode(F.array(*[F.lit(f) for f in range(-1, FOLDS if c + 1 < n else 0)]))
        )

        fitted = settle(
            groups.groupBy("left_out").applyInPandas(_solver(c), f"left_out int, weights binary, keys array<{kind}>, rated array<double>"),
            "toxicity-fit",
        )
        found = fitted.where("left_out = -1").select("weights").first()
        chain.append(np.frombuffer(found["weights"]) if found else np.zeros(BUCKETS + DENSE + c))
        if c + 1 < n:
            rated = fitted.where("left_out >= 0").select(F.explode(F.arrays_zip("keys", "rated")).alias("x")).select("x.keys", "x.rated")
            sample = sample.join(rated, sample["key"] == rated["keys"]).drop("keys").withColumn("earlier", F.concat("earlier", F.array("rated"))).drop("rated")
            sample = settle(sample, "toxicity-sample")
    return chain


class TokenWeights(dict):
    """Row of `table` with a token's summed weights in all models."""

    def __init__(self, sparse: np.ndarray):
        super().__init__()
        self.sparse, self.table = sparse, np.zeros((CACHE_ENTRIES, sparse.shape[1]))

    def __missing__(self, token: str) -> int:
        self[token] = row = len(self)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[row] = self.sparse[word_buckets(token)].sum(0)
        return row


def rate(df: DataFrame, chain: list[np.ndarray], text: str = "text", into: str = "probabilities") -> DataFrame:
    """All columns of `df` and `into`, an array with one probability per category in the chain's order.

    A null text counts as empty. The models have a fixed size and are broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast([w.astype(np.float32) for w in chain])
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, `{into}` array<double>"

    def run(source):
        models = shared.value
        cache = TokenWeights(np.column_stack([w[:BUCKETS] for w in models]))
        for batch in source:
            rated = []
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
            for value in batch.column(text):
                tokens = (value.as_py() or "").lower().split()
                rows = np.fromiter(map(cache.__getitem__, tokens), np.int64, len(tokens))
                sums = cache.table[rows].sum(0) / np.sqrt(max(1, len(rows)))
                side = dense(tokens)
                for c, w in enumerate(models):
                    side.append(float(sigmoid(sums[c] + np.dot(w[BUCKETS:], side))))
                rated.append(side[DENSE:])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rated, pa.list_(pa.float64()))], names=[*batch.schema.names, into]
            )

    return df.mapInArrow(run, schema)


def drop_flagged(
    df: DataFrame, labels: DataFrame, categories: Sequence[str], drop: str, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """`df` without the rows whose probability of category `drop` is above the threshold; same columns."""
    chain = fit_chain(df, labels, categories, key, text)
    into = "_probabilities"
    while into in df.columns:
        into = "_" + into
    rated = rate(df, chain, text, into)
    return rated.where(F.col(into)[list(categories).index(drop)] <= threshold).drop(into)


def classify(
    df: DataFrame, labels: DataFrame, categories: Sequence[str], key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """key, probabilities (one per category) and flags for every row of `df`.

    The chain learns from the labelled rows among `df`: labels other than 0 and 1 and null keys are
    left out, of repeated keys one label row and one text count. Without labelled rows all probabilities are 0.5
    and no flag is set. Null texts count as empty. Repeated rows and null keys keep a row each; extra
    columns are not read; an empty table gives an empty result.
    """
    chain = fit_chain(df, labels, categories, key, text)
    rated = rate(df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), chain).drop("text")
    flags = F.transform("probabilities", lambda p: p > threshold)
    return rated.select(F.col("key").alias(key), "probabilities", flags.alias("flags"))
