import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assay.llm import quality
from assay.llm.queries import quality_classifier, table

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = table(spark, FOLDER, "labels")
    rated = quality_classifier(spark, FOLDER, labels.select("doc_id"))
    held = rated.join(labels, "doc_id").where("held_out").toPandas()
    good, score = held["quality"].to_numpy() == 1, held["score"].to_numpy()
    assert len(held) > 700 and ((held["predicted"] == 1) == good).mean() > 0.99
    assert (held["predicted"] == (score >= 0.3)).all()
    assert (score[good][:, None] > score[~good][None, :]).mean() > 0.999  # area under the curve
    assert (held["held_out"] == held["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    changed = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(docs, x.where(~held)) for x in (labels, changed))
    assert np.array_equal(a, b) and np.count_nonzero(a) > 20


def shapes_and_words(text):
    """The n-grams of each kind, told apart by their names instead of hashes."""
    tokens = re.findall(rb"[^ \t-\r]+", text)
    words = [re.sub(rb"[^a-z0-9\x80-\xff]", b"", t.lower()) for t in tokens]
    coarse = [re.sub(rb"[a-z\x80-\xff]", b"a", re.sub(rb"[A-Z]", b"A", re.sub(rb"[0-9]", b"0", t))) for t in tokens]
    shapes = [re.sub(rb"(?s)(.)\1+", rb"\1", s) for s in coarse]
    pairs = lambda x: list(zip(x, x[1:]))
    return [words, shapes, ["twice" if a == b else (a, b) for a, b in pairs(words)], pairs(shapes)]


def values_of(text):
    """The values by kind, in order; the brute-force counterpart of a vector."""
    return sorted(np.sqrt(c / len(kind)) for kind in shapes_and_words(text) for c in Counter(kind).values())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abAB01.!| \n\t\x0bé")), max_size=30), min_size=1, max_size=5))
def test_vectors_are_those_of_the_ngrams(texts):
    data = [t.encode() for t in texts]
    ((start, of, at, values),) = quality.vectors(data)
    assert start == 0
    for n, text in enumerate(data):
        assert np.allclose(sorted(values[of == n]), values_of(text))
        alone, far = quality.long_vector(text)
        assert sorted(zip(at[of == n], values[of == n])) == sorted(zip(alone, far))


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = (b"some WORDS words words 12 !! " * 40 + b"x" * 90 + b" tail") * 3
    ((_, _, at, values),) = quality.vectors([text])
    monkeypatch.setattr(quality, "BLOCK_BYTES", 300)
    ((_, of, cut_at, cut_values),) = quality.vectors([text])
    assert not of.any() and sorted(zip(at, values)) == sorted(zip(cut_at, cut_values))


def test_ftrl_by_hand():
    """One weight at a time, by the definition of the update."""
    rng = np.random.default_rng(3)
    model, z, n = quality.Ftrl(), {}, {}

    def weight(i):
        l1 = 0 if i == quality.BUCKETS else model.l1
        if abs(z.get(i, 0)) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((model.beta + n[i] ** 0.5) / model.alpha + model.l2)

    for _ in range(200):
        at, values, label = rng.choice(50, 6, replace=False), rng.random(6), int(rng.random() < 0.7)
        x = dict(zip(at.tolist(), values)) | {quality.BUCKETS: 1.0}
        p = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - label) * v
            w = weight(i)
            z[i] = z.get(i, 0) + g - ((n.get(i, 0) + g * g) ** 0.5 - n.get(i, 0) ** 0.5) / model.alpha * w
            n[i] = n.get(i, 0) + g * g
        model.learn(at, values, label)
    assert np.allclose(model.weights()[[*range(50), quality.BUCKETS]], [weight(i) for i in [*range(50), quality.BUCKETS]])


def test_repeated_keys_are_one_example(spark):
    rows = [(n, "good calm words here") for n in range(40)] + [(n, "BAD!! WORDS!! HERE!!") for n in range(40, 60)]
    labels = spark.createDataFrame([(n, int(n < 40)) for n in range(60)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = once.unionByName(spark.range(1000).selectExpr("7L as doc_id", "'good calm words here' as text"))
    a, b = quality.fit(once, labels), quality.fit(often, labels.unionByName(labels))
    assert np.array_equal(a, b)
    found = {r["text"]: r["predicted"] for r in quality.classify(once, labels).join(once, "doc_id").collect()}
    assert found == {"good calm words here": 1, "BAD!! WORDS!! HERE!!": 0}


def test_messy(spark, messy):
    rows = [(n, n % 2) for n in range(40)] + [(None, 1), (3, 0), (5, None), (6, 2)]
    out = quality.classify(messy, spark.createDataFrame(rows, "doc_id long, quality int"))
    assert out.columns == ["doc_id", "score", "predicted"] and out.count() == messy.count()
    assert out.where("score is null or isnan(score) or score not between 0 and 1").isEmpty()


@pytest.mark.parametrize("labelled", [False, True])
def test_empty(spark, messy, empty, labelled):
    labels = spark.createDataFrame([(1, 0)] if labelled else [], "doc_id long, quality int")
    assert quality.classify(empty, labels).isEmpty()
    if not labelled:
        assert {r["score"] for r in quality.classify(messy, labels).collect()} == {0.5}
