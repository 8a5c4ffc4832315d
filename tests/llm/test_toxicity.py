import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import toxicity
from assay.llm.queries import CATEGORIES, graded, table
from assay.llm.toxicity import BUCKETS, DENSE, FOLDS, Features, Rows, classify, drop_flagged, featurise, fit, fit_chain, sigmoid
from assay.session import settle

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, FOLDER, "documents"), graded(table(spark, FOLDER, "labels"))
    train = labels.where("crc32(cast(doc_id as string)) % 4 <> 0")
    rated = classify(docs.join(labels.select("doc_id"), "doc_id"), train, CATEGORIES)
    held = rated.join(labels.join(train, "doc_id", "left_anti"), "doc_id").toPandas()
    flagged = held["flags"].str[1].to_numpy(bool)
    toxic = held["toxic"].to_numpy() == 1
    assert len(held) > 900 and (flagged == toxic).mean() > 0.97
    assert flagged[toxic].mean() > 0.8 and flagged[~toxic].mean() < 0.01


def test_fit_separates():
    cache = Features()
    texts = ["good calm words here"] * 30 + ["bad idiot words here"] * 30
    labels = np.array([0] * 30 + [1] * 30, float)
    made = [featurise(t, cache) for t in texts]
    weights = fit(Rows(made, np.zeros((60, 0))), labels)
    assert weights.shape == (BUCKETS + DENSE,)
    assert ((sigmoid(Rows(made, np.zeros((60, 0))).scores(weights)) > 0.5) == (labels > 0)).all()


def some_texts(n):
    """Texts whose first label is told by a word, and whose second follows the first where a mark agrees."""
    rng = random.Random(5)
    words = ["calm", "river", "stone", "idiot", "fool", "tree", "sky", "mud"]
    made = []
    for i in range(n):
        low, mark = rng.random() < 0.5, rng.random() < 0.5
        text = " ".join(rng.choices(words[:3] + words[5:], k=8) + (["idiot"] if low else []) + (["fool"] if mark else []))
        made.append((i, text, int(low), int(low and mark)))
    return made


def folds_of(key):
    digest = hashlib.md5(str(key).encode()).hexdigest()
    return zlib.crc32(digest[::-1].encode()) % FOLDS


def test_chain_by_hand(spark):
    """Earlier probabilities of a fold come from a model without it, and the later model learns from them."""
    made = some_texts(240)
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    labels = spark.createDataFrame([(m[0], *m[2:]) for m in made], "doc_id long, low_quality int, toxic int")
    chain = fit_chain(docs, labels, CATEGORIES)
    order = sorted(made, key=lambda m: m[0])
    cache = Features()
    rows = [featurise(m[1], cache) for m in order]
    first, second = (np.array([m[i] for m in order], float) for i in (2, 3))
    fold = np.array([folds_of(m[0]) for m in order])
    pick = lambda mask: [r for r, kept in zip(rows, mask) if kept]
    nothing = lambda mask: np.zeros((int(mask.sum()), 0))
    rated = np.empty(len(rows))
    for k in range(FOLDS):
        out = fold == k
        weights = fit(Rows(pick(~out), nothing(~out)), first[~out])
        rated[out] = sigmoid(Rows(pick(out), nothing(out)).scores(weights))
    everything = np.ones(len(rows), bool)
    assert np.allclose(chain[0], fit(Rows(rows, nothing(everything)), first), atol=1e-6)
    assert np.allclose(chain[1], fit(Rows(rows, rated[:, None]), second), atol=1e-6)
    seen = sigmoid(Rows(rows, nothing(everything)).scores(chain[0]))
    assert not np.allclose(chain[1], fit(Rows(rows, seen[:, None]), second), atol=1e-6)


def test_repeated_keys_leave_the_sample_at_its_size(spark, monkeypatch):
    seen = []

    def recorded(df, label="table"):
        out = settle(df, label)
        if label == "toxicity-sample":
            seen.append(out.count())
        return out

    monkeypatch.setattr(toxicity, "settle", recorded)
    made = some_texts(60)
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    labels = spark.createDataFrame([(m[0], *m[2:]) for m in made], "doc_id long, low_quality int, toxic int")
    once = fit_chain(docs, labels, CATEGORIES)
    again = docs.where("doc_id = 7").join(spark.range(1000).select(F.lit(1)))
    often = fit_chain(docs.unionByName(again.select("doc_id", "text")), labels.unionByName(labels), CATEGORIES)
    assert set(seen) == {60}
    assert all(np.array_equal(a, b) for a, b in zip(once, often))


def test_messy(spark, messy):
    rows = [(n, n % 2, int(n % 3 == 0)) for n in range(40)] + [(None, 1, 1), (3, 0, 0), (5, None, 1), (6, 2, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, low_quality int, toxic int")
    rated = classify(messy, labels, CATEGORIES)
    assert rated.count() == messy.count()
    assert rated.where("size(probabilities) <> 2 or exists(probabilities, p -> p is null or isnan(p))").isEmpty()
    left = drop_flagged(messy, labels, CATEGORIES, "toxic")
    assert left.columns == messy.columns and left.count() <= messy.count()
    chain = fit_chain(messy, labels, CATEGORIES)
    assert [len(w) for w in chain] == [BUCKETS + DENSE, BUCKETS + DENSE + 1]


@pytest.mark.parametrize("labelled", [False, True])
def test_empty(spark, messy, empty, labelled):
    labels = spark.createDataFrame([(1, 0, 1)] if labelled else [], "doc_id long, low_quality int, toxic int")
    assert classify(empty, labels, CATEGORIES).isEmpty()
    if not labelled:
        assert classify(messy, labels, CATEGORIES).where("exists(flags, f -> f)").isEmpty()
