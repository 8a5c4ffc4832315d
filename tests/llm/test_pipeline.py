import pytest
from test_decontaminate import brute as brute_hits
from test_exact import LOWER
from test_jaccard import shingle_set

import corpus_pipeline
from __spark_entry__ import queries
from assay.llm.queries import CATEGORIES, graded
from assay.llm.toxicity import classify
from assay.session import settle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before each stage and after the last, each read back from files."""
    made = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        made.append(settle(stage(spark, made[-1], FOLDER), name.replace(" ", "-")))
    return made


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_toxic_documents_go(spark, stages):
    """What the classifier flags goes; with so few labels that may be nothing (accuracy has a test of its own)."""
    left = set(texts(stages[1]))
    labels = graded(spark.read.parquet(f"{FOLDER}/labels.parquet"))
    flagged = {r["doc_id"] for r in classify(stages[0], labels, CATEGORIES).where("flags[1]").collect()}
    assert left == set(texts(stages[0])) - flagged
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
    assert len(clean - left) <= 0.02 * len(clean)


def test_exact_copies_go(stages):
    last = {}
    for d, t in sorted(texts(stages[1]).items()):
        last[t.translate(LOWER)] = d
    assert set(texts(stages[2])) == set(last.values())


def test_near_copies_go(stages):
    before = sorted(texts(stages[2]).items())
    root = {d: d for d, _ in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {d: shingle_set(t) for d, t in before}
    for d, _ in before:
        for e, _ in before:
            if e < d and 100 * len(sets[d] & sets[e]) >= 80 * len(sets[d] | sets[e]) > 0:
                a, b = sorted((find(d), find(e)))
                root[b] = a
    assert set(texts(stages[3])) == {d for d in root if find(d) == d}


def test_contaminated_documents_go(spark, stages):
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = set()
    for d, t in texts(stages[3]).items():
        n, hit, _ = brute_hits(t, items, 13)
        if not (hit and 20 * hit >= n):
            kept.add(d)
    assert set(texts(stages[4])) == kept


def test_all_that_is_left_is_packed(stages):
    packed = stages[5].groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r["doc_id"] for r in packed} == set(texts(stages[4]))
    lengths = stages[5].groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r["sum(length)"] for r in lengths) <= 1024


def test_nulls_copies_and_extra_columns(spark, messy):
    docs = messy
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, FOLDER), "messy")
        assert docs.columns == messy.columns
    assert not docs.isEmpty() and docs.select("text").distinct().count() == docs.count()


def test_near_copies_without_or_with_repeated_keys_go(spark):
    """One row of each group stays, whatever else has its key; empty texts are in no group."""
    a, b, c, d = ([f"{x}{i}" for i in range(60)] for x in "abcd")
    rows = [(None, ""), (None, None), (3, ""), (5, a), (None, a + ["x"]), (None, b), (None, b + ["x"])]
    rows += [(7, c), (7, c + ["x"]), (7, d), (9, d + ["x"])]
    rows = [(k, " ".join(t) if t else t) for k, t in rows]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER).collect()
    got = [(r["doc_id"], (r["text"] or "-")[0]) for r in kept]
    assert sorted(got, key=str) == sorted([(None, "-"), (None, "-"), (3, "-"), (5, "a"), (None, "b"), (7, "c"), (7, "d")], key=str)


def test_empty(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, FOLDER), "empty")
    assert docs.isEmpty()


def test_registered():
    assert queries()["pipeline"] is corpus_pipeline.run
