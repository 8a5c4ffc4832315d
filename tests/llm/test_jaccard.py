import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assay.llm import jaccard


def shingle_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return Counter((key, len(sets[i]), least.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows))


@pytest.mark.parametrize("entries", [jaccard.GROUP_ENTRIES, 150])
def test_messy(messy, monkeypatch, entries):
    monkeypatch.setattr(jaccard, "GROUP_ENTRIES", entries)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(messy).collect())
    assert got == brute([(r["doc_id"], r["text"]) for r in messy.collect()])


def test_empty(empty):
    assert jaccard.link_documents(empty).isEmpty()


def test_nothing_near(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l"), (3, None)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in jaccard.link_documents(df).collect()) == [(1, 1), (2, 2), (3, 3)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40)), min_size=1, max_size=12), st.integers(1, 8))
def test_divide_skip(lists, need):
    counts = Counter(x for ids in lists for x in ids)
    got = jaccard.divide_skip([np.array(sorted(ids), np.int64) for ids in lists], need)
    assert {int(a): int(b) for a, b in got} == {x: c for x, c in counts.items() if c >= need}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=1, max_size=12), st.integers(0, 1))
def test_join_sets(sets, heap):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    roots = jaccard.join_sets(arrays)
    want = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 80 * len(a | b):
                    want[i] = want[j] = min(want[i], want[j])
    assert [int(r) for r in roots] == want


@pytest.mark.parametrize("key", [7, None])
def test_repeats_over_many_batches(spark, key):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(key, text)] * 3 + [(8, text + " x"), (9, "one two three four five six"), (key, "a text of its own"), (None, "alone too")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        found = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute(rows)
