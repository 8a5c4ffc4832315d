import math
import re
import zlib
from collections import Counter

import numpy as np
import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assay.llm import ngrams
from assay.llm.eliasfano import EliasFano
from assay.llm.queries import LM_BASE_SQL, lm_scoring
from assay.llm.ngrams import quantise, score_documents


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=60), st.lists(st.integers(0, 5000), max_size=20), st.integers(0, 30))
def test_successor(values, wanted, spread):
    values = np.unique(np.array(values, np.uint64) << np.uint64(spread))
    sequence = EliasFano(values, (5001 << spread) + 1)
    sequence.open()
    at, equal = sequence.successor(np.array(wanted, np.uint64) << np.uint64(spread))
    for w, i, e in zip(wanted, at, equal):
        assert i == np.searchsorted(values, np.uint64(w << spread)) and e == (w << spread in set(values.tolist()))


def test_quantised_values_are_near():
    values = np.random.default_rng(1).beta(0.2, 3, 5000) + 1e-7
    codes, book = quantise(values)
    assert codes.min() >= 1 and np.median(np.abs(np.log(book[codes] / values))) < 0.05


def expected(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [(k, [w for w in re.split("[\x20\x09-\x0d]+", (t or "").translate(lower)) if w] + [None]) for k, t in rows]
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0
    ones, twos, before, after = Counter(), Counter(), Counter(), Counter()
    for k, ws in texts:
        if not held(k):
            ones.update(ws)
            twos.update(zip(["<s>", *ws], ws))
    for (c, _), n in twos.items():
        before[c] += n
        after[c] += 1
    total = sum(ones.values())
    base = lambda w: (ones[w] + 0.1) / (total + 0.1 * (len(ones) + 1))

    def p(c, w):
        return (twos[c, w] + after[c] * base(w)) / (before[c] + after[c]) if before[c] else base(w)

    for k, ws in texts:
        yield (
            k, held(k), len(ws), sum(ones[w] > 0 for w in ws), total,
            sum(math.log10(base(w)) for w in ws), sum(math.log10(p(c, w)) for c, w in zip(["<s>", *ws], ws)),
        )


def test_messy(messy):
    order = lambda r: (str(r[0]), r[2], r[3], r[5])
    got = sorted((tuple(r) for r in score_documents(messy).collect()), key=order)
    want = sorted(expected([(r["doc_id"], r["text"]) for r in messy.collect()]), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=0.08, abs=0.2)


def test_held_out_text_is_likelier_than_by_words_alone(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = score_documents(df).where("held_out")
    model, base = held.selectExpr("sum(score)", "sum(base_score)").first()
    assert model > base


def test_empty(empty):
    assert score_documents(empty).isEmpty()


def test_followers_of_one_word_go_to_several_parts(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "HOT_ENTRIES", 40)
    monkeypatch.setattr(ngrams, "CHUNK_TOKENS", 120)
    sizes, serve = spark.sparkContext.accumulator(0), ngrams._serve  # parts with very many entries of one word

    def largest(blobs):
        entries = Counter()
        for words, _, degrees, *_ in map(ngrams._opened, blobs["data"]):
            entries.update(dict(zip(words.tolist(), degrees.tolist())))
        if max(entries.values()) > 120:
            sizes.add(1)
        return serve(blobs)

    monkeypatch.setattr(ngrams, "_serve", largest)
    rows = [(i, " ".join(f"the w{(i * 7 + j * j) % 300}" for j in range(20))) for i in range(60)]
    found = score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got, want = sorted(tuple(r) for r in found), sorted(expected(rows))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=0.01)
    assert sizes.value == 0


def test_columns_without_a_model_agree_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(LM_BASE_SQL).fetchall()}
    got = {r["doc_id"]: tuple(r)[1:6] for r in lm_scoring(spark, folder).collect()}
    assert got.keys() == want.keys() and any(r[0] for r in want.values())
    for key, row in want.items():
        assert got[key][:4] == row[:4] and got[key][4] == pytest.approx(row[4], rel=1e-9)
