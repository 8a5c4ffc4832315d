import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assay.llm import infill

UNIT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(key, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"42:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return key, len(units), "plain", None, None, sha(text), sha(text), text
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    spm = h4 % 100 < 80
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return key, len(units), "spm" if spm else "psm", len(prefix), len(middle), sha(out), sha(text), out


@pytest.fixture(scope="module")
def marked(spark, messy):
    """The messy table with control strings, whole and nearly, in some texts."""
    more = [(n, t) for n in range(100, 160) for t in ["a <P> b", "<S", "a <P< S> <M", "P> x <", " <"][n % 5 : n % 5 + 1]]
    return messy.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)


@pytest.mark.parametrize("size", [infill.PIECE_BYTES, 40])
def test_brute_force(marked, size):
    want = Counter(expected(r["doc_id"], r["text"])[:7] for r in marked.collect())
    out = infill.fill_in_middle(marked, size=size)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert Counter(map(tuple, out.collect())) == want
    assert {form for _, _, form, *_ in want} == {"plain", "psm", "spm"}


def test_output_texts(marked):
    want = Counter((r["doc_id"], expected(r["doc_id"], r["text"])[7]) for r in marked.collect())
    out = infill.output_texts(infill.output_pieces(marked, size=50))
    assert Counter((r["key"], r["output"]) for r in out.collect()) == want


def test_one_shuffle(marked):
    plan = infill.fill_in_middle(marked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(row") == 1 and plan.count("Sort [") == 2


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab<PSM> \n\x0b　é\U0001f600")), max_size=60), st.integers(1, 9), st.integers(0, 50))
def test_round_trip(text, size, key):
    data = text.encode()
    (n, form, *_), pieces = infill._pieces(key, data, 42, 100, 50, size)
    assert n == len(UNIT.findall(text))
    reader = infill.Restorer(form)
    found = [x for p in pieces for x in reader.feed(p)] + list(reader.feed(b"", last=True))
    assert b"".join(d for _, d in sorted(found, key=lambda x: x[0])) == data


def test_pieces_are_bounded(spark):
    rows = [(1, "x" * 100_000), (2, "word " * 30_000), (3, "\n" * 50_000)]
    pieces = infill.output_pieces(spark.createDataFrame(rows, "doc_id long, text string"), fim=100)
    assert max(len(r["data"]) for r in pieces.select("data").collect()) <= infill.PIECE_BYTES + 3


def test_text_keys(spark):
    df = spark.createDataFrame([("k1", "one two three"), (None, None)], "doc_id string, text string")
    assert Counter(map(tuple, infill.fill_in_middle(df).collect())) == Counter(expected(k, t)[:7] for k, t in [("k1", "one two three"), (None, None)])


def test_empty(empty):
    out = infill.fill_in_middle(empty)
    assert out.isEmpty() and dict(out.dtypes)["doc_id"] == "bigint"
