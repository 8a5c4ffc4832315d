import random
import re
import tracemalloc
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assay.llm import decontaminate as dc


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items, window):
    ws, hit, names = words(text), set(), set()
    for item, t in items:
        mine = words(t)
        n = min(window, len(mine))
        for i in range(len(mine) - n + 1 if n else 0):
            for j in range(len(ws) - n + 1):
                if ws[j : j + n] == mine[i : i + n]:
                    hit |= set(range(j, j + n))
                    names.add(item)
    return len(ws), len(hit), sorted(names)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab ", max_size=30), max_size=4), st.text("ab ", max_size=60))
def test_wu_manber(tests, text):
    items = [(str(n), t) for n, t in enumerate(tests)]
    spans, names = dc.occurrences(dc.words(text.encode()), dc.compile_items([(i, t.encode()) for i, t in items], 3))
    assert (len(words(text)), sum(b - a for a, b in spans), sorted(names)) == brute(text, items, 3)


@pytest.mark.parametrize("table_bytes", [dc.TABLE_BYTES, 200])
def test_messy(spark, messy, monkeypatch, table_bytes):
    monkeypatch.setattr(dc, "TABLE_BYTES", table_bytes)
    texts = {r["doc_id"]: r["text"] for r in messy.where("doc_id is not null").collect()}
    items = [("1", texts[28]), ("2", texts[37]), ("10", texts[20]), ("", "é"), ("5", None), ("6", "")]
    tests = spark.createDataFrame([(i or None, t, 0) for i, t in items], "item_id string, text string, spans int")
    found = dc.search(messy, tests)
    got = Counter((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), tuple(r["items"])) for r in found.collect())
    want = Counter()
    for r in messy.collect():
        n, hit, names = brute(r["text"], items, dc.WINDOW)
        want[r["doc_id"], n, hit, tuple(names)] += 1
    assert got == want
    judged = dc.judge(found)
    assert judged.where("contaminated != (n_hit > 0 and 20 * n_hit >= n_words)").isEmpty()


def test_blocks_are_bounded_and_repeats_count_once(spark, monkeypatch):
    """A third of the test rows is one row; the others fall into blocks whose sizes are proved."""
    monkeypatch.setattr(dc, "TABLE_BYTES", 1000)
    rows = [("x", "same words " * 20)] * 300 + [(str(n), f"item {n} " * 15) for n in range(60)] + [("long", "y " * 3000)]
    named = spark.createDataFrame(rows, "item string, text string").distinct()
    blocks = dc._blocks(named)
    sums = {}
    for r in named.select("text", dc._block(blocks).alias("b")).collect():
        sums.setdefault(r["b"], []).append(len(r["text"]))
    assert named.count() == 62 and all(sum(x) - max(x) <= 1000 for x in sums.values())


def test_tables_of_a_block_fit_a_worker():
    rng = random.Random(2)
    items = [(str(n), " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(100)).encode()) for n in range(300)]
    text = sum(len(t) for _, t in items)
    tracemalloc.start()
    searchers = dc.compile_items(items, dc.WINDOW)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert searchers and held / text * dc.TABLE_BYTES < 600 << 20


def test_empty(messy, empty):
    tests = messy.selectExpr("doc_id item_id", "text")
    assert dc.search(empty, tests).isEmpty()
    assert dc.search(messy, tests.where("false")).where("size(spans) > 0").isEmpty()
