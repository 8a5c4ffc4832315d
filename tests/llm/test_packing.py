import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assay.llm import packing
from assay.session import settle

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ADDED = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return packing.ChunkEncoder(RANKS, public_tokenizers.PATTERN, ADDED)


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.sampled_from(list("ab' 's\n\t,.1é  \x85\U0001f600")), max_size=40))
def test_ids_are_the_tokenizers(tokenizer, encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


END = "<|endoftext|>"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([END, "<|endoftext", "|>", " ", "a", " word", "\n", "é", "  ", "<", "'s"]), max_size=12))
def test_added_tokens_are_one_id(tokenizer, encoder, parts):
    text = "".join(parts)
    ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert ids.count(ADDED[END]) == text.count(END)


@pytest.mark.parametrize("text", [END, f"hello {END} world", f"{END}{END}", f"{END} a", f"a {END}", f" {END} "])
def test_added_tokens_inside_at_the_ends_and_repeated(tokenizer, encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_longest_added_token_wins():
    encoder = packing.ChunkEncoder(RANKS, public_tokenizers.PATTERN, {"<a>": 60000, "<a><b>": 60001})
    assert np.frombuffer(encoder.encode("<a><b><a>"), "<u4").tolist() == [60001, 60000]


def best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(bins) if room >= n]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    return len(bins)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_decreasing(lengths):
    lengths = np.array(lengths, np.int64)
    bins, offsets, n = packing.best_fit_decreasing(lengths, 20)
    assert n == best_fit(lengths.tolist(), 20) >= packing.lower_bound(lengths, 20)
    for b in range(n):
        mine = np.argsort(offsets[bins == b])
        sizes = lengths[bins == b][mine]
        assert np.array_equal(offsets[bins == b][mine], np.cumsum(sizes) - sizes) and sizes.sum() <= 20


def least_bins(lengths, capacity):
    """Exact, by trying all ways to fill one bin with the first piece."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for mask in range(1 << len(rest)):
        if first + sum(x for i, x in enumerate(rest) if mask >> i & 1) <= capacity:
            best = min(best, 1 + least_bins([x for i, x in enumerate(rest) if not mask >> i & 1], capacity))
    return best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=6))
def test_lower_bound(lengths):
    assert packing.lower_bound(np.array(lengths), 12) <= least_bins(lengths, 12) <= best_fit(lengths, 12)


def test_bounds_beyond_the_sum():
    assert packing.lower_bound(np.array([7, 7, 7]), 12) == 3
    assert packing.lower_bound(np.array([5, 5, 5, 5, 5]), 12) == 3


def check(df, out, tokenizer, capacity):
    want, got = defaultdict(list), defaultdict(list)
    for r in df.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        head = len(ids) % capacity if len(ids) > capacity else len(ids)
        at = [0, *range(head or capacity, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(at, at[1:])):
            want[r["doc_id"]].append((n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    sequences = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(n for v in want.values() for *_, n, _ in v)
    assert len(sequences) <= -(-total // capacity) + 2


@pytest.mark.parametrize("part_rows", [packing.PART_ROWS, 40])
def test_messy(spark, messy, tokenizer, part_rows):
    more = [(500 + n, t) for n, t in enumerate([END, f"x{END}y", f"{END} " * 90, f"a {END}{END}b"])]
    messy = messy.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    out = packing.pack_documents(messy, RANKS, public_tokenizers.PATTERN, capacity=64, added=ADDED, part_rows=part_rows)
    check(messy, out, tokenizer, 64)


def test_parts_with_gaps_exchange_documents(spark):
    """Fifteen parts reach nearly what one part does."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = settle(packing.pieces(docs, RANKS, public_tokenizers.PATTERN, 2, 1024), "pieces")
    bound = packing.lower_bound(np.array([r[0] for r in rows.select("length").collect()]), 1024)
    out = packing.pack(rows, 1024, part_rows=100).toPandas()
    assert rows.count() == len(out) and bound <= out["sequence_id"].nunique() <= bound + 4
    for _, bin_ in out.sort_values("offset").groupby("sequence_id"):
        assert (bin_["offset"] == bin_["length"].cumsum() - bin_["length"]).all() and bin_["length"].sum() <= 1024


def test_empty(empty):
    assert packing.pack_documents(empty, RANKS, public_tokenizers.PATTERN).isEmpty()


def test_vocabularies_agree(encoder):
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
        assert len(json.load(f)["model"]["vocab"]) == encoder.encoding.n_vocab
