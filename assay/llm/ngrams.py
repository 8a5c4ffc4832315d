"""Scoring text with an n-gram model in tries of Elias-Fano levels, one trie per part of the words.

The model is an interpolated bigram model with Witten-Bell smoothing over the additive unigram model:
``p(w | c) = (n(c, w) + t(c) p(w)) / (n(c) + t(c))``, where t(c) is the number of different words after c.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from assay.llm.common import cuts, pack, parts_for, single_rows, text_bytes, unpack
from assay.llm.eliasfano import EliasFano, mapped
from assay.session import settle

ADDED = 0.1
CHUNK_TOKENS = 1 << 20
CACHE_ENTRIES = 300_000
#: Bytes of text whose bigrams one task serves.
TEXT_EACH = 12 << 20
#: Bigram entries of one context that one task serves; a more frequent context is dealt by its next words.
HOT_ENTRIES = 1 << 18
KEY_BITS, NEXT_BITS = 48, 40
START, END = 1, 2  # word hashes of the two ends of a text


class WordKeys(dict):
    """Scattered 64-bit keys of words, so that key order can be cut into even parts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word, 17)
        return found


_KEYS = WordKeys()
START_KEY, END_KEY = (np.uint64(xxhash.xxh3_64_intdigest(bytes([n]), 18)) for n in (START, END))


def _chunks(docs: DataFrame) -> DataFrame:
    """Tokens of many documents to a row: their words in key order, and the words' ranks in order of text."""
    kind = docs.schema["key"].dataType
    schema = pa.schema(
        [("chunk", pa.int64()), ("keys", pa.list_(to_arrow_type(kind))), ("held", pa.binary()), ("lengths", pa.binary())]
        + [("words", pa.binary()), ("ids", pa.binary())]
    )

    def made(chunk, keys, held, tokens):
        lengths = np.array([len(t) for t in tokens], np.int64)
        words, ids = np.unique(np.concatenate([*tokens, np.array([START_KEY, END_KEY])]), return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk]), pa.array([keys], schema.field("keys").type), pa.array([np.array(held, bool).tobytes()])]
            + [pa.array([lengths.tobytes()]), pa.array([words.tobytes()]), pa.array([pack(ids[:-2], 3)])],
            schema=schema,
        )

    def run(source):
        keys, held, tokens, total, chunk = [], [], [], 0, None
        for batch in source:
            for row, key, out, text in zip(*[batch.column(c).to_pylist() for c in ("row", "key", "held")], batch.column("text")):
                ws = text.as_py().lower().split()
                keyed = np.empty(len(ws) + 1, np.uint64)
                keyed[:-1] = np.fromiter(map(_KEYS.__getitem__, ws), np.uint64, len(ws))
                keyed[-1] = END_KEY
                chunk = row if chunk is None else chunk
                keys.append(key)
                held.append(out)
                tokens.append(keyed)
                total += len(keyed)
                if total >= CHUNK_TOKENS:
                    yield made(chunk, keys, held, tokens)
                    keys, held, tokens, total, chunk = [], [], [], 0, None
        if keys:
            yield made(chunk, keys, held, tokens)

    return docs.mapInArrow(
        run, f"chunk bigint, keys array<{kind.simpleString()}>, held binary, lengths binary, words binary, ids binary"
    )


class Chunk:
    """Opened chunk: `pairs` are the distinct (context, word) codes in order of both keys."""

    def __init__(self, row, pairs: bool = True):
        self.held = np.frombuffer(row["held"], bool)
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.ids = unpack(row["ids"], 3).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        context = np.empty_like(self.ids)
        context[1:] = self.ids[:-1]
        context[self.starts] = np.searchsorted(self.words, START_KEY)
        self.context = context
        if pairs:
            self.pairs, self.pair_of = np.unique(context * len(self.words) + self.ids, return_inverse=True)

    def followers(self, key: np.uint64) -> tuple[int, int]:
        """The range of a context's pairs; empty if the chunk has none."""
        m, rank = len(self.words), int(np.searchsorted(self.words, key))
        if rank == m or self.words[rank] != key:
            return 0, 0
        return tuple(int(x) for x in np.searchsorted(self.pairs, [rank * m, (rank + 1) * m]))


def _hot(chunks: DataFrame) -> list[tuple[int, int]]:
    """(context, number of salts) of contexts with more entries than a task should serve, in order of key.

    A chunk leaves out contexts of which it has few entries, so few that all chunks together leave out less
    than half of what makes a context hot. The list is at most two contexts for each `HOT_ENTRIES` entries.
    """
    limit = HOT_ENTRIES
    least = max(1, limit // (2 * max(1, chunks.count())))

    def run(source):
        for row in single_rows(source):
            c = Chunk(row, pairs=False)
            m = len(c.words)
            often = (np.bincount(c.context, minlength=m) >= least)[c.context]
            pairs = np.unique(c.context[often] * m + c.ids[often])
            degrees = np.bincount(pairs // m, minlength=m)
            at = np.flatnonzero(degrees >= least)
            yield pa.RecordBatch.from_pydict({"context": pa.array(c.words[at].view(np.int64)), "entries": pa.array(degrees[at], pa.int64())})

    sums = chunks.mapInArrow(run, "context bigint, entries bigint").groupBy("context").agg(F.sum("entries").alias("entries"))
    found = sums.where(F.col("entries") * 2 > limit).collect()
    return sorted((r["context"] % (1 << 64), max(2, -(-(2 * r["entries"] + limit) // (2 * limit)))) for r in found)


def _deal(chunks: DataFrame, parts: int, hot: list[tuple[int, int]]) -> DataFrame:
    """(part, chunk, hot, data): a chunk's words of each part with their counts and the words that follow them.

    The followers of a hot context go to parts of its own, after all others, by ranges of their keys.
    """
    hot_keys = np.array([k for k, _ in hot], np.uint64)
    salts = np.array([n for _, n in hot], np.int64)
    hot_parts = parts + np.cumsum(salts) - salts

    def packed(words, counts, degrees, nexts, pair_counts):
        large = np.flatnonzero(pair_counts > 254)
        data = [np.array([len(words), len(nexts), len(large)], "<i8").tobytes()]
        data += [pack(words, 6), pack(counts, 4), pack(degrees, 4), pack(nexts, 5)]
        data += [np.minimum(pair_counts, 255).astype(np.uint8).tobytes()]
        data += [large.astype("<i8").tobytes(), pair_counts[large].astype("<i8").tobytes()]
        return b"".join(data)

    def sent(part, chunk, context, data):
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int64()), "hot": pa.array([context], pa.int64()), "data": [data]}
        )

    def run(source):
        for row in single_rows(source):
            c = Chunk(row)
            m = len(c.words)
            trained = np.repeat(~c.held, c.lengths)
            counts = np.bincount(c.ids[trained], minlength=m)
            pair_counts = np.bincount(c.pair_of, trained, len(c.pairs)).astype(np.int64)
            nexts = c.words[c.pairs % m] >> np.uint64(64 - NEXT_BITS)
            apart = np.zeros(len(c.pairs), bool)
            for key, n, first in zip(hot_keys, salts, hot_parts):
                x, y = c.followers(key)
                apart[x:y] = True
                bounds = x + cuts(c.words[c.pairs[x:y] % m], int(n))
                for salt in np.flatnonzero(np.diff(bounds)):
                    a, b = bounds[salt], bounds[salt + 1]
                    # Its own count goes with its word, so here it is none.
                    data = packed(np.array([key]), np.zeros(1, np.int64), np.array([b - a]), nexts[a:b], pair_counts[a:b])
                    yield sent(first + salt, row["chunk"], np.uint64(key).view(np.int64), data)
            pairs, nexts, pair_counts = c.pairs[~apart], nexts[~apart], pair_counts[~apart]
            degrees = np.bincount(pairs // m, minlength=m)
            bounds = cuts(c.words, parts)
            pair_bounds = np.searchsorted(pairs, bounds * m)
            for part in np.flatnonzero(np.diff(bounds)):
                a, b = bounds[part], bounds[part + 1]
                x, y = pair_bounds[part], pair_bounds[part + 1]
                data = packed(c.words[a:b], counts[a:b], degrees[a:b], nexts[x:y], pair_counts[x:y])
                yield sent(part, row["chunk"], None, data)

    return chunks.mapInArrow(run, "part int, chunk bigint, hot bigint, data binary")


def _opened(data: bytes):
    m, n, k = np.frombuffer(data, "<i8", 3)
    at, out = 24, []
    for count, width in ((m, 6), (m, 4), (m, 4), (n, 5)):
        out.append(unpack(data[at : at + count * width], width))
        at += int(count * width)
    pair_counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    large = np.frombuffer(data, "<i8", 2 * k, at + int(n))
    pair_counts[large[:k]] = large[k:]
    return out[0], out[1].astype(np.int64), out[2].astype(np.int64), out[3], pair_counts


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes from 1, one byte each, and their values: each bin by the mean of its logarithms.

    Half of the bounds are quantiles, the others lie evenly on the logarithmic and on the plain scale, so
    that rare large values are as exact as frequent small ones.
    """
    if not len(values):
        return np.empty(0, np.uint8), np.zeros(256, np.float32)
    logs = np.log(values)
    low, high = logs.min(), logs.max()
    even = np.log(np.linspace(np.exp(low), np.exp(high), 66)[1:-1])
    edges = np.unique(np.concatenate([np.quantile(logs, np.linspace(0, 1, 128)[1:-1]), np.linspace(low, high, 66)[1:-1], even]))
    bins = np.searchsorted(edges, logs, side="right")
    counts = np.bincount(bins, minlength=255)
    means = np.exp(np.bincount(bins, logs, 255) / np.maximum(1, counts))
    return (bins + 1).astype(np.uint8), np.concatenate([[0], means]).astype(np.float32)


class Trie:
    """Words, and under each the words that follow it, as mapped Elias-Fano levels.

    A child's key is made relative to its context by adding the context's base, its rank in the first
    level, so the second level is monotone as a whole and one successor search finds a child.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, codes: np.ndarray, pair_counts: np.ndarray):
        n = len(words)
        self.words = EliasFano(words, 1 << KEY_BITS)
        self.children = EliasFano(codes, max(1, n) << NEXT_BITS)
        of = (codes >> np.uint64(NEXT_BITS)).astype(np.int64)
        kinds = np.bincount(of, minlength=n)
        self.pointers = EliasFano(np.concatenate([[0], np.cumsum(kinds)]).astype(np.uint64), len(codes) + 1)
        mass = np.bincount(of, pair_counts, n) + kinds
        share, self.share_values = quantise(pair_counts / mass[of])
        follows = kinds > 0
        weight = np.zeros(n, np.uint8)
        weight[follows], self.weight_values = quantise(kinds[follows] / mass[follows])
        levels = [self.words, self.children, self.pointers]
        arrays = mapped([a for level in levels for a in level.arrays()] + [counts, weight, share])
        for level, high, low in zip(levels, arrays[0:6:2], arrays[1:6:2]):
            level.adopt(high, low)
        self.counts, self.weight, self.share = arrays[6:]
        self.words.open()
        self.children.open()

    def find_words(self, keys: np.ndarray) -> np.ndarray:
        at, _ = self.words.successor(keys)
        return at

    def find_children(self, ranks: np.ndarray, nexts: np.ndarray) -> np.ndarray:
        """Quantised shares of (context rank, next word); 0 where training has none."""
        at, equal = self.children.successor((ranks.astype(np.uint64) << np.uint64(NEXT_BITS)) | nexts)
        out = np.zeros(len(at), np.uint8)
        out[equal] = self.share[at[equal]]
        return out


def _serve(blobs: pd.DataFrame) -> pd.DataFrame:
    """Builds the trie of a part and answers each chunk in the order of its request."""
    opened = [_opened(d) for d in blobs["data"]]
    words, at = np.unique(np.concatenate([o[0] for o in opened]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([o[1] for o in opened]), len(words)).astype(np.int64)
    ranks = np.repeat(at, np.concatenate([o[2] for o in opened])).astype(np.uint64)
    codes = (ranks << np.uint64(NEXT_BITS)) | np.concatenate([o[3] for o in opened])
    pair_counts = np.concatenate([o[4] for o in opened])
    codes, pair_counts = codes[pair_counts > 0], pair_counts[pair_counts > 0]
    order = np.argsort(codes)
    codes, pair_counts = codes[order], pair_counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    summed = np.add.reduceat(pair_counts, first) if len(first) else pair_counts
    trie = Trie(words, counts, codes[first], summed)
    del at, ranks, codes, pair_counts, order
    tokens, kinds = int(counts.sum()), int((counts > 0).sum())
    followers, mass = len(first), int(summed.sum()) + len(first)
    books = trie.share_values.tobytes() + trie.weight_values.tobytes()
    answers = []
    for keys, _, degrees, nexts, _ in opened:
        ranks = trie.find_words(keys)
        shares = trie.find_children(np.repeat(ranks, degrees), nexts)
        answers.append(pack(trie.counts[ranks], 4) + trie.weight[ranks].tobytes() + shares.tobytes())
    return pd.DataFrame(
        {
            "part": blobs["part"],
            "chunk": blobs["chunk"],
            "n_words": [len(o[0]) for o in opened],
            "data": answers,
            "books": books,
            "tokens": [tokens] + [0] * (len(blobs) - 1),  # once per part
            "kinds": [kinds] + [0] * (len(blobs) - 1),
            "hot": blobs["hot"].astype("Int64"),
            "mass": mass,
            "mass_once": [mass] + [0] * (len(blobs) - 1),
            "followers": [followers] + [0] * (len(blobs) - 1),
        }
    )


def _score(asked: DataFrame, kind: str, tokens: int, kinds: int) -> DataFrame:
    def run(source):
        total = tokens + ADDED * (kinds + 1)
        for row in single_rows(source):
            c = Chunk(row)
            counts, weights, shares = [], [], []
            pair_shares, apart, hot = np.zeros(len(c.pairs)), np.zeros(len(c.pairs), bool), {}
            for r in sorted(row["answers"], key=lambda r: r["part"]):
                m = r["n_words"]
                books = np.frombuffer(r["books"], np.float32).reshape(2, -1)
                body = np.frombuffer(r["data"], np.uint8, -1, 4 * m)
                if r["hot"] is not None:
                    # A part's shares are of its own mass, and the context's is that of all its parts.
                    hot.setdefault(r["hot"], ([], r["whole"], r["kinds"]))[0].append(books[0][body[m:]] * (r["mass"] / max(1, r["whole"])))
                    continue
                counts.append(unpack(r["data"][: 4 * m], 4))
                codes = body[:m]
                weights.append(np.where(codes > 0, books[1][codes], 1))
                shares.append(books[0][body[m:]])
            counts, weights, shares = (np.concatenate(x).astype(float) for x in (counts, weights, shares))
            for key, (found, whole, followers) in hot.items():
                x, y = c.followers(np.int64(key).view(np.uint64))
                pair_shares[x:y], apart[x:y] = np.concatenate(found), True
                if followers:
                    weights[c.pairs[x] // len(c.words)] = followers / whole
            pair_shares[~apart] = shares
            base = (counts + ADDED) / total
            p = pair_shares[c.pair_of] + weights[c.context] * base[c.ids]
            add = lambda values: np.add.reduceat(values, c.starts)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": row["keys"],
                    "held_out": c.held,
                    "n_tokens": c.lengths,
                    "n_known": add((counts > 0)[c.ids].astype(np.int64)),
                    "train_tokens": np.full(len(c.held), tokens),
                    "base_score": add(np.log10(base)[c.ids]),
                    "score": add(np.log10(p)),
                }
            )

    return asked.mapInArrow(
        run, f"key {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def score_documents(df: DataFrame, key: str = "doc_id", text: str = "text", held_modulo: int = 10) -> DataFrame:
    """Trains on the documents whose crc32(key as text) mod `held_modulo` is not 0, and scores all.

    Tokens are runs of anything but ASCII white space after lower-casing A-Z, then an end. Returns key,
    held_out, n_tokens, n_known, train_tokens, base_score (additive unigrams) and score (the bigram model),
    both log10. A null text has its end only; a null key counts as the text ''. Repeated rows are
    counted and scored each. An empty table gives an empty result; extra columns are not read.

    Words have 64-bit keys. Texts are read once, into chunks of tokens. Each chunk sends its distinct
    bigrams to the parts of their first words and gets quantised probabilities back, so a frequent word
    costs a part no more than its distinct followers. A word whose followers are more than `HOT_ENTRIES`
    over all chunks has parts of its own, each for a range of followers, and their sums are added up afterwards.
    Only the keys of such words go to all tasks, and nothing else of the model.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    docs = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        (F.pmod(F.crc32(name), F.lit(held_modulo)) == 0).alias("held"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    chunks = settle(_chunks(docs), "chunks")
    parts = parts_for(text_bytes(docs), each=TEXT_EACH)
    hot = _hot(chunks)
    dealt = _deal(chunks, parts, hot).repartition(parts + sum(n for _, n in hot), "part")
    served = dealt.groupBy("part").applyInPandas(
        _serve,
        "part int, chunk bigint, n_words bigint, data binary, books binary, tokens bigint, kinds bigint, "
        "hot bigint, mass bigint, mass_once bigint, followers bigint",
    )
    served = settle(served, "answers")
    tokens, kinds = served.agg(F.sum("tokens"), F.sum("kinds")).first()
    none = F.lit(None).cast("bigint")
    replies = served.where("hot is null").select("chunk", "part", "n_words", "data", "books", "hot", "mass", none.alias("whole"), none.alias("kinds"))
    if hot:
        split = served.where("hot is not null")
        wholes = settle(split.groupBy("hot").agg(F.sum("mass_once").alias("whole"), F.sum("followers").alias("kinds")), "masses")
        replies = replies.unionByName(split.drop("kinds").join(wholes, "hot").select(replies.columns))
    answers = replies.groupBy("chunk").agg(F.collect_list(F.struct(*[c for c in replies.columns if c != "chunk"])).alias("answers"))
    scored = _score(chunks.join(answers, "chunk"), docs.schema["key"].dataType.simpleString(), tokens or 0, kinds or 0)
    return scored.withColumnRenamed("key", key)
