"""Benchmark passages in documents, by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import uuid
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from assay.session import settle

WINDOW = 13
BLOCK = 2
#: Bytes of test text whose tables one task holds at a time; larger test sets are searched in blocks.
#: The tables take about 170 bytes for one of text, so a block's stay under 400 MB in a worker.
TABLE_BYTES = 2 << 20

# Bytes that are part of a word, A-Z in lower case; all others end one.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class WuManber:
    """Patterns of one length in words. Positions are those of a pattern's last word."""

    def __init__(self, length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, dict[tuple, set]]] = defaultdict(lambda: defaultdict(dict))

    def add(self, pattern: tuple, item: str) -> None:
        """Record how far each block lies from the end; file the pattern under its last and first block."""
        size = self.block
        for end in range(size, self.length + 1):
            block, far = pattern[end - size : end], self.length - end
            self.shift[block] = min(far, self.shift.get(block, far))
        self.buckets[pattern[-size:]][pattern[:size]].setdefault(pattern, set()).add(item)

    def search(self, text: list[bytes], found: set[str]) -> list[int]:
        """Start positions of all occurrences; adds their items to `found`."""
        length, size, get = self.length, self.block, self.shift.get
        unseen, starts, at, n = length - size + 1, [], length, len(text)
        while at <= n:
            block = tuple(text[at - size : at])
            far = get(block, unseen)
            if far:
                at += far
                continue
            start = at - length
            patterns = self.buckets[block].get(tuple(text[start : start + size]))
            if patterns:
                items = patterns.get(tuple(text[start:at]))
                if items:
                    starts.append(start)
                    found |= items
            at += 1
        return starts


def compile_items(items: list[tuple[str, bytes]], window: int) -> list[WuManber]:
    """A searcher for each pattern length: `window`, or all words of an item that has fewer."""
    searchers: dict[int, WuManber] = {}
    for item, text in items:
        ws = words(text)
        if ws:
            length = min(window, len(ws))
            searcher = searchers.setdefault(length, WuManber(length))
            for at in range(len(ws) - length + 1):
                searcher.add(tuple(ws[at : at + length]), item)
    return list(searchers.values())


def occurrences(text: list[bytes], searchers: list[WuManber]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged word ranges that occurrences cover, and the items that occur."""
    found: set[str] = set()
    hits = sorted((start, start + s.length) for s in searchers for start in s.search(text, found))
    merged: list[tuple[int, int]] = []
    for start, end in hits:
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged, found


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_COMPILED: dict[str, list[WuManber]] = {}


def _searched(docs: DataFrame, items: list[tuple[str, bytes]], window: int) -> DataFrame:
    """`docs` (keys..., text as binary) without the text, with n_words, spans and items."""
    shared, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    keys = [f for f in docs.schema.fields if f.name != "text"]
    schema = pa.schema(
        [(f.name, to_arrow_type(f.dataType)) for f in keys]
        + [("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))]
    )

    def run(source):
        if name not in _COMPILED:
            _COMPILED.clear()
            _COMPILED[name] = compile_items(shared.value, window)
        searchers = _COMPILED[name]
        for batch in source:
            n_words, spans, names = [], [], []
            for text in batch.column("text"):
                ws = words(text.as_py() or b"")
                merged, found = occurrences(ws, searchers)
                n_words.append(len(ws))
                spans.append([{"start": a, "end": b} for a, b in merged])
                names.append(sorted(found))
            kept = [batch.column(f.name).cast(schema.field(f.name).type) for f in keys]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(names, pa.list_(pa.string()))],
                schema=schema,
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys)
    return docs.mapInArrow(run, f"{kinds}, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>")


def search(
    df: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """key, n_words, spans (word ranges covered by test windows, merged) and items (that have them).

    A window is `window` consecutive words of a test text, or all its words if it has fewer. Words are
    runs of a-z, 0-9 and non-ASCII bytes after lower-casing A-Z. Null texts have no words; null item
    ids count as empty. Repeated rows keep a row each. An empty test set covers nothing. Extra columns
    are not read.

    Documents are searched where they are read, without a shuffle. The test set is the query: its
    different rows are broadcast in blocks of at most `TABLE_BYTES` of text beside a block's longest row.
    """
    named = tests.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    named = settle(named.distinct(), "tests")
    blocks = _blocks(named)
    docs = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    if blocks > 1:
        docs = settle(docs.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    found = []
    for block in range(blocks):
        mine = named if blocks == 1 else named.where(_block(blocks) == block)
        items = [(r["item"], r["text"].encode()) for r in mine.toLocalIterator()]
        found.append(_searched(docs, items, window))
    if blocks == 1:
        return found[0].withColumnRenamed("key", key)
    union = found[0]
    for other in found[1:]:
        union = union.unionByName(other)
    together = union.groupBy("row").agg(
        F.first("key").alias("key"),
        F.first("n_words").alias("n_words"),
        merge_spans(F.array_sort(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return together.select(F.col("key").alias(key), "n_words", "spans", "items")


def _blocks(named: DataFrame) -> int:
    """Into how many blocks the test rows go by hash, so that none is too large; sizes are summed to prove it."""
    size, blocks = F.octet_length("text").cast("long"), 1
    while True:
        sums = named.groupBy(_block(blocks).alias("block")).agg((F.sum(size) - F.max(size)).alias("beside"))
        if (sums.agg(F.max("beside")).first()[0] or 0) <= TABLE_BYTES:
            return blocks
        blocks *= 2


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("item", "text"), F.lit(blocks))


def merge_spans(spans: Column) -> Column:
    """Overlapping or touching sorted spans as one."""

    def add(done, span):
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(
            joins, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), add)


def judge(found: DataFrame, key: str = "doc_id", least_share: int = 20) -> DataFrame:
    """Counts per document, and whether a `least_share`-th of its words or more is hit."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        key,
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * least_share >= F.col("n_words")))
