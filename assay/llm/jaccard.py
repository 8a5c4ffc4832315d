"""Documents linked by the Jaccard similarity of their word shingles: an exact T-occurrence join."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import cuts, pack, parts_for, single_rows, text_bytes, unpack
from assay.llm.components import connected
from assay.session import settle

WORDS = 5
PERCENT = 80
CACHE_ENTRIES = 300_000
#: Entries that a task gathers before it deals them, and entries of a group that one task joins at a time.
FLUSH_ENTRIES = 4 << 20
GROUP_ENTRIES = 8 << 20
#: Up to so many entries a heap merges inverted lists; beyond, a merge sort of the same lists does.
HEAP_ENTRIES = 2048
MIX = np.uint64(0xFF51AFD7ED558CCD)
HIGH = np.uint64(33)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = WordHashes()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> HIGH)) * MIX
    return h ^ (h >> HIGH)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `words` words, or of the whole if it has fewer."""
    ws = text.lower().split()
    h = np.fromiter(map(_HASHES.__getitem__, ws), np.uint64, len(ws))
    size = min(words, len(h))
    if not size:
        return h
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = mixed(out + h[j : j + n])
    return np.unique(out)


def needed(n):
    """The least overlap of a set of n with any set that it links with."""
    return -(-n * PERCENT // 100)


def test_prefix(n):
    """Shingles, in any one order of all, that a filter on shared shingles must look at, and its threshold.

    Two linked sets share t of their first n - needed(n) + t, for the t of either; the other set has
    at least `PERCENT` of n, so its own t is not much less.
    """
    tested = -(-n // 10)
    return n - needed(n) + tested, np.maximum(1, n * PERCENT // 1000)


_ROW = pa.schema([("key", pa.string()), ("n", pa.int64()), ("node", pa.int64())])
_BLOB = pa.schema([("part", pa.int32()), ("data", pa.binary())])


def _entries_out(nodes: list, hashes: list, parts: int):
    """Packed (hash, node) entries for each part."""
    of = np.repeat(np.arange(len(nodes)), [len(h) for h in hashes])
    keys = mixed(np.concatenate(hashes)) if hashes else np.empty(0, np.uint64)
    order = np.argsort(keys)
    keys, of, nodes = keys[order], of[order], np.array(nodes, np.int64)
    bounds = cuts(keys, parts)
    for part in np.flatnonzero(np.diff(bounds)):
        a, b = bounds[part], bounds[part + 1]
        mine, at = np.unique(of[a:b], return_inverse=True)
        yield int(part), np.array([len(mine), b - a], "<u4").tobytes() + nodes[mine].tobytes() + pack(at, 4) + pack(keys[a:b], 6)


def _entries_in(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and keys (their low 48 bits) of packed entries."""
    m, n = np.frombuffer(data, "<u4", 2)
    nodes = np.frombuffer(data, np.int64, m, 8)
    body = 8 + 8 * int(m)
    return nodes[unpack(data[body : body + 4 * n], 4).astype(np.int64)], unpack(data[body + 4 * n :], 6)


def _deal(docs: DataFrame, parts: int, prefix_only: bool) -> DataFrame:
    """(part, data): entries of documents (node, n, hashes) dealt by shingle."""

    def run(source):
        nodes, hashes, held, seen = [], [], 0, set()
        for batch in source:
            for text in batch.column("text"):
                h = shingles(text.as_py() or b"")
                node = node_of(h)
                if not len(h) or node in seen:
                    continue
                seen.add(node)
                if prefix_only:
                    h = h[: test_prefix(len(h))[0]]
                nodes.append(node)
                hashes.append(h)
                held += len(h)
                if held >= FLUSH_ENTRIES:
                    yield from _blobs(_entries_out(nodes, hashes, parts))
                    nodes, hashes, held, seen = [], [], 0, set()
        yield from _blobs(_entries_out(nodes, hashes, parts))

    return docs.mapInArrow(run, "part int, data binary")


def _blobs(made):
    for part, data in made:
        yield pa.RecordBatch.from_pydict({"part": [part], "data": [data]}, schema=_BLOB)


def node_of(h: np.ndarray) -> int:
    """The identity of a set: 63 bits of the digest of its sorted hashes."""
    return xxhash.xxh3_64_intdigest(h.tobytes()) >> 1


def classes(docs: DataFrame) -> DataFrame:
    """(key, digest, n, node) of documents (key, digest, text): equal shingle sets have equal nodes."""

    def run(source):
        for batch in source:
            found = [shingles(t.as_py() or b"") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("digest")]
                + [pa.array([len(h) for h in found], pa.int64()), pa.array([node_of(h) for h in found], pa.int64())],
                names=["key", "digest", "n", "node"],
            )

    return docs.mapInArrow(run, f"key {docs.schema['key'].dataType.simpleString()}, digest bigint, n bigint, node bigint")


def _gather(blobs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, node) entries of a part, sorted."""
    loaded = [_entries_in(d) for d in blobs["data"]]
    nodes = np.concatenate([a for a, _ in loaded])
    keys = np.concatenate([b for _, b in loaded])
    order = np.lexsort((nodes, keys))
    nodes, keys = nodes[order], keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    return nodes[first], keys[first]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return starts, np.diff(np.append(starts, len(keys)))


def _shared(blobs: pd.DataFrame) -> pd.DataFrame:
    """How many of each node's entries another node has too."""
    nodes, keys = _gather(blobs)
    _, lengths = _runs(keys)
    found, counts = np.unique(nodes[np.repeat(lengths, lengths) > 1], return_counts=True)
    return pd.DataFrame({"node": found, "shared": counts.astype(np.int64)})


def _sets(docs: DataFrame) -> DataFrame:
    """(chunk, nodes, sizes, hashes): the sets of documents (row, text), many to a row; no node twice in a row.

    A chunk has the number of its first row, because a node may be in several chunks.
    """

    def run(source):
        for batch in source:
            found = {}
            for text in batch.column("text"):
                h = shingles(text.as_py() or b"")
                if len(h):
                    found[node_of(h)] = h
            if found:
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": [batch.column("row")[0].as_py()],
                        "nodes": [np.array(list(found), np.int64).tobytes()],
                        "sizes": [np.array([len(h) for h in found.values()], np.int64).tobytes()],
                        "hashes": [np.concatenate(list(found.values())).tobytes()],
                    }
                )

    return docs.mapInArrow(run, "chunk bigint, nodes binary, sizes binary, hashes binary")


def _open(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["hashes"], np.uint64)


def _deal_sets(sets: DataFrame, parts: int) -> DataFrame:
    """(part, chunk, data): all hashes of each chunk in order of part."""

    def run(source):
        for row in single_rows(source):
            _, _, hashes = _open(row)
            keys = np.sort(mixed(hashes))
            bounds = cuts(keys, parts)
            for part in np.flatnonzero(np.diff(bounds)):
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int32()),
                        "chunk": pa.array([row["chunk"]], pa.int64()),
                        "data": [pack(keys[bounds[part] : bounds[part + 1]], 6)],
                    }
                )

    return sets.mapInArrow(run, "part int, chunk bigint, data binary")


def _frequencies(blobs: pd.DataFrame) -> pd.DataFrame:
    """For each chunk of a part, the document frequency of its hashes as 16 steps to a doubling."""
    loaded = [unpack(d, 6) for d in blobs["data"]]
    _, at, counts = np.unique(np.concatenate(loaded), return_inverse=True, return_counts=True)
    steps = np.minimum(255, np.ceil(16 * np.log2(counts))).astype(np.uint8)[at]
    ends = np.cumsum([len(x) for x in loaded])
    return pd.DataFrame(
        {"chunk": blobs["chunk"], "part": blobs["part"], "data": [x.tobytes() for x in np.split(steps, ends[:-1])]}
    )


def _deal_rare(known: DataFrame, parts: int) -> DataFrame:
    """(part, data): the rarest shingles of each set, as many as must hold one that a linked set has.

    Sets in which fewer than the needed overlap is shared at all are left out, and so are shingles
    that no other set has. Order is by frequency, then hash, which is the same for all sets.
    """

    def run(source):
        for batch in source:
            for row in batch.to_pylist():
                nodes, sizes, hashes = _open(row)
                keys = mixed(hashes)
                order = np.argsort(keys)
                replies = sorted(row["replies"], key=lambda r: r["part"])
                rarity = np.empty(len(keys), np.uint8)
                rarity[order] = np.frombuffer(b"".join(r["data"] for r in replies), np.uint8)
                kept, rare = [], []
                ends = np.cumsum(sizes)
                for node, size, end in zip(nodes, sizes, ends):
                    a, need = end - size, needed(int(size))
                    steps = rarity[a:end]
                    alone = int((steps == 0).sum())
                    if size - alone < need:
                        continue
                    first = np.lexsort((keys[a:end], steps))[alone : size - need + 1]
                    if len(first):
                        kept.append(node)
                        rare.append(hashes[a:end][first])
                if kept:
                    yield from _blobs(_entries_out(kept, rare, parts))

    return known.mapInArrow(run, "part int, data binary")


def _stars(blobs: pd.DataFrame) -> pd.DataFrame:
    """Each node of an inverted list with the list's first node."""
    nodes, keys = _gather(blobs)
    starts, lengths = _runs(keys)
    pairs = np.stack([nodes, np.repeat(nodes[starts], lengths)], 1)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.up))])


def linked(overlap, n, m):
    return 100 * overlap >= PERCENT * (n + m - overlap)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def divide_skip(lists: list[np.ndarray], need: int) -> np.ndarray:
    """All ids that occur in at least `need` of the sorted lists, by DivideSkip; with their counts, (id, count).

    The longest lists are set aside, as many as cost less to probe than to merge. The others are
    merged, an id must occur there the more rarely the more lists were set aside, and is then looked
    up in each long list by binary search.
    """
    lists = sorted(lists, key=len)
    longest = len(lists[-1]) if lists else 0
    aside = min(need - 1, int(need / (0.01 * math.log2(longest + 2) + 1)), len(lists)) if need > 1 else 0
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    total = sum(map(len, short))
    if total <= HEAP_ENTRIES:
        merged = np.fromiter(heapq.merge(*[x.tolist() for x in short]), np.int64, total)
    else:
        merged = np.sort(np.concatenate(short), kind="stable")
    starts, counts = _runs(merged)
    enough = counts >= need - aside
    ids, counts = merged[starts[enough]], counts[enough]
    for probe in long:
        at = np.searchsorted(probe, ids)
        at[at == len(probe)] = 0
        counts = counts + (probe[at] == ids)
    kept = counts >= need
    return np.stack([ids[kept], counts[kept]], 1)


def join_sets(sets: list[np.ndarray]) -> np.ndarray:
    """The root (least index) of each set's component under links, exactly.

    Sets first look for a link with the leaders found so far, which settles most of a group of copies
    without looking at its pairs. A link that is still missing has an end outside of the largest
    component, so only those sets then search all inverted lists.
    """
    sizes = np.array([len(s) for s in sets])
    union, leaders = Union(len(sets)), []
    for x, mine in enumerate(sets):
        for other in leaders:
            n, m = sizes[x], sizes[other]
            if min(n, m) * 100 >= PERCENT * max(n, m) and linked(_overlap(mine, sets[other]), n, m):
                union.join(x, other)
                break
        else:
            if len(leaders) < 64:
                leaders.append(x)
    roots = union.roots()
    found, counts = np.unique(roots, return_counts=True)
    if len(found) == 1:
        return roots
    largest = found[np.argmax(counts)]
    of = np.repeat(np.arange(len(sets)), sizes)
    keys = np.concatenate(sets)
    order = np.argsort(keys, kind="stable")
    keys, of = keys[order], of[order]
    starts, lengths = _runs(keys)
    heads = keys[starts]
    for x in np.flatnonzero(roots != largest):
        n = int(sizes[x])
        at = np.searchsorted(heads, sets[x])
        lists = [of[starts[i] : starts[i] + lengths[i]] for i in at if lengths[i] > 1]
        need = needed(n)
        if len(lists) < need:
            continue
        for y, overlap in divide_skip(lists, need):
            if y != x and linked(int(overlap), n, int(sizes[y])):
                union.join(int(x), int(y))
    return union.roots()


def _joined(grouped: DataFrame) -> DataFrame:
    """(node, root) of verified links; rows (cell, node, hashes) come sorted by cell."""

    def solve(cell):
        nodes = np.array([n for n, _ in cell], np.int64)
        order = np.argsort(nodes)
        order = order[np.concatenate([[True], np.diff(nodes[order]) > 0])]
        roots = join_sets([np.frombuffer(cell[i][1], np.uint64) for i in order])
        return nodes[order], nodes[order][roots]

    def run(source):
        name, cell, out_a, out_b = None, [], [], []
        for batch in source:
            for row in batch.to_pylist():
                if row["cell"] != name and cell:
                    a, b = solve(cell)
                    out_a.append(a)
                    out_b.append(b)
                    cell = []
                name = row["cell"]
                cell.append((row["node"], row["hashes"]))
            if out_a:
                yield pa.RecordBatch.from_pydict({"node": np.concatenate(out_a), "root": np.concatenate(out_b)})
                out_a, out_b = [], []
        if cell:
            a, b = solve(cell)
            yield pa.RecordBatch.from_pydict({"node": a, "root": b})

    return grouped.mapInArrow(run, "node bigint, root bigint")


def _spread(sets: DataFrame) -> DataFrame:
    """(node, size, hashes): one row per set."""

    def run(source):
        for batch in source:
            for row in batch.to_pylist():
                nodes, sizes, hashes = _open(row)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": nodes,
                        "size": sizes,
                        "hashes": [hashes[e - s : e].tobytes() for s, e in zip(sizes, ends)],
                    }
                )

    return sets.mapInArrow(run, "node bigint, size bigint, hashes binary")


def link_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id (the least key that links reach) for every row.

    Words are runs of anything but ASCII white space after lower-casing A-Z; a document's set are its
    distinct five-word shingles, or all its words as one if it has fewer. Two documents link when their sets' Jaccard
    similarity is 0.8 or more. Null and empty texts have empty sets, which link with nothing; their
    component is their own key. Documents with equal sets are one node, so copies and repeated rows
    cost nothing beyond their row. Null keys count only where a component has no other. An empty
    table gives an empty result; extra columns are not read. Shingles are compared by 64-bit hashes.

    1. Each set's first shingles in hash order are dealt by hash. Sets of which too few are shared with
       any other set cannot link and are done. This leaves little more than near copies.
    2. The others' shingles are dealt again to get their frequencies, and each set then goes by its rarest
       shingles into inverted lists. Components of these lists hold all links.
    3. Within such a group `join_sets` finds the links by T-occurrence search. Groups beyond
       `GROUP_ENTRIES` are cut into blocks, each pair of which is a task, and the links found are
       joined afterwards.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    docs = docs.select("key", F.xxhash64("text").alias("digest"), "text")
    size = text_bytes(docs)
    parts = parts_for(size * 0.35)
    rows = settle(classes(docs), "classes")
    one = F.struct("key", "digest")
    one = F.coalesce(F.min(F.when(F.col("key").isNotNull(), one)), F.min(one))  # the text of each node that is read again
    shared = _deal(docs.select("text"), parts, True).repartition(parts, "part").groupBy("part").applyInPandas(_shared, "node bigint, shared bigint")
    sets_known = rows.groupBy("node").agg(F.min("key").alias("key"), F.max("n").alias("n"))
    least = F.greatest(F.lit(1), F.floor(F.col("n") * PERCENT / 1000))
    texts_known = rows.groupBy("node").agg(one.alias("one"), F.max("n").alias("n"))
    near = shared.groupBy("node").agg(F.sum("shared").alias("shared")).join(texts_known, "node").where(F.col("shared") >= least)
    near = settle(near.select("node", "one.key", "one.digest", "n"), "near")
    entries = near.agg(F.sum("n")).first()[0] or 0
    nodes = sets_known.select("node", "key", "n")
    if entries:
        labels = _labels(docs, near, entries)
        nodes = nodes.join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        nodes = nodes.withColumn("root", F.coalesce("root", "node"))
    else:
        nodes = nodes.withColumn("root", F.col("node"))
    nodes = settle(nodes.select("node", "key", "root"), "nodes")
    least_key = nodes.groupBy("root").agg(F.min("key").alias("component_id"))
    named = nodes.join(least_key, "root").select(F.col("node").alias("of"), "component_id")
    # Rows of one node may be very many; this join is the only place where they meet, and can be split.
    return rows.join(named.hint("merge"), rows["node"] == named["of"]).select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _labels(docs: DataFrame, near: DataFrame, entries: int) -> DataFrame:
    """(node, root) of verified components among the documents that may link."""
    chosen = near.select(F.col("key").alias("wanted"), F.col("digest").alias("wanted_digest"))
    # By sort and merge at every size: the other side grows with the documents, so it is never sent to all tasks.
    # A repeated key's other texts stay behind, and repeats of a row are one text before they are made sets.
    same = docs["key"].eqNullSafe(chosen["wanted"]) & (docs["digest"] == chosen["wanted_digest"])
    survivors = docs.join(chosen.hint("merge"), same, "left_semi").select("text").distinct()
    sets = settle(_sets(survivors.withColumn("row", F.monotonically_increasing_id())), "sets")
    parts = parts_for(entries * 8)
    dealt = _deal_sets(sets, parts).repartition(parts, "part").groupBy("part").applyInPandas(_frequencies, "chunk bigint, part int, data binary")
    replies = dealt.groupBy("chunk").agg(F.collect_list(F.struct("part", "data")).alias("replies"))
    rare = _deal_rare(sets.join(replies, "chunk"), parts)
    stars = settle(rare.repartition(parts, "part").groupBy("part").applyInPandas(_stars, "a bigint, b bigint"), "stars")
    groups = connected(stars)
    members = groups.join(near.select("node", "n"), "node")
    sizes = settle(members.groupBy("root").agg(F.sum("n").alias("total")), "group-sizes")
    blocks = F.ceil(F.col("total") / GROUP_ENTRIES).cast("int")
    placed = members.join(sizes.select("root", blocks.alias("blocks")), "root").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # A task per pair of blocks; a group of one block is one cell.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("root", "node", "block", "blocks", other).where("blocks = 1 or block <> other")
    cells = pairs.select(
        F.concat_ws("-", "root", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), "node"
    )
    cells = _spread(sets).join(settle(cells, "cells").hint("merge"), "node").select("cell", "node", "hashes")
    found = _joined(cells.repartition(parts, "cell").sortWithinPartitions("cell"))
    if sizes.where(F.col("total") > GROUP_ENTRIES).limit(1).count():
        return settle(connected(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "labels")
    return settle(found, "labels")
