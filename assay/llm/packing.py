"""Packing documents into sequences of fixed length: best-fit decreasing with certified bin counts."""

from __future__ import annotations

import base64
import json
import re
import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from assay.operators.ordering import positions
from assay.session import settle

PART_ROWS = 200_000
CACHE_ENTRIES = 300_000


def added_tokens(vocabulary_path: str) -> dict[str, int]:
    """The tokens of a vocabulary file that are found in a text before it is cut into words.

    Only those that are matched as they stand, without regard to what is around them, are known here.
    """
    with open(vocabulary_path) as source:
        listed = json.load(source)["added_tokens"]
    odd = [t["content"] for t in listed if any(t[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized"))]
    if odd:
        raise ValueError(f"added tokens with conditions: {odd}")
    return {t["content"]: t["id"] for t in listed}


class ChunkEncoder(dict):
    """Token ids, as little-endian 32-bit bytes, of texts cut at added tokens and at single spaces.

    `added` gives the ids of texts that are one token wherever they occur, the longest first. A byte-level BPE attaches one space to the word after it, so between two characters that are not
    white space a text can be cut before a space without changing its ids. A chunk for which that does
    not hold maps to None.
    """

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int] | None = None):
        super().__init__()
        import tiktoken

        self.added = {token: np.array([i], "<u4").tobytes() for token, i in (added or {}).items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.whole = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("documents", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes | None:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        odd = not chunk or chunk[0].isspace() or chunk[-1].isspace()
        self[chunk] = found = None if odd else self.ids(" " + chunk)
        return found

    def encode(self, text: str) -> bytes:
        if self.whole is None:
            return self.words(text)
        parts = self.whole.split(text)
        if len(parts) == 1:
            return self.words(text)
        return b"".join(self.added[part] if n % 2 else self.words(part) for n, part in enumerate(parts))

    def words(self, text: str) -> bytes:
        """The ids of a text without added tokens."""
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace():
            return self.ids(text)
        try:
            return self.ids(first) + b"".join(map(self.__getitem__, rest))
        except TypeError:  # a chunk that cannot stand alone
            return self.ids(text)


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def pieces(
    df: DataFrame, ranks_path: str, pattern: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text", added: dict[str, int] | None = None
) -> DataFrame:
    """(row, key, piece, start, length, ids_crc32): the documents' ids with the end id, cut where needed.

    Only documents of more than `capacity` ids are cut, into full pieces; the first may be shorter.
    """
    docs = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    kind = docs.schema["key"].dataType
    schema = pa.schema(
        [("row", pa.int64()), ("key", to_arrow_type(kind)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(source):
        name = (ranks_path, pattern, tuple(sorted((added or {}).items())))
        encoder = _ENCODERS.get(name)
        if encoder is None:
            encoder = _ENCODERS[name] = ChunkEncoder(ranks_path, pattern, added)
        for batch in source:
            out = {"piece": [], "start": [], "length": [], "ids_crc32": []}
            of = []
            for n, value in enumerate(batch.column("text")):
                ids = encoder.encode(value.as_py()) + end
                total = len(ids) // 4
                start, stop = 0, total % capacity or min(total, capacity)
                while start < total:
                    of.append(n)
                    out["piece"].append(-(-start // capacity))
                    out["start"].append(start)
                    out["length"].append(stop - start)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * stop]))
                    start, stop = stop, stop + capacity
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(of), batch.column("key").take(of).cast(schema.field("key").type)]
                + [pa.array(out[f.name], f.type) for f in list(schema)[2:]],
                schema=schema,
            )

    return docs.mapInArrow(
        run, f"row bigint, key {kind.simpleString()}, piece int, start bigint, length int, ids_crc32 bigint"
    )


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins.

    Best fit puts a piece into the fullest bin that takes it. Pieces of one length are placed together:
    the fullest bin goes on being the best one until it cannot take another.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[np.ndarray]] = [[] for _ in range(capacity + 1)]  # bins by free space
    opened = 0
    sizes, firsts = np.unique(-lengths[order], return_index=True)
    for size, first, last in zip(-sizes, firsts, [*firsts[1:], len(order)]):
        size = int(size)
        while first < last:
            free = next((r for r in range(size, capacity) if room[r]), capacity)
            each = free // size
            wanted = -(-int(last - first) // each)
            if free == capacity:
                chosen = np.arange(opened, opened + wanted)
                opened += wanted
            else:
                chosen = room[free].pop()
                if len(chosen) > wanted:
                    room[free].append(chosen[wanted:])
                    chosen = chosen[:wanted]
            n = min(int(last - first), each * len(chosen))
            at = order[first : first + n]
            place = np.arange(n)
            bins[at] = chosen[place // each]
            offsets[at] = capacity - free + place % each * size
            full, over = divmod(n, each)
            if full and free - each * size:
                room[free - each * size].append(chosen[:full])
            if over and free - over * size:
                room[free - over * size].append(chosen[full : full + 1])
            first += n
    return bins, offsets, opened


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the best of several dual feasible functions, in whole numbers."""
    sizes, counts = np.unique(lengths.astype(np.int64), return_counts=True)
    if not len(sizes):
        return 0
    best = -(-int((sizes * counts).sum()) // capacity)
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)  # k * capacity times the function
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    for least in sizes[sizes * 2 <= capacity]:
        value = np.where(sizes > capacity - least, capacity, np.where(sizes < least, 0, sizes))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    return best


def _packed(rows: DataFrame, capacity: int, level: int, part_rows: int) -> tuple[DataFrame, int]:
    """Each part of `rows` packed on its own, and the number of parts; adds sequence_id, offset and `open`.

    All pieces of a part with a gap between its bins and the lower bound are open; of a certified part those
    in its emptiest bin, if there is space.
    """
    count = rows.count()
    parts = -(-count // part_rows) or 1

    def run(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy()
        bins, offsets, opened = best_fit_decreasing(lengths, capacity)
        used = np.bincount(bins, weights=lengths, minlength=opened).astype(np.int64)
        part = int(group["part"].iloc[0])
        emptiest = int(np.argmin(used))
        gap = opened > lower_bound(lengths, capacity)
        return group.drop(columns="part").assign(
            sequence_id=(level << 56) + (part << 32) + bins,
            offset=offsets,
            open=gap | ((bins == emptiest) & (used[emptiest] < capacity)),
        )

    kind = rows.schema["key"].dataType.simpleString()
    # Like cards in order of length, so that all parts have the same mix and none lacks small pieces.
    dealt = positions(rows, [], ["length", "row", "piece"]).withColumn("part", (F.col("at") % parts).cast("int")).drop("at")
    packed = dealt.repartition(parts, "part").groupBy("part").applyInPandas(
        run,
        f"row bigint, key {kind}, piece int, start bigint, length int, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint, open boolean",
    )
    return settle(packed, "packed"), parts


def pack(rows: DataFrame, capacity: int, part_rows: int = PART_ROWS) -> DataFrame:
    """`pieces` with sequence_id and offset: as few sequences of at most `capacity` as can be found.

    A full piece is a sequence. The others are dealt by length into parts that one task packs by best-fit
    decreasing, and a lower bound from dual feasible functions certifies the part's number of bins. The bins
    of certified parts are done, but for the emptiest, in which the cutting into parts leaves space. Parts
    with a gap give all their pieces back. What is open is dealt anew, so that parts exchange documents, and
    packed again, until no part is left to exchange with or a round saves no bin; then the round before it
    stands.
    """
    columns = rows.columns
    alone = (-1 - F.monotonically_increasing_id()).alias("sequence_id")
    full = rows.where(F.col("length") == capacity).select(*columns, alone, F.lit(0).cast("long").alias("offset"), F.lit(False).alias("open"))
    rows = rows.where(F.col("length") < capacity)
    bins = lambda df: df.agg(F.count_distinct("sequence_id")).first()[0]
    packed, parts = _packed(rows, capacity, 0, part_rows)
    done: list[DataFrame] = []
    while parts > 1:
        opened = packed.where("open")
        before = bins(opened)
        again, parts = _packed(opened.select(*columns), capacity, len(done) + 1, part_rows)
        if bins(again) >= before:
            break
        done.append(packed.where("not open"))
        packed = again
    return reduce(DataFrame.unionByName, [full, *done, packed])


def pack_documents(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    end_id: int = 2,
    capacity: int = 1024,
    key: str = "doc_id",
    text: str = "text",
    added: dict[str, int] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    `added` gives the ids of texts that are one token wherever they stand (`added_tokens`). A null or
    empty text is its end id alone. Repeated rows are packed once each; null keys are kept.
    An empty table gives an empty result. Extra columns are not read. Texts are read once; the packing
    moves lengths only.
    """
    rows = settle(pieces(df, ranks_path, pattern, end_id, capacity, key, text, added), "pieces")
    return pack(rows, capacity, part_rows).select(
        F.col("key").alias(key), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
