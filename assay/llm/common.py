"""Helpers that several operators share: normal columns, sizes, and packed arrays dealt by Spark."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BYTES = 8 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else.

    `lower` is fast but changes other letters too, so it is used only where no character outside
    ASCII has a lower-case form; any other text goes through `translate`.
    """
    others = r"[^\x00-\x7F&&[\p{Lu}\p{Lt}\p{Nl}\p{So}]]"
    plain = (F.octet_length(text) == F.char_length(text)) | ~text.rlike(others)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def text_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the text with null as empty; all other columns, clashing names included, go."""
    return df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def text_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts_for(n_bytes: float, least: int = 12, each: int = PART_BYTES) -> int:
    """How many parts keep the data of one part near `each` bytes."""
    return max(least, math.ceil(n_bytes / each))


def deal(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 64-bit hash, by its top 32 bits, so that sorted hashes have sorted parts."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def cuts(sorted_hashes: np.ndarray, parts: int) -> np.ndarray:
    """The bounds of each part within sorted hashes."""
    return np.searchsorted(deal(sorted_hashes, parts), np.arange(parts + 1, dtype=np.uint64))


def pack(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers in `width` bytes each, byte planes one after another (they compress better)."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def single_rows(source: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time, so that no more than one large row is held as Python objects."""
    for batch in source:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the given ranges, one range after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
