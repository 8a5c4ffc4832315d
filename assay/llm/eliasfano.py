"""Monotone sequences in Elias-Fano form, and arrays kept in a mapped file."""

from __future__ import annotations

import tempfile

import numpy as np


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each value, one after another, as bytes."""
    out = []
    for at in range(0, len(values), 1 << 16):  # a multiple of eight values fills whole bytes
        block = values[at : at + (1 << 16), None]
        out.append(np.packbits(((block >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
    return np.concatenate([*out, np.zeros(8, np.uint8)])


def read_bits(packed: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    first = at.astype(np.int64) * width
    byte, out = first >> 3, np.zeros(len(at), np.uint64)
    for k in range((width + 14) // 8):
        out |= packed[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return (out >> (first & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


class EliasFano:
    """A sorted sequence: low bits as they are, high bits as a unary code of their steps."""

    def __init__(self, values: np.ndarray, universe: int):
        self.n = len(values)
        self.width = min(48, max(0, (universe // max(1, self.n)).bit_length() - 1))
        shift = np.uint64(self.width)
        high = (values >> shift).astype(np.int64)
        bits = np.zeros(self.n + (universe >> self.width) + 2, np.uint8)
        bits[high + np.arange(self.n)] = 1
        self.high = np.packbits(bits)
        self.bits = len(bits)
        self.low = pack_bits(values, self.width) if self.width else np.zeros(8, np.uint8)

    def arrays(self) -> list[np.ndarray]:
        return [self.high, self.low]

    def adopt(self, high: np.ndarray, low: np.ndarray) -> None:
        self.high, self.low = high, low

    def open(self) -> None:
        """Find where the code's steps end, which bounds every search."""
        bits = np.unpackbits(np.asarray(self.high), count=self.bits)
        self.ends = np.flatnonzero(bits == 0)

    def lows(self, at: np.ndarray) -> np.ndarray:
        return read_bits(self.low, self.width, at) if self.width else np.zeros(len(at), np.uint64)

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each wanted value the index of the first that is not smaller, and whether it is equal."""
        shift = np.uint64(self.width)
        high = (wanted >> shift).astype(np.int64)
        inside = high < len(self.ends)
        high = np.where(inside, high, 0)
        low = wanted & np.uint64((1 << self.width) - 1)
        first = np.where(high > 0, self.ends[high - 1] - (high - 1), 0)
        last = self.ends[high] - high
        stop = last.copy()
        active = np.flatnonzero(inside & (first < last))
        while len(active):
            middle = (first[active] + last[active]) >> 1
            below = self.lows(middle) < low[active]
            first[active[below]] = middle[below] + 1
            last[active[~below]] = middle[~below]
            active = active[first[active] < last[active]]
        equal = inside & (first < stop)
        at = np.flatnonzero(equal)
        equal[at] = self.lows(first[at]) == low[at]
        return np.where(inside, first, self.n), equal


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The same arrays, in a file that has no name any more and goes with its last reader."""
    out = []
    with tempfile.TemporaryFile() as file:
        starts = []
        for a in arrays:
            starts.append(file.tell())
            file.write(a.tobytes())
            file.write(b"\0" * (-file.tell() % 64 or 64))
        file.flush()
        for a, start in zip(arrays, starts):
            out.append(np.memmap(file, a.dtype, "r", start, a.shape) if a.size else a)
    return out
