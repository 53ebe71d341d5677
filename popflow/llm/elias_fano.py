"""Elias-Fano sequences in flat buffers, queried in bulk."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 16
_PAGE = 512  # high bits per entry of the rank directory


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary.

    The buffers can be views of a memory-mapped file. Queries come sorted and in bulk: one pass
    over the sequence decodes a chunk at a time and answers what falls into it, so no more than a
    chunk is ever held decoded.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits = n, low_bits
        # Eight bytes from any byte on; a number of up to 56 bits lies inside them.
        self.windows = np.ndarray((max(len(low) - 7, 0),), np.uint64, np.ascontiguousarray(low),
                                  strides=(1,))
        self.high = high
        ones = np.bitwise_count(high).reshape(-1, _PAGE // 8).sum(axis=1, dtype=np.int64)
        self.ranks = np.r_[0, np.cumsum(ones)]

    @staticmethod
    def encode(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(n, low bits, packed low bits, high bits), the arguments of the constructor."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        upper = (values >> np.uint64(low_bits)).astype(np.int64)
        bits = np.zeros(-(-(int(upper[-1]) + n if n else 1) // _PAGE) * _PAGE, np.uint8)
        bits[upper + np.arange(n)] = 1
        parts = []
        for a in range(0, n if low_bits else 0, CHUNK):  # a multiple of 8 numbers: whole bytes
            part = values[a:a + CHUNK, None] >> np.arange(low_bits, dtype=np.uint64)
            parts.append(np.packbits((part & np.uint64(1)).astype(np.uint8), bitorder="little"))
        low = np.concatenate([*parts, np.zeros(8, np.uint8)])
        return n, low_bits, low, np.packbits(bits, bitorder="little")

    def slice(self, a: int, b: int) -> np.ndarray:
        """Values at positions a to b - 1."""
        if a >= b:
            return np.empty(0, np.uint64)
        first, last = np.searchsorted(self.ranks, [a, b - 1], "right") - 1
        bits = np.unpackbits(self.high[first * _PAGE // 8:(last + 1) * _PAGE // 8],
                             bitorder="little")
        skip = a - int(self.ranks[first])
        place = np.flatnonzero(bits)[skip:skip + b - a] + first * _PAGE
        at = np.arange(a, b)
        out = (place - at).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bit = at * self.low_bits
            low = self.windows[bit >> 3] >> (bit & 7).astype(np.uint64)
            out |= low & np.uint64((1 << self.low_bits) - 1)
        return out

    def chunks(self) -> Iterator[tuple[int, np.ndarray]]:
        for a in range(0, self.n, CHUNK):
            yield a, self.slice(a, min(self.n, a + CHUNK))

    def take(self, at: np.ndarray) -> np.ndarray:
        """Values at sorted positions."""
        out = np.empty(len(at), np.uint64)
        for a, values in self.chunks():
            i, j = np.searchsorted(at, [a, a + len(values)])
            out[i:j] = values[at[i:j] - a]
        return out

    def successors(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted numbers: the first position with a value at least as large, and whether it
        is equal. The position is n if there is none."""
        at, equal, i = np.full(len(wanted), self.n), np.zeros(len(wanted), bool), 0
        for a, values in self.chunks():
            j = int(np.searchsorted(wanted, values[-1], "right"))
            if j > i:
                local = np.searchsorted(values, wanted[i:j])
                at[i:j], equal[i:j] = a + local, values[local] == wanted[i:j]
                i = j
        return at, equal
