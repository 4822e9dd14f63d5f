"""Elias-Fano sequences over numpy arrays, readable from mapped memory."""

from __future__ import annotations

import numpy as np

from pricelab.llm.frames import ship

ship(__name__)

class EliasFano:
    """A non-decreasing sequence of unsigned integers below 2**63.

    The low bits of each value are stored in 0, 1, 2, 4 or 8 bytes; the high parts
    are written in unary: value i sets bit ``high(i) + i``. ``access`` reads
    values by place and ``rank_of`` finds, for many keys at once, the first place
    between two others whose value is not below the key.
    """

    def __init__(self, low: np.ndarray, upper: np.ndarray, size: int, low_bytes: int):
        self.low, self.upper, self.size, self.low_bytes = low, upper, size, low_bytes
        self._places = None

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low_bytes = next(b for b in (0, 1, 2, 4, 8) if 8 * b >= bits)
        shift = np.uint64(min(63, 8 * low_bytes))
        kind = {0: np.uint8, 1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[low_bytes]
        low = (values & ((np.uint64(1) << shift) - np.uint64(1))).astype(kind) if low_bytes else np.zeros(0, kind)
        place = (values >> shift).astype(np.int64) + np.arange(n)
        length = int(place[-1]) + 2 if n else 1
        marks = np.zeros(length, np.uint8)
        marks[place] = 1
        return cls(low, np.packbits(marks, bitorder="little"), n, low_bytes)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "upper": self.upper}

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) set or unset bit; the places are expanded at the first use of a batch."""
        if self._places is None:
            bits = np.unpackbits(self.upper, bitorder="little")
            self._places = (np.flatnonzero(bits == 0), np.flatnonzero(bits))
        return self._places[ones][k]

    def _low(self, i: np.ndarray) -> np.ndarray:
        return self.low[i].astype(np.uint64) if self.low_bytes else np.zeros(len(i), np.uint64)

    def access(self, i: np.ndarray) -> np.ndarray:
        high = self._select(i, True) - i
        return (high.astype(np.uint64) << np.uint64(min(63, 8 * self.low_bytes))) | self._low(i)

    def rank_of(self, keys: np.ndarray, first: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """First place in [first, end) with a value >= key, else ``end``."""
        keys = np.asarray(keys, np.uint64)
        shift = np.uint64(min(63, 8 * self.low_bytes))
        high = (keys >> shift).astype(np.int64)
        zeros = len(self.upper) * 8 - self.size
        # Values of one high part lie between two neighbouring unset bits.
        inside = high < zeros
        h = np.where(inside, high, 0)
        lo = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - h + 1, 0)
        hi = self._select(h, False) - h
        lo, hi = np.where(inside, lo, self.size), np.where(inside, hi, self.size)
        if first is not None:
            lo, hi = np.clip(lo, first, end), np.clip(hi, first, end)
        want = keys & ((np.uint64(1) << shift) - np.uint64(1)) if self.low_bytes else np.zeros(len(keys), np.uint64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            less = self._low(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
