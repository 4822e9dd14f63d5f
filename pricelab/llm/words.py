"""Words and shingles of whole Arrow columns at once, in numpy.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``; no UTF-8 sequence holds
such a byte inside, so bytes and code points split alike. Words and shingles are
told apart by 64-bit hashes: each byte has a random 64-bit code, a word sums the
codes of its bytes times the powers of an odd number, and the result is mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pricelab.llm.frames import ship

ship(__name__)

BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(max(n, 1), base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """``doc``, ``start``, ``end`` (byte offsets into ``raw``) and ``hash`` of each word, in text order.

    ``bounds`` has the first word of each text and one entry more.
    """

    raw: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[raw]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column (nulls empty) and the offsets of its values."""
    column = pa.array([] if len(column) == 0 else column.cast(pa.large_binary()).fill_null(b""), pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def letters_in(raw: np.ndarray) -> np.ndarray:
    """Lower-case ASCII letters and every byte of other characters."""
    return ((raw >= 97) & (raw <= 122)) | (raw >= 128)


def span_hashes(raw: np.ndarray):
    """A function of starts and ends that hashes the bytes of each span."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_codes()[raw] * powers(n, BASE), out=sums[1:])
    back = powers(n + 1, pow(BASE, -1, 1 << 64))

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    return hashes


def words_of(column: pa.Array, lower: bool = True, letters: bool = False) -> Words:
    """Runs of anything but blanks, or of letters only."""
    raw, offsets = text_bytes(column)
    if lower:
        raw = lower_bytes(raw)
    n = len(raw)
    inside = letters_in(raw) if letters else ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    bounds = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(raw, doc, starts, ends, span_hashes(raw)(starts, ends), bounds)


def fold(hashes: list[np.ndarray], seed: int) -> np.ndarray:
    out = np.full(len(hashes[0]), mix(np.array([seed], np.uint64))[0], np.uint64)
    for h in hashes:
        out = mix(out * np.uint64(BASE) + h)
    return out


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``k``-word shingles; of fewer words the whole sequence is one."""
    h, n = words.hash, len(words.hash)
    grams = fold([h[i:n - k + 1 + i] for i in range(k)], k) if n >= k else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            out.append(fold([h[i:i + 1] for i in range(a, b)], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
