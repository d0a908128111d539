"""NumPy passes over the UTF-8 bytes of many texts at once: word bounds, word hashes and window hashes.

A word is a run of digits, ASCII letters (lower-cased) and bytes of 0x80 and above, which is the pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on the
lower-cased text. Hashes are polynomials modulo 2**64, computed from prefix sums, then mixed; equal words have equal hashes everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_PIECE = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_Q = np.uint64(0xD6E8FEB86659FD93 | 1)
_Q_INV = np.uint64(pow(int(_Q), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept per worker, grown by doubling."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1024 if have is None else 2 * len(have))
        made = np.full(size, base, dtype=np.uint64)
        made[0] = 1
        have = _powers[int(base)] = np.cumprod(made, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins and ends (n + 1 offsets); nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    o = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of True bytes; no run crosses an offset."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begins[cut] |= inside[cut]
    stops[cut - 1] |= inside[cut - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


class Words:
    """Words of the texts of one Arrow slice: ``start``, ``end`` in bytes of ``low`` (lower-cased), and ``first`` (n + 1): where each text's words begin."""

    def __init__(self, texts: pa.Array):
        self.raw, self.offsets = buffer_of(texts)
        self.low = LOWER[self.raw]
        self.start, self.end = runs(IS_WORD[self.low], self.offsets)
        self.first = np.searchsorted(self.start, self.offsets)
        self.first[-1] = len(self.start)
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return word_hashes(self.low, self.start, self.end)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def word(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        a = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, a + _PIECE, side="right")))
        b = int(end[j - 1])
        sums = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum((low[a:b].astype(np.uint64) + np.uint64(1)) * powers(_P, b - a), out=sums[1:])
        s = start[i:j] - a
        out[i:j] = (sums[end[i:j] - a] - sums[s]) * powers(_P_INV, b - a)[s]
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of words[i : i + width] for every i at which the window fits."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for a in range(0, n, _PIECE):
        b = min(n, a + _PIECE)
        part = words[a : b + width - 1]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * powers(_Q, len(part)), out=sums[1:])
        k = b - a
        out[a:b] = (sums[width : width + k] - sums[:k]) * powers(_Q_INV, len(part))[:k]
    return mix(out + np.uint64(width))


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each text's words or bytes; 0 for a text without any. No array as long as ``values`` is made."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    out = np.zeros(len(first) - 1, dtype=kind)
    some = np.flatnonzero(first[1:] > first[:-1])
    if len(some):
        out[some] = np.add.reduceat(values, first[:-1][some], dtype=kind)
    return out
