"""Vectorised polynomial hashes modulo 2^64 (Rabin-Karp) over bytes and words.

With prefix sums S of ``value * B^position`` the hash of any span is
``(S[end] - S[start]) * B^-start``: one multiplication per span, whatever its
length.  B is odd, hence invertible.
"""

from __future__ import annotations

import numpy as np

_B = 0x9E3779B97F4A7C15 | 3
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# whitespace of the word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of the 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i for i < n, kept per worker."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_B, pow(_B, -1, 1 << 64))):
            f = np.full(max(n, 1 << 16), base, np.uint64)
            f[0] = 1
            _powers[k] = np.cumprod(f, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums S of ``values * B^position``, with a leading 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def spans(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of the sequence with prefix sums ``s``."""
    return (s[end] - s[start]) * powers(len(s))[1][start]


def windows(s: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all spans of ``width`` items, by start."""
    n = len(s) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return (s[width:] - s[:n]) * powers(len(s))[1][:n]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a word never crosses a document bound."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ws = SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first = ~ws
    last = first.copy()
    first[1:] &= ws[:-1] | cut[1:-1]
    last[:-1] &= ws[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(word hash, word start, word end, first word of each document + end) of some documents."""
    start, end = word_bounds(data, offsets)
    h = mix(spans(prefix(BYTE[data]), start, end) + (end - start).astype(np.uint64))
    return h, start, end, np.searchsorted(start, offsets)
