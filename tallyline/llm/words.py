"""Words of a text as arrays: A-Z lowered, separators are the ASCII characters that are no letter or digit.

A word is a run of bytes `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` of the lowered UTF-8 text; bytes of non-ASCII characters lie above
0x7F, so working on bytes equals working on characters. Words are represented by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLOCK = 1 << 20
_BASE = U64(0x9E3779B97F4A7C15)

_LOW = np.zeros(256, np.uint8)
_LOW[128:] = np.arange(128, 256)
_LOW[48:58] = np.arange(48, 58)
_LOW[97:123] = _LOW[65:91] = np.arange(97, 123)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, made as long as asked for."""

    def __init__(self, base: U64) -> None:
        self.base, self.inverse = base, U64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, U64), np.full(size, b, U64)))) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_POWERS = Powers(_BASE)


def lowered(data: bytes) -> np.ndarray:
    """Bytes of the text with A-Z lowered and every separator as 0."""
    return _LOW[np.frombuffer(data, np.uint8)]


def _hashed(low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(low) + 2, bool)
    np.not_equal(low, 0, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS.upto(len(low) + 1)
    total = np.zeros(len(low) + 1, U64)
    np.cumsum(low * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), starts, ends


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word. Long texts go through in blocks cut at separators."""
    low = lowered(data)
    if len(low) <= _BLOCK:
        return _hashed(low)
    parts, at = [], 0
    while at < len(low):
        end = min(at + _BLOCK, len(low))
        while end < len(low) and low[end]:
            gap = np.flatnonzero(low[end : end + _BLOCK] == 0)
            end = end + int(gap[0]) if len(gap) else min(end + _BLOCK, len(low))
        h, s, e = _hashed(low[at:end])
        parts.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of `size` words; a shorter text, unless it has no words, is one shingle."""
    n = len(words)
    if not n:
        return np.zeros(0, U64)
    size = min(size, n)
    total = np.full(n - size + 1, U64(size))
    for k in range(size):
        total = (total * U64(0xD6E8FEB86659FD93)) ^ words[k : n - size + 1 + k]
        total ^= total >> U64(32)
    return mix(total)


def counted_shingles(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, ascending, and how often each stands in the text."""
    return np.unique(shingle_hashes(word_hashes(data)[0], size), return_counts=True)
