"""Hashes of all k-byte strings of a buffer, and content-chosen sample positions."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: A random number per byte value.
_TABLE = np.random.default_rng(20240101).integers(0, 1 << 64, 256, dtype=np.uint64)


def _powers(base: np.uint64, size: int) -> np.ndarray:
    found = np.full(size, base, dtype=np.uint64)
    found[0] = 1
    return np.cumprod(found, dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash, in place."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(33)
    return values


class GramHashes:
    """64-bit hashes of substrings of one buffer, by prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        terms = _TABLE[data]
        terms *= _powers(_BASE, max(1, self.size))[: self.size]
        self.sums = np.zeros(self.size + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.back = _powers(_INVERSE, self.size + 1)

    def all(self, length: int) -> np.ndarray:
        """The hash of every substring of this length."""
        if self.size < length:
            return np.zeros(0, dtype=np.uint64)
        found = self.sums[length:] - self.sums[: self.size - length + 1]
        found *= self.back[: len(found)]
        return _mixed(found)

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        """The hashes of the substrings of this length at these places."""
        found = self.sums[starts + length] - self.sums[starts]
        found *= self.back[starts]
        return _mixed(found)


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the place of its first smallest value."""
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.int32)
    least, place = values, np.arange(len(values), dtype=np.int32)
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        keep = len(least) - step
        later = least[step:] < least[:keep]
        place = np.where(later, place[step:], place[:keep])
        least = np.where(later, least[step:], least[:keep])
        covered += step
    return place
