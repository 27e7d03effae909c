"""Elias-Fano coding of a non-decreasing list of numbers, with select."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: One position of the upper bits is stored per so many numbers.
SAMPLE = 64


@dataclass(frozen=True)
class EliasFano:
    """``size`` numbers: ``low_bits`` lower bits each, the rest as a unary bit array."""

    size: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes  # unsigned 32-bit positions in the upper bits, one per SAMPLE numbers

    @classmethod
    def encode(cls, numbers: np.ndarray) -> EliasFano:
        numbers = np.asarray(numbers, dtype=np.uint64)
        size = len(numbers)
        if not size:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, int(int(numbers[-1]) // size).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((numbers[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        ones = (numbers >> np.uint64(low_bits)).astype(np.int64) + np.arange(size)
        high = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        high[ones] = 1
        return cls(
            size,
            low_bits,
            np.packbits(low.ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            ones[::SAMPLE].astype("<u4").tobytes(),
        )

    def select(self, index: int) -> int:
        """The number at ``index``: from the sample before it, a few words of upper bits."""
        if not 0 <= index < self.size:
            raise IndexError(index)
        start = int(np.frombuffer(self.samples, "<u4")[index // SAMPLE])
        left, width = index % SAMPLE, 64
        at = start // 8
        while True:
            bits = np.unpackbits(
                np.frombuffer(self.high[at : at + width], np.uint8), bitorder="little"
            )
            bits[: start - at * 8] = 0
            ones = np.flatnonzero(bits)
            if len(ones) > left:
                break
            width *= 4
        upper = at * 8 + int(ones[left]) - index
        return (upper << self.low_bits) | self._lower(index, index + 1)[0]

    def _lower(self, start: int, end: int) -> list[int]:
        if not self.low_bits:
            return [0] * (end - start)
        first, last = start * self.low_bits, end * self.low_bits
        bits = np.unpackbits(
            np.frombuffer(self.low[first // 8 : (last + 7) // 8], np.uint8), bitorder="little"
        )[first % 8 :][: last - first]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(-1, self.low_bits).astype(np.uint64) @ weights).tolist()

    def decode(self) -> np.ndarray:
        """All numbers."""
        if not self.size:
            return np.zeros(0, dtype=np.int64)
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        upper = np.flatnonzero(bits)[: self.size] - np.arange(self.size)
        return (upper << self.low_bits) + np.asarray(self._lower(0, self.size), dtype=np.int64)
