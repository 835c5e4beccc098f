"""Elias-Fano code of a non-decreasing sequence, with select.

A value's low bits are packed side by side; its high bits are written in unary into one bit string, where the
k-th one stands at position high + k.  Every 64th one's position is sampled as a 32-bit number, so select reads
one sample and a few bytes.  For n values up to u this takes about 2 + log2(u / n) bits per value.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 64
_HEAD = struct.Struct("<IQB")  # number of values, largest value, low bits
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    def __init__(self, count: int, largest: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.largest, self.low_bits = count, largest, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        """Code of non-negative, non-decreasing integers (possibly none)."""
        values = np.asarray(values, np.int64)
        if len(values) and (values[0] < 0 or (np.diff(values) < 0).any()):
            raise ValueError("values must be non-negative and non-decreasing")
        count, largest = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (largest // count).bit_length() - 1) if count else 0
        ones = (values >> low_bits) + np.arange(count)
        bits = np.zeros((largest >> low_bits) + count + 1, np.uint8)
        bits[ones] = 1
        low = ((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8)
        return cls(
            count, largest, low_bits, np.packbits(low.ravel(), bitorder="little"),
            np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"),
        )

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return _HEAD.pack(self.count, self.largest, self.low_bits) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        count, largest, low_bits = _HEAD.unpack_from(data)
        rest = np.frombuffer(data, np.uint8, offset=_HEAD.size)
        a = (count * low_bits + 7) // 8
        b = a + ((largest >> low_bits) + count + 1 + 7) // 8
        samples = np.frombuffer(rest[b:].tobytes(), "<u4")
        return cls(count, largest, low_bits, rest[:a], rest[a:b], samples)

    def select(self, k: int) -> int:
        """The k-th value, from one sample and the bytes after it."""
        if not 0 <= k < self.count:
            raise IndexError(k)
        at = int(self.samples[k // SAMPLE])
        left = k % SAMPLE
        byte = at // 8
        here = int(self.high[byte]) >> (at % 8) << (at % 8)  # from the sampled one on
        while (ones := int(_ONES[here])) <= left:
            left -= ones
            byte += 1
            here = int(self.high[byte])
        for _ in range(left):
            here &= here - 1
        at = byte * 8 + (here & -here).bit_length() - 1
        low = 0
        for j in range(self.low_bits):
            p = k * self.low_bits + j
            low |= (int(self.low[p // 8]) >> (p % 8) & 1) << j
        return (at - k) << self.low_bits | low

    def all(self) -> np.ndarray:
        """Every value, in one vectorised pass."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        high = (ones - np.arange(self.count)) << self.low_bits
        bits = np.unpackbits(self.low, bitorder="little")[: self.count * self.low_bits]
        weights = np.int64(1) << np.arange(self.low_bits)
        return high + bits.reshape(self.count, self.low_bits).astype(np.int64) @ weights
