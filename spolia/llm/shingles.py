"""Hashes of word shingles, computed for many texts at once."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; one-to-one."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[0x41:0x5B] = _BYTE[0x61:0x7B]
_PLACES = mix(np.arange(1 << 10, (1 << 10) + 64, dtype=_U)) | _U(1)
_powers = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 20), base, _U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=_U)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(flat: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of texts that lie one after the other, and how many words stand before each text."""
    n = len(flat)
    space = _SPACE[flat]
    start = ~space
    start[1:] &= space[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[firsts] = ~space[firsts]
    end = ~space
    end[:-1] &= space[1:]
    lasts = firsts_to_lasts(offsets)
    end[lasts] = ~space[lasts]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = powers(n + 1)
    sums = np.empty(n + 1, _U)
    sums[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[flat] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    return hashes, np.searchsorted(starts, offsets)


def firsts_to_lasts(offsets: np.ndarray) -> np.ndarray:
    """Last byte of each text that is not empty."""
    return offsets[1:][offsets[1:] > offsets[:-1]] - 1


def shingle_hashes(flat: np.ndarray, offsets: np.ndarray, size: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash per shingle of `size` words, and how many shingles stand before each text.

    A text of fewer words has its whole sequence as its only shingle; one without words has none.
    """
    words, bounds = word_hashes(flat, offsets, lower)
    counts = np.diff(bounds)
    total = np.zeros(len(words), _U)
    m = len(words) - size + 1
    if m > 0:
        for k in range(size):
            total[:m] += words[k : k + m] * _PLACES[k]
        total[:m] = mix(total[:m])
    keep = np.ones(len(words), bool)
    full = counts >= size
    for k in range(1, size):
        keep[(bounds[1:] - k)[full]] = False
    for d in np.flatnonzero(~full & (counts > 0)):
        a, b = bounds[d], bounds[d + 1]
        total[a] = mix((words[a:b] * _PLACES[: b - a]).sum(dtype=_U)[None] + _U(b - a))[0]
        keep[a + 1 : b] = False
    found = np.where(full, counts - size + 1, np.minimum(counts, 1))
    return total[keep], np.concatenate([[0], np.cumsum(found)])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, and n + 1 offsets."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets
