"""64-bit hashes of many stretches of bytes at once.

A stretch's hash is a polynomial of its bytes modulo 2^64, from differences
of running sums, then mixed; it is the same in every process.
"""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([c])) for c in range(256)], np.uint64)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * _power(_BASE, k)])
            self.down = np.concatenate([self.down, self.down * _power(_BASE_INVERSE, k)])


def _power(x: int, n: int) -> np.ndarray:
    return np.array([pow(x, n, 1 << 64)], np.uint64)


_powers = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.array([0xBF58476D1CE4E5B9], np.uint64)
    h = (h ^ (h >> np.uint64(27))) * np.array([0x94D049BB133111EB], np.uint64)
    return h ^ (h >> np.uint64(31))


def stretch_hashes(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``text[start:end]`` (bytes as an array) for each pair."""
    _powers.reach(len(text) + 1)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTES[text] * _powers.up[:len(text)], dtype=np.uint64, out=sums[1:])
    return mix((sums[end] - sums[start]) * _powers.down[start] + (end - start).astype(np.uint64))
