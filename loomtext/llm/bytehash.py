"""Rolling 64-bit hashes of byte stretches, vectorised.

A stretch's hash is the sum of table[byte] * BASE^place, taken from prefix sums and moved to a common place by
the inverse power; a finaliser mixes the bits. Tables come from fixed seeds, so every task agrees.
"""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class RollingHash:
    def __init__(self, seed: int):
        self.table = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) >= n:
            return
        size = max(n, 2 * len(self.powers), 1 << 12)
        for name, base in (("powers", _BASE), ("inverses", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base & _MASK, dtype=np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of a byte array; one longer than it."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=out[1:])
        return out

    def stretches(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of data[start:end], with the length in them."""
        raw = (prefix[end] - prefix[start]) * self.inverses[start]
        return mix(raw + (end - start).astype(np.uint64) * _M2)
