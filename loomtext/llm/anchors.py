"""Content-defined anchors of byte texts.

An anchor is the leftmost smallest q-gram hash of a window of ``reach`` consecutive q-grams; a window of q-grams
is exactly the q-grams of one string of ``length`` = q + reach - 1 bytes. Equal strings have their anchor at the same
place, so every string of ``length`` bytes is found through its anchor, and anchors are few: 2 in reach + 1 bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .bytehash import RollingHash


@dataclass(frozen=True)
class Anchored:
    at: np.ndarray  # places of the anchors, rising
    low: np.ndarray  # the strings of an anchor start at - high .. at - low
    high: np.ndarray
    core: np.ndarray  # hash of the q-gram
    hull: np.ndarray  # hash of the bytes that the anchor's strings cover, with low and high


#: Bits of a place in a text: texts are under 2 GiB.
PLACE_BITS = 31


class Anchorer:
    def __init__(self, length: int):
        if length < 8:
            raise ValueError("length is at least 8")
        self.length = length
        self.reach = 1 << ((2 * length // 3).bit_length() - 1)
        self.q = length - self.reach + 1
        self.cores, self.hulls = RollingHash(11), RollingHash(13)

    def __call__(self, data: np.ndarray) -> Anchored:
        n = len(data)
        if n < self.length:
            none = np.zeros(0, dtype=np.int64)
            return Anchored(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
        prefix = self.cores.prefix(data)
        starts = np.arange(n - self.q + 1)
        grams = self.cores.stretches(prefix, starts, starts + self.q)
        # the hash's high bits and the place: the least number is the leftmost of the least hashes, whatever the text's length
        bits = np.uint64(PLACE_BITS)
        least = ((grams >> bits) << bits) | starts.astype(np.uint64)
        step = 1
        while step < self.reach:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        chosen = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        last = np.concatenate([first[1:], [len(chosen)]]) - 1
        at = chosen[first]
        low, high = at - last, at - first
        hulls = self.hulls.stretches(self.hulls.prefix(data), first, last + self.length)
        hulls = hulls + (low * 1024 + high).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return Anchored(at, low, high, grams[at], hulls)
