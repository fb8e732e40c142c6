"""Sets of word shingles as sorted arrays of 64-bit hashes, computed by numpy inside Spark tasks."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

REMEMBERED = 700_000
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


class Shingler:
    """``hashes(text)``: the distinct shingles of ``size`` words of a text, ascending.

    Words are runs of bytes other than space and 0x09 to 0x0D, with A-Z lower-cased. A text with
    fewer words than ``size`` is one shingle; without words it has none. Two different shingles
    share a 64-bit hash with a chance of about 1 in 10**19.
    """

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(codes))
        total = np.full(len(codes) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            total += codes[i : i + len(total)] * MIX[i % len(MIX)] + np.uint64(i)
            total ^= total >> np.uint64(29)
            total *= MIX[(i + 2) % len(MIX)]
        total ^= total >> np.uint64(32)
        return np.unique(total)


def node_of(hashes: np.ndarray) -> int:
    """A set's 64-bit name."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)
