"""Hashed word shingles of whole texts, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import CACHES

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


class WordHashes(dict):
    """64-bit hash of each word met, emptied when it has grown too large."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = WordHashes()
CACHES.append(_hashes)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    h = hashes[:count].copy()
    for k in range(1, size):
        h ^= h >> _SHIFT
        h *= _MIX
        h += hashes[k : k + count]
    h ^= h >> _SHIFT
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, none if it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII case and white space only
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(rolling(word_hashes(words), min(size, len(words))) + np.uint64(max(0, size - len(words))))
