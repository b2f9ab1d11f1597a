"""Word shingles as sorted arrays of 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_WEIGHTS = np.random.default_rng(5).integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHORT = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Word -> 64-bit hash; forgets everything when it holds 50,000 words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 50_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _SHORT
    return h ^ (h >> np.uint64(32))


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def shingle_set(text: str | None, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; a shorter text is one shingle, one without words has none.

    Letters A-Z are lower-cased; words are runs other than ASCII white space.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    if n < WIDTH:
        return mixed((w * _WEIGHTS[:n]).sum(keepdims=True) + np.full(1, n, np.uint64) * _SHORT)
    h = w[: n - WIDTH + 1] * _WEIGHTS[0]
    for i in range(1, WIDTH):
        h += w[i : n - WIDTH + 1 + i] * _WEIGHTS[i]
    return distinct(mixed(h))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    both = np.sort(np.concatenate((a, b)))
    return int(np.count_nonzero(both[1:] == both[:-1]))
