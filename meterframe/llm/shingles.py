"""Word shingles of texts as 64-bit hashes.

Words are runs of characters other than space and U+0009 to U+000D, with A-Z
lower-cased.  A shingle is five words in order; a text with fewer words is one
shingle, and a text without words has none.  Hashes of words are looked up in a
table of bounded size; those of shingles are worked out on whole arrays.
"""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
CACHED_WORDS = 400_000  # per task
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every bit depends on every bit."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = h
        return h

    def of(self, text: str) -> np.ndarray:
        """Hashes of a text's words in order."""
        words = text.encode().lower().split()  # of bytes: ASCII case and ASCII white space
        return np.array([self[w] for w in words], np.uint64)


def shingles(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's word hashes."""
    if len(words) == 0:
        return words
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total += mixed(words[k : len(words) - width + 1 + k] * MULTIPLIERS[k % 5] + np.uint64(k))
        total *= MULTIPLIERS[(k + 1) % 5]
    return np.unique(mixed(total))


def set_key(shingle_hashes: np.ndarray) -> bytes:
    """16 bytes that name a set."""
    return xxhash.xxh3_128_digest(shingle_hashes.tobytes())
