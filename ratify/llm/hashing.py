"""Hashes of words and word windows in numpy, the same in every process."""

from __future__ import annotations

import numpy as np
import xxhash

from ratify.llm.common import kept


class _Words(dict):
    """word -> 64-bit hash; forgets all once it holds ``most`` words."""

    most = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash for each word."""
    return np.fromiter(map(kept(_Words).__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (multiply and shift, twice)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; one for all of them if there are fewer."""
    size = min(size, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total = mix(total + np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return total
