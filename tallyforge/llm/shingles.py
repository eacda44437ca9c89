"""Hashes of words and of five-word shingles, for batches of texts in a Python worker."""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words seen lately; emptied when it grows, so that memory is bounded."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space as UTF-8, A-Z in lower case; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's five-word shingles.

    A text of one to four words has one shingle, its whole sequence; without words it has none.
    """
    words = words_of(text)
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    size = min(n, SIZE)
    h = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        h = h * _STEP + w[i : n - size + 1 + i]
    return np.unique(mixed(h))
