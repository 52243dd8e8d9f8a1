"""Stable 64-bit hashes of words."""

from __future__ import annotations

from collections.abc import Collection

import numpy as np
import xxhash

# Word hashes that a worker remembers; beyond it starts afresh.
REMEMBERED_WORDS = 1 << 18


class WordHashes(dict):
    """64-bit hashes of words in UTF-8, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: Collection[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
