"""Words of a text as 64-bit hashes, and hashes of their windows, in numpy."""

import numpy as np
import xxhash

_MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(33)


class WordHashes(dict):
    """Hash of each word seen; forgets all when it holds ``limit`` words."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Maximal runs of bytes other than space and 0x09-0x0D; ``lower`` folds A-Z only."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> _SHIFT)
    values = values * _MIX_1
    values ^= values >> _SHIFT
    values *= _MIX_2
    values ^= values >> _SHIFT
    return values


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for step in range(1, width):
        total *= _BASE
        total += hashes[step : step + count]
    return mix(total)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct windows; a shorter text is one window, no words give none."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes, min(width, len(hashes))))
