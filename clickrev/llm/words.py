"""Words and their hashes, for the operators that work on n-grams of words."""
import re
from collections.abc import Sequence

import numpy as np
import xxhash

_WORD = re.compile(r"\w+")
_CACHED_WORDS = 500_000

# Fixed odd multipliers for mixing 64-bit hashes.
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str) -> list[str]:
    """The words of a text: runs of letters, digits and underscores, in lower case."""
    return _WORD.findall(text.lower())


class WordHashes(dict):
    """64-bit hashes of words, remembered per worker process."""

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        self[word] = value
        return value

    def of(self, words: Sequence[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORD_HASHES = WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that any bits of the result can be used."""
    values = (values ^ (values >> np.uint64(31))) * MIX_A
    values = (values ^ (values >> np.uint64(29))) * MIX_B
    return values ^ (values >> np.uint64(32))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each window of ``n`` words; empty for fewer words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    value = hashes[:count].copy()
    for k in range(1, n):
        value = value * MIX_A + hashes[k : k + count]
    return mixed(value)


def shingles(text: str, n: int) -> np.ndarray:
    """The set of hashed shingles of ``n`` words, sorted.

    A text of fewer words has one shingle of all its words; a text without a word has
    the stripped text as its one shingle, and none if it is blank.
    """
    words = words_of(text)
    if len(words) >= n:
        return np.unique(rolling(WORD_HASHES.of(words), n))
    key = " ".join(words) or text.strip()
    if not key:
        return np.empty(0, np.uint64)
    return np.array([xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))], np.uint64)
