"""Sets of word shingles as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Fixed odd multipliers.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct hashes of the ``width``-word shingles of a text, A-Z lower-cased.

    Words are runs of anything but ASCII white space. A text with fewer words is
    one shingle; a text without words has none.
    """

    MOST_WORDS = 100_000

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def words(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        known = self.known
        try:
            found = [known[w] for w in words]
        except KeyError:
            if len(known) > self.MOST_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            found = [known[w] for w in words]
        return np.array(found, np.uint64)

    def shingles(self, text: str) -> np.ndarray:
        words = self.words(text)
        n = len(words)
        if not n:
            return words
        width = min(self.width, n)
        total = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            total = mix(total * _STEP + words[k : n - width + 1 + k])
        return np.unique(total)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct numbers."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def blocks(values: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for lo in range(0, len(values), size):
        yield values[lo : lo + size]
