"""Word shingles as 64-bit hashes, shared by the near-duplicate operators.

Words are runs of anything but the six ASCII blanks, with A-Z lower-cased:
``bytes.lower`` and ``bytes.split`` do exactly that on UTF-8.  A shingle is
five words in a row; a text with one to four words has its whole sequence as
one shingle; a text that is null or has no words has none.  A shingle is
represented by a 64-bit hash of its words, so two different shingles of one
comparison meet by chance about once in 10**15 comparisons.
"""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_MASK = (1 << 64) - 1
#: Odd multipliers of the positions in a shingle; sequences shorter than
#: WIDTH add a constant for their length.
_STEP = [(0x9E3779B97F4A7C15 * (2 * i + 1) ^ 0xD6E8FEB86659FD93) & _MASK | 1 for i in range(WIDTH)]
_LENGTH = [np.uint64((0xA0761D6478BD642F * (n + 1)) & _MASK) for n in range(WIDTH)]


class WordHashes(dict):
    """Hash of each word, remembered for up to ``most`` words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes (int64, so that Spark sorts alike) of a text's shingles."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(tokens)
    if not n:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(words.__getitem__, tokens), np.uint64, n)
    if n < WIDTH:
        total = _LENGTH[n]
        for i in range(n):
            total = total + hashes[i : i + 1] * np.uint64(_STEP[i])
        return mix(total).view(np.int64)
    m = n - WIDTH + 1
    total = hashes[:m] * np.uint64(_STEP[0])
    for i in range(1, WIDTH):
        total += hashes[i : i + m] * np.uint64(_STEP[i])
    return np.unique(mix(total).view(np.int64))
