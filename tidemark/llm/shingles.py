"""Word shingles of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import in_pieces

_MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Words(dict):
    """Hashes of words, kept for the words met most recently."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()
forget_words = _words.clear


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash for each word of the text, A-Z lower-cased, in order."""
    data = text.encode("utf-8", "surrogatepass").lower()  # of bytes: ASCII letters only
    get = _words.__getitem__
    parts = [np.fromiter(map(get, words), np.uint64, len(words)) for words in (p.split() for p in in_pieces(data))]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX2
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles.

    Fewer words than ``k`` make one shingle of the whole sequence; no words,
    or no text, an empty set.
    """
    if not text:
        return np.empty(0, np.uint64)
    w = word_hashes(text)
    n = min(k, len(w))
    if not n:
        return np.empty(0, np.uint64)
    m = len(w) - n + 1
    with np.errstate(over="ignore"):
        h = np.full(m, np.uint64(n), np.uint64)
        for i in range(n):
            h = _mixed(h * _MIX1 + w[i : i + m])
    return np.unique(h)
