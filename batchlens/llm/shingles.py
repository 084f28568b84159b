"""Word shingles of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

from batchlens.llm.common import hold_tables

#: Words whose hash a worker keeps at a time.
CACHED_WORDS = 250_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def shingles(text: str, size: int = 5) -> np.ndarray:
    """Sorted different hashes of the `size`-word shingles; the whole sequence is one if it is shorter.

    Words are runs of bytes other than blank and 0x09 to 0x0D; A-Z count as a-z.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _word_hashes()
    hold_tables("shingles", known.clear)
    if len(known) > CACHED_WORDS:
        known.clear()
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    mixed = hashes[:n].copy()
    for i in range(1, size):
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MULTIPLIER
        mixed += hashes[i : n + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MULTIPLIER
    mixed.sort()
    keep = np.ones(n, bool)
    np.not_equal(mixed[1:], mixed[:-1], out=keep[1:])
    return mixed[keep]


def set_digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())
