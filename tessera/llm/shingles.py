"""Five-word shingles of whole texts as 64-bit hashes (Arrow batches in numpy)."""

from __future__ import annotations

import re

import numpy as np

from .common import sole_cache

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
SIZE = 5
CACHE = 500_000
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def word_hashes(text: str | None) -> np.ndarray:
    """uint64 hash of every word (A-Z lower-cased, split at ASCII white space)."""
    import xxhash
    if not text:
        return np.empty(0, "u8")
    words = WORDS.findall(text.encode("utf-8", "surrogatepass").lower())
    known = sole_cache("word hashes", dict)
    if len(known) > CACHE:
        known.clear()
    try:
        return np.array([known[w] for w in words], "u8")
    except KeyError:
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.array([known[w] for w in words], "u8")


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; empty for shorter texts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, "u8")
    h = words[:n].copy()
    for o in range(1, size):
        h *= MIX[4]
        h += words[o:o + n]
    return mix(h)


def shingle_set(words: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Sorted distinct shingles; a shorter, non-empty text is one shingle."""
    if len(words) == 0:
        return np.empty(0, "i8")
    h = shingle_hashes(words, size) if len(words) >= size else shingle_hashes(words, len(words))[:1] ^ np.uint64(len(words))
    return np.unique(h.view("i8"))


def set_name(tokens: np.ndarray) -> int:
    """64-bit name of a set (equal sets, equal names)."""
    import xxhash
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)
