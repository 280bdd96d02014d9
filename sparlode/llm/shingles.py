"""Word shingles as 64-bit hashes."""

from __future__ import annotations

from itertools import chain

import numpy as np
from xxhash import xxh3_64_intdigest

#: Odd multipliers, one per position in a shingle, and of the final mix.
_POSITION = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _MIX
    return (x ^ (x >> _S)) * _MIX


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """Lower-cases A-Z and hashes the words between the blanks \\x20 and \\x09-\\x0D."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words; fewer words are one shingle, none gives none."""
    n = len(words)
    if not n:
        return words
    took = min(n, width)
    total = np.full(n - took + 1, took, dtype=np.uint64)
    for j in range(took):
        total += mix(words[j : n - took + 1 + j] + np.uint64(j)) * _POSITION[j % 5]
    return np.unique(mix(total))


def runs(split: list[list[bytes]], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of several texts of at least `width` lower-case words in the order of the texts, repeated ones too, and where each text's begin."""
    size = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    words = np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(split)), dtype=np.uint64, count=int(size.sum()))
    many = size - width + 1
    begins = np.cumsum(many) - many
    at = np.arange(int(many.sum())) + np.repeat(np.arange(len(split)), many) * (width - 1)
    total = np.full(len(at), width, dtype=np.uint64)
    for j in range(width):
        total += (mix(words + np.uint64(j)) * _POSITION[j % 5])[at + j]
    return mix(total), begins


def all_shingles(split: list[list[bytes]], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of several texts of at least `width` lower-case words, as `shingles` gives them, one after the other, and where each text's begin."""
    total, begins = runs(split, width)
    text = np.repeat(np.arange(len(split)), np.diff(np.append(begins, len(total))))
    order = np.lexsort((total, text))
    total, text = total[order], text[order]
    first = np.ones(len(total), dtype=bool)
    first[1:] = (total[1:] != total[:-1]) | (text[1:] != text[:-1])
    total, text = total[first], text[first]
    return total, np.searchsorted(text, np.arange(len(split)))
