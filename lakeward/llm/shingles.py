"""Hashes of five-word shingles and MinHash values over them."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from xxhash import xxh3_64_intdigest

WORDS_PER_SHINGLE = 5

_FACTORS = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = re.compile(r"\w+")
# A character beyond ASCII that ends words, and for the rest blanks for all ASCII characters that do.
_ODD = re.compile(r"[^\w\x00-\x7f]")
_LETTERS = bytes(c if c > 127 or chr(c).isalnum() or chr(c) == "_" else 32 for c in range(256))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of a published 64-bit hash)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def ascii_words(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at space and the ASCII controls 9 to 13; the bytes are UTF-8."""
    return text.encode().lower().split()


def letter_words(text: str) -> list[str]:
    """Lower case, letters, digits and underscores only: punctuation does not tell words apart."""
    return _WORD.findall(text.lower())


def letter_tokens(text: str) -> list[bytes] | list[str]:
    """``letter_words`` for hashing: in UTF-8, which has the same hashes, where that is cheaper."""
    text = text.lower()
    return _WORD.findall(text) if _ODD.search(text) else text.encode().translate(_LETTERS).split()


def word_hashes(words: Iterable, n: int) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)


def hashes_of_runs(w: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` neighbours of an array of word hashes."""
    n = len(w) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h += mix(w[i : i + n] + _FACTORS[i]) * _FACTORS[i + 16]
    return mix(h)


def shingle_hashes(words: list, size: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """A hash of each ``size`` neighbouring words, in order; none if there are fewer words."""
    return hashes_of_runs(word_hashes(words, len(words)), size) if len(words) >= size else np.zeros(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; the whole sequence is one if it has fewer than five words."""
    words = ascii_words(text or "")
    return np.unique(shingle_hashes(words, min(WORDS_PER_SHINGLE, len(words)))) if words else np.zeros(0, np.uint64)


def block_minima(hashes: np.ndarray, functions: int, block: int) -> np.ndarray:
    """For each ``block`` neighbours (the last may be fewer), the least value under each of several functions."""
    factors = _FACTORS[64 : 64 + functions]
    out = np.empty((-(-len(hashes) // block), functions), np.uint64)
    step = block * max(1, 1024 // block)
    for at in range(0, len(hashes), step):
        values = hashes[at : at + step, None] * factors
        starts = np.arange(0, len(values), block)
        out[at // block : at // block + len(starts)] = np.minimum.reduceat(values, starts)
    return out


def minhash(hashes: np.ndarray, functions: int) -> np.ndarray:
    """The least value of a set under each function."""
    least = np.full(functions, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(hashes), 1024):
        values = hashes[at : at + 1024, None] * _FACTORS[64 : 64 + functions]
        np.minimum(least, values.min(axis=0), out=least)
    return least
