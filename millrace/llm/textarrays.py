"""Texts as numpy arrays: words and word shingles of many documents at once.

A word is a longest run of letters and digits, compared in lower case. Hashes
depend on the text alone, so every process and every run agrees on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np

U = np.uint64
CHUNK_CHARS = 2_000_000
_STEP = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it part of a word, and the hash of its lower case."""
    chars = [chr(i) for i in range(0x110000)]
    word = np.fromiter(map(str.isalnum, chars), bool, len(chars))
    lower = np.fromiter((ord(c.lower()[0]) for c in chars), np.uint64, len(chars))
    return word, mix(lower * _STEP + U(1))


_powers = np.ones(1, U)


def _powers_upto(n: int) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64."""
    global _powers
    if len(_powers) < n:
        base = np.full(max(n, 2 * len(_powers)), U(0xD6E8FEB86659FD93), U)
        base[0] = U(1)
        _powers = np.multiply.accumulate(base)
    return _powers


def codes_of(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins (with the end as last entry)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=starts[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), starts


def words(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text's words begin (with the end as last entry)."""
    codes, starts = codes_of(texts)
    is_word, hashes = _letters()
    inside = is_word[codes]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = starts[:-1][starts[:-1] < len(codes)]
    first[begin] = inside[begin]
    at = np.flatnonzero(first)
    bounds = np.searchsorted(at, starts)
    if not len(at):
        return np.empty(0, U), bounds
    held = np.flatnonzero(inside)
    run = np.searchsorted(held, at)
    place = np.arange(len(held)) - np.repeat(run, np.diff(np.append(run, len(held))))
    terms = hashes[codes[held]] * _powers_upto(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(terms, run)), bounds


def shingles(texts: Sequence[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words, in text order, and where each text's begin.

    A text with fewer words has one shingle of all its words; a text without
    words has none.
    """
    word, bounds = words(texts)
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(made, out=starts[1:])
    if not starts[-1]:
        return np.empty(0, U), starts
    at = np.arange(starts[-1]) + np.repeat(bounds[:-1] - starts[:-1], made)
    last = np.repeat(bounds[1:], made)
    power = _powers_upto(width)
    padded = np.append(word, np.zeros(width, U))
    total = np.zeros(len(at), U)
    for k in range(width):
        total += np.where(at + k < last, padded[at + k], U(k + 1)) * power[k]
    return mix(total), starts
