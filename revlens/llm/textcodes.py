"""Vectorised text helpers for Arrow batches: code points, words and 64-bit hashes as NumPy arrays."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

WORD_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def text_slabs(texts: list[str | None], most_chars: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_chars`` characters, one row at least."""
    lo = chars = 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= most_chars:
            yield lo, i + 1
            lo, chars = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by one 0, and the positions of those zeros.

    A zero inside a text becomes a space, so only the marks part texts.
    """
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    codes = np.frombuffer("".join(t + "\0" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    ends = np.cumsum(sizes) - 1
    codes[codes == 0] = 32
    codes[ends] = 0
    return codes, ends


@functools.lru_cache(maxsize=None)
def character_table(kind: str) -> np.ndarray:
    """For every code point whether it is a letter (``alpha``) or a letter or number (``alnum``)."""
    test = str.isalpha if kind == "alpha" else lambda c: c.isalpha() or c.isnumeric()
    return np.fromiter((test(chr(i)) for i in range(0x110000)), bool, 0x110000)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every maximal run of ``inside`` characters.

    A word's hash is a polynomial of its code points modulo 2**64, scrambled; equal words have equal
    hashes wherever they stand.
    """
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    at = np.flatnonzero(inside)
    lengths = np.diff(np.append(np.searchsorted(at, starts), len(at)))
    nth = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    powers = np.full(int(lengths.max()), WORD_BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    terms = (codes[at].astype(np.uint64) + np.uint64(1)) * powers[nth]
    return mix(np.add.reduceat(terms, np.cumsum(lengths) - lengths)), starts
