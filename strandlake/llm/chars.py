"""Vectorised character and word kernels shared by the text operators.

Texts of an Arrow batch are laid end to end as one array of code points, and words, hashes and n-grams
are computed on that array, so that no Python code runs per character or word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Code points handled at once; a longer single text is still handled whole.
BLOCK_CHARS = 500_000
#: Odd multiplier of the polynomial word hash modulo 2^64.
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: the simple lower-case mapping, is it a letter, is it a letter or digit."""
    n = 0x110000
    lower = np.arange(n, dtype=np.uint32)
    letter = np.zeros(n, bool)
    word = np.zeros(n, bool)
    for i in range(n):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        if c.isalnum():
            word[i] = True
            letter[i] = c.isalpha()
            low = c.lower()
            if len(low) == 1 and low != c:
                lower[i] = ord(low)
    return lower, letter, word


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def powers(n: int, base: int = MULTIPLIER) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    return _powers(1 << max(12, (n - 1).bit_length()), base)[:n]


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by one 0, and the start of each text (with the end last)."""
    joined = "\0".join(texts) + "\0" if texts else ""
    out = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return out, starts


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit hash over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words (maximal runs of letters and digits, lower-cased) of a list of texts.

    first, last: code point range of each word; hashes: 64 bits each; bounds: words of text i are
    bounds[i]:bounds[i+1]; offsets: where text i begins in the array the ranges refer to.
    """

    def __init__(self, texts: list[str]):
        lower, _, word = tables()
        self.texts = texts
        raw, self.offsets = codes(texts)
        self.raw = raw
        cps = lower[raw]
        inside = word[raw]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.first = np.flatnonzero(edge == 1)
        self.last = np.flatnonzero(edge == -1)
        n = len(raw)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * powers(n), out=total[1:])
        self.hashes = mix((total[self.last] - total[self.first]) * powers(n + 1, INVERSE)[self.first] + (self.last - self.first).astype(np.uint64))
        self.bounds = np.searchsorted(self.first, self.offsets)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n consecutive words within a text, and bounds by text. A text with fewer words has none."""
        h = self.hashes
        if len(h) < n:
            return np.zeros(0, np.uint64), np.zeros(len(self.texts) + 1, np.int64)
        out = h[: len(h) - n + 1].copy()
        for i in range(1, n):
            out = mix(out * np.uint64(MULTIPLIER) + h[i : len(h) - n + 1 + i])
        counts = np.maximum(np.diff(self.bounds) - n + 1, 0)
        bounds = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=bounds[1:])
        at = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1] - bounds[:-1], counts)
        return out[at], bounds


def blocks(texts: Iterable[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) in order, each block of about `limit` characters or one longer text."""
    held: list[str] = []
    size = first = 0
    for i, t in enumerate(texts):
        if held and size + len(t) > limit:
            yield first, held
            held, size, first = [], 0, i
        held.append(t)
        size += len(t)
    if held:
        yield first, held
