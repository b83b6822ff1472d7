"""Splits text by the public byte-level pattern with numpy, many documents at once.

The pattern: contractions ('s 't 're 've 'm 'll 'd), then runs of letters, of numbers or of other characters, each with
one space before it, then white space: a run before other text leaves its last character out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

from feedloom.llm.common import at_space, ranges

LETTER, NUMBER, OTHER, SPACE = range(4)
#: Unicode's White_Space.
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, [x if not 0xD800 <= x < 0xE000 else 0 for x in range(0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, points):
            out[m.start() : m.end()] = kind
    out[list(WHITE)] = SPACE
    return out


def starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The byte positions at which matches begin, over rows of valid UTF-8 that begin at offs[:-1]."""
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = data if len(at) == len(data) else np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kinds, n = classes()[points], len(points)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, offs)] = True
    start = first.copy()
    start[1:n] |= kinds[1:] != kinds[:-1]
    # the last character of white space before other text of the same row
    last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~first[1:n])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero(points[:-1] == 39)
    quote = quote[start[quote] & ~first[quote + 1]]
    if len(quote):
        a = points[quote + 1]
        two = quote + 2
        b = np.where((two < n) & ~first[np.minimum(two, n)], points[np.minimum(two, n - 1)], 0)
        one = np.isin(a, [ord(x) for x in "stmd"])
        pair = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for q, size in ((quote[one], 1), (quote[pair], 2)):
            start[q + 1] = False
            after = q + 1 + size
            start[after[after < n]] = True
    return at[np.flatnonzero(start[:n])]


def may_cut(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Whether a match begins between two bytes whatever stands around them: at white space after something else."""
    return at_space(before, after) & (before < 128)


def per_row(begin: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where each row's matches begin among all, and their end."""
    return np.searchsorted(begin, offs)


class Pool:
    """A value, an array of integers, for every byte string seen; it forgets all beyond so many strings or bytes."""

    def __init__(self, most: int = 400_000, most_bytes: int = 8 << 20):
        self.most, self.most_bytes = most, most_bytes
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.values, self.used, self.held = np.zeros(1 << 16, np.uint32), 0, 0
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def lookup(self, keys: list[bytes], values: Callable[[list[bytes]], list]) -> np.ndarray:
        """The place of each key; values(keys) gives the arrays of those not seen before."""
        if len(self.index) > self.most or self.held > self.most_bytes:
            self.clear()
        known = self.index
        out = np.fromiter((known.get(k, -1) for k in keys), np.int64, len(keys))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            wanted = [keys[i] for i in missing.tolist()]
            new = values(wanted)
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            at, total = len(known), int(sizes.sum())
            while self.used + total > len(self.values):
                self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            while at + len(new) > len(self.begin):
                self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
            self.values[self.used : self.used + total] = np.concatenate([np.asarray(x, np.uint32) for x in new])
            self.begin[at : at + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.size[at : at + len(new)] = sizes
            self.used += total
            self.held += sum(map(len, wanted))
            out[missing] = np.arange(at, at + len(new))
            known.update(zip(wanted, range(at, at + len(new)), strict=True))
        return out

    def gather(self, places: np.ndarray) -> np.ndarray:
        return self.values[ranges(self.begin[places], self.size[places])]
