"""Words of many texts at once as runs of numpy bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Words:
    """Lower-cased words (A-Z only), each followed by one space in `data`; `rows` has where each text's words begin and end."""

    data: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    rows: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


def lowered(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def words_of(data: np.ndarray, offs: np.ndarray) -> Words:
    """The runs of bytes other than 0x20 and 0x09-0x0D of every row."""
    data = np.insert(lowered(data), offs[1:], 32)  # so that no word reaches into the next row
    data[(data >= 9) & (data <= 13)] = 32
    inside = np.zeros(len(data) + 2, bool)
    np.not_equal(data, 32, out=inside[1:-1])
    begin, end = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2).T
    size = end - begin
    place = np.cumsum(size + 1) - size - 1
    out = data[inside[1:-1] | inside[:-2]]  # the words, each with the space after it
    return Words(out, place, size, np.searchsorted(begin, offs + np.arange(len(offs))))
