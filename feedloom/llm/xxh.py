"""XXH64 of many byte strings at once."""

from __future__ import annotations

import numpy as np

#: The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """The hash of data[begin : begin + size] of every string."""
    buffer = np.concatenate([data, np.zeros(8, np.uint8)]).tobytes()
    n = len(buffer)
    eight = np.ndarray((n - 7,), "<u8", buffer, strides=(1,))
    four = np.ndarray((n - 3,), "<u4", buffer, strides=(1,))
    order = np.argsort(size, kind="stable")
    at, left = begin[order].astype(np.int64), size[order].astype(np.int64)
    whole = left.astype(np.uint64)
    out = np.full(len(at), np.uint64(seed) + P5)
    first = int(np.searchsorted(left, 32))
    if first < len(left):
        lanes = [np.full(len(left) - first, np.uint64((seed + x) % (1 << 64))) for x in (int(P1) + int(P2), int(P2), 0, -int(P1))]
        stripes = left[first:] // 32
        for done in range(int(stripes[-1])):
            low = int(np.searchsorted(stripes, done, "right"))  # sorted by size, those that go on are the last ones
            for i in range(4):
                lanes[i][low:] = _round(lanes[i][low:], eight[at[first + low :] + 8 * i])
            at[first + low :] += 32
            left[first + low :] -= 32
        mix = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
        for lane in lanes:
            mix = (mix ^ _round(np.zeros_like(lane), lane)) * P1 + P4
        out[first:] = mix
    out += whole
    while (go := np.flatnonzero(left >= 8)).size:
        out[go] = _turn(out[go] ^ _round(np.zeros(len(go), np.uint64), eight[at[go]]), 27) * P1 + P4
        at[go] += 8
        left[go] -= 8
    if (go := np.flatnonzero(left >= 4)).size:
        out[go] = _turn(out[go] ^ (four[at[go]].astype(np.uint64) * P1), 23) * P2 + P3
        at[go] += 4
        left[go] -= 4
    while (go := np.flatnonzero(left > 0)).size:
        out[go] = _turn(out[go] ^ (np.frombuffer(buffer, np.uint8)[at[go]].astype(np.uint64) * P5), 11) * P1
        at[go] += 1
        left[go] -= 1
    out ^= out >> np.uint64(33)
    out *= P2
    out ^= out >> np.uint64(29)
    out *= P3
    out ^= out >> np.uint64(32)
    back = np.empty_like(out)
    back[order] = out
    return back
