"""Static 3-wise binary-fuse filters over 64-bit keys, built and probed with numpy."""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<QIII")
U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) of key + seed."""
    with np.errstate(over="ignore"):
        x = keys + U(seed)
        x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U(33))


def _slots(h: np.ndarray, seg: int, n_seg: int) -> np.ndarray:
    """Three slots per key, in three consecutive segments."""
    start = ((h >> U(32)) * U(n_seg)) >> U(32)
    low = start * U(seg) + (h & U(seg - 1))
    mid = (start + U(1)) * U(seg) + ((h >> U(16)) & U(seg - 1))
    high = (start + U(2)) * U(seg) + ((h >> U(27)) & U(seg - 1))
    return np.stack([low, mid, high]).astype(np.int64)


def _print8(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> U(40))) & U(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of a set of distinct uint64 keys, as bytes."""
    n = len(keys)
    seg = 1 << max(2, min(18, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    n_seg = max(1, math.ceil(n * factor / seg) - 2 + 2)
    cells = (n_seg + 2) * seg
    for seed in range(1, 1000):
        h = _mix(keys, seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        where = _slots(h, seg, n_seg)
        order = _peel(where, cells, n)
        if order is None:
            continue
        table = np.zeros(cells, np.uint8)
        prints = _print8(h)
        for key, own in reversed(order):  # within a round no key owns a cell that another one reads
            a, b, c = where[:, key]
            table[own] = prints[key] ^ table[a] ^ table[b] ^ table[c]
        return _HEAD.pack(seed, seg, n_seg, n) + table.tobytes()
    raise ValueError("keys are not distinct")


def _peel(where: np.ndarray, cells: int, n: int):
    """Rounds of (keys, the cells only they use), or None if a core is left."""
    count = np.bincount(where.ravel(), minlength=cells)
    xor = np.zeros(cells, np.int64)
    ids = np.arange(n, dtype=np.int64)
    for row in where:
        np.bitwise_xor.at(xor, row, ids)
    rounds, left = [], n
    single = np.flatnonzero(count == 1)
    while len(single):
        key, first = np.unique(xor[single], return_index=True)
        rounds.append((key, single[first]))
        left -= len(key)
        for row in where[:, key]:
            np.subtract.at(count, row, 1)
            np.bitwise_xor.at(xor, row, key)
        near = np.unique(where[:, key].ravel())
        single = near[count[near] == 1]
    return rounds if left == 0 else None


def contains(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the set, and for about one in 256 of the others."""
    seed, seg, n_seg, n = _HEAD.unpack_from(filter_)
    if not n:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(filter_, np.uint8, offset=_HEAD.size)
    h = _mix(keys, seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    a, b, c = _slots(h, seg, n_seg)
    return _print8(h) == (table[a] ^ table[b] ^ table[c])
