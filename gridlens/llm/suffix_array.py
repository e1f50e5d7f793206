"""Suffix arrays of byte strings with numpy: by prefix doubling, and lookups of many patterns."""

from __future__ import annotations

import numpy as np


def words_at(data: np.ndarray, pos: np.ndarray | None = None) -> np.ndarray:
    """The 8 bytes from each position (of all, or those given) as a big-endian number, zeros past the end."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(n if pos is None else len(pos), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | (padded[i : i + n] if pos is None else padded[np.minimum(pos + i, n)])
    return out


def suffix_array(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of the next ``width`` bytes, at least, and the first 8 bytes at each of them."""
    key = words_at(data)
    order = np.argsort(key)
    first = key[order]
    have = 8
    while have < width:
        new = np.empty(len(order), bool)
        new[:1] = True
        new[1:] = key[order[1:]] != key[order[:-1]]
        if new.all():
            break
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.cumsum(new, dtype=np.uint64)
        after = np.zeros_like(rank)
        after[: max(0, len(rank) - have)] = rank[have:]
        key = (rank << np.uint64(32)) | after
        order = np.argsort(key)
        have *= 2
    return order, first


class Patterns:
    """Byte patterns to find, with their 8-byte words."""

    def __init__(self, patterns: list[bytes]) -> None:
        self.patterns = patterns
        self.size = np.array([len(p) for p in patterns], np.int64)
        self.low = np.array([int.from_bytes(p[:8].ljust(8, b"\0"), "big") for p in patterns], np.uint64)
        self.high = np.array([int.from_bytes(p[:8].ljust(8, b"\xff"), "big") for p in patterns], np.uint64)
        self.long = np.flatnonzero(self.size > 8)

    def ranges(self, data: np.ndarray, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each pattern's occurrences in the suffix array."""
        begin = np.searchsorted(first, self.low, "left")
        end = np.searchsorted(first, self.high, "right")
        for p in self.long[end[self.long] > begin[self.long]]:
            pattern, a, b = self.patterns[p], begin[p], end[p]
            for at in range(8, len(pattern), 8):
                part = pattern[at : at + 8]
                next_ = words_at(data, order[a:b] + at)
                lo = np.searchsorted(next_, np.uint64(int.from_bytes(part.ljust(8, b"\0"), "big")), "left")
                hi = np.searchsorted(next_, np.uint64(int.from_bytes(part.ljust(8, b"\xff"), "big")), "right")
                a, b = a + lo, a + hi
                if a >= b:
                    break
            begin[p], end[p] = a, max(a, b)
        return begin, end


# Alphabets up to this size are sorted bucket by bucket.
BUCKETS = 4096


def sort_suffixes(s: np.ndarray, size: int) -> np.ndarray:
    """The suffix array of ``s`` (numbers from 1 to ``size - 1``, and one 0 at its end) by induced sorting.

    Suffixes are classified as smaller or larger than the next one.  The
    leftmost-smaller substrings are sorted by inducing from them unsorted, and
    named; the string of names, if some are equal, is sorted by recursion; the
    sorted leftmost-smaller suffixes then induce all others.  A level whose
    names are too many to go through bucket by bucket is sorted by doubling.
    """
    if size > BUCKETS:
        return _double(s)
    n = len(s)
    smaller = _smaller(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if n == 1 or not len(lms):
        return np.array([n - 1], np.int64) if n == 1 else _double(s)
    order = _induce(s, size, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    names, count = _names(s, lms, sorted_lms)
    if count < len(lms):
        sorted_lms = lms[sort_suffixes(names, count)]
    return _induce(s, size, sorted_lms)


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one is."""
    n = len(s)
    differs = np.append(s[:-1] != s[1:], True)
    at = np.where(differs, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    less = np.append(s[:-1] < s[1:], True)
    return less[at]


def _split(values: np.ndarray, keys: np.ndarray, into: list[list]) -> None:
    """Append the values to the lists of their keys, in order."""
    if not len(values):
        return
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    for key, part in zip(keys[np.append(0, cut)].tolist(), np.split(values, cut)):
        into[key].append(part)


def _induce(s: np.ndarray, size: int, lms: np.ndarray) -> np.ndarray:
    """All suffixes from the leftmost-smaller ones, bucket by bucket: the larger ones upwards, the smaller ones downwards."""
    s = s.astype(np.uint16)  # stable sorts of 16 bits are radix sorts
    empty = np.empty(0, np.int64)
    given: list[list] = [[] for _ in range(size)]
    up: list[list] = [[] for _ in range(size)]
    down: list[list] = [[] for _ in range(size)]
    _split(lms, s[lms], given)
    large: list[np.ndarray] = []
    for c in range(size):
        wave = np.concatenate(up[c]) if up[c] else empty
        waves = []
        while len(wave):
            waves.append(wave)
            wave = wave[wave > 0] - 1
            wave = wave[s[wave] == c]
        here = np.concatenate(waves) if waves else empty
        large.append(here)
        source = np.concatenate([here, *given[c]])
        before = source[source > 0] - 1
        before = before[s[before] > c]
        _split(before, s[before], up)
    parts: list[np.ndarray] = []
    for c in range(size - 1, -1, -1):
        wave = np.concatenate(down[c]) if down[c] else empty
        if c == 0:
            wave = np.array([len(s) - 1], np.int64)  # the end mark
        waves = []
        while len(wave):
            waves.append(wave)
            wave = wave[wave > 0] - 1
            wave = wave[s[wave] == c]
        here = np.concatenate(waves) if waves else empty
        source = np.concatenate([here, large[c][::-1]])
        before = source[source > 0] - 1
        before = before[s[before] < c]
        _split(before, s[before], down)
        parts.append(source)
    return np.concatenate(parts)[::-1]


def _names(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the sorted leftmost-smaller substrings, equal ones alike, in text order; and how many there are."""
    length = np.zeros(len(s), np.int64)
    length[lms] = np.append(lms[1:], len(s) - 1) - lms
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    reach = length[a]
    d = 0
    while len(live):
        ok = s[a[live] + d] == s[b[live] + d]
        same[live[~ok]] = False
        live = live[ok]
        live = live[reach[live] > d]
        d += 1
    name = np.zeros(len(s), np.int64)
    name[order] = np.append(0, np.cumsum(~same))
    return name[lms], int(np.sum(~same)) + 1


def _double(s: np.ndarray) -> np.ndarray:
    """A suffix array by prefix doubling; a suffix that ends first is smaller."""
    rank = s.astype(np.int64) + 1
    step = 1
    while True:
        after = np.zeros_like(rank)
        after[: max(0, len(rank) - step)] = rank[step:]
        key = (rank << 32) | after
        order = np.argsort(key, kind="stable")
        new = np.append(True, key[order[1:]] != key[order[:-1]])
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(new)
        if new.all():
            return order
        step *= 2


def permuted_prefixes(data: np.ndarray, order: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position, the one before it in the suffix array (-1: none) and their common prefix, up to ``cap``.

    The common prefix at the next position is shorter by one at most, so it is
    computed at sparse positions first; those between begin where that leaves them.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    word = words_at(np.concatenate([data, np.zeros(cap + 80, np.uint8)]))
    common = np.zeros(n, np.int64)
    step = 32
    limit = cap + step
    todo = np.arange(0, n, step)
    while True:
        _extend(word, before, common, todo, limit, n)
        if step == 1:
            return before, np.minimum(common, cap)
        step //= 2
        todo = np.arange(step, n, 2 * step)
        common[todo] = np.maximum(0, common[todo - step] - step)


def _extend(word: np.ndarray, before: np.ndarray, common: np.ndarray, at: np.ndarray, limit: int, n: int) -> None:
    at = at[before[at] >= 0]
    other, have = before[at], common[at]
    while len(at):
        differs = word[np.minimum(at + have, len(word) - 1)] ^ word[np.minimum(other + have, len(word) - 1)]
        more = np.zeros(len(at), np.int64)
        for bits in range(56, -1, -8):
            more += differs < np.uint64(1 << bits)
        have += more
        common[at] = np.minimum(have, n - np.maximum(at, other))
        go = (more == 8) & (have < limit)
        at, other, have = at[go], other[go], have[go]
