"""Suffix arrays of one shard in numpy: Larsson-Sadakane refinement, Kasai common prefixes, binary search."""

from __future__ import annotations

import numpy as np

PAD = 16


def words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a big-endian integer; zeros follow the text."""
    out = np.zeros(len(data) + PAD, np.uint64)
    wide = np.zeros(len(data) + PAD + 8, np.uint64)
    wide[: len(data)] = data
    for i in range(8):
        out |= wide[i : i + len(out)] << np.uint64(56 - 8 * i)
    return out


def suffix_array(keys: np.ndarray, n: int) -> np.ndarray:
    """Sort by the first eight bytes, then double the compared length; only groups that are still
    equal are sorted again, by the rank of what follows."""
    sa = np.argsort(keys[:n])
    first = np.empty(n, bool)
    first[:1] = True
    first[1:] = keys[sa[1:]] != keys[sa[:-1]]
    rank = np.zeros(n + 1, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    open_ = np.flatnonzero(~(first & np.append(first[1:], True)))
    h = 8
    while len(open_):
        s = sa[open_]
        key = (rank[s] << 32) | np.where(s + h < n, rank[np.minimum(s + h, n)] + n, n - s)  # what ends first comes first
        by = np.argsort(key)
        s, key = s[by], key[by]
        sa[open_] = s
        new = np.append(True, key[1:] != key[:-1])
        rank[s] = open_[np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))] + 1
        open_ = open_[~(new & np.append(new[1:], True))]
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, keys: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in sa. In text order it falls by
    one at most (Kasai), and by exactly one where the bytes before the two are equal; the others are compared."""
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    has = before >= 0
    fresh = ~has | (place == 0) | (before <= 0)
    other = ~fresh
    fresh[other] = data[place[other] - 1] != data[before[other] - 1]
    length = np.zeros(n, np.int64)
    i = np.flatnonzero(fresh & has)
    j, at = before[i], np.zeros(len(i), np.int64)
    steps = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)
    while len(i):
        end = n - np.maximum(i, j)
        differ = keys[i + at] ^ keys[j + at]
        same = (differ == 0) & (at + 8 < end)
        done = ~same
        length[i[done]] = np.minimum(at[done] + np.where(differ[done] == 0, 8, 7 - np.searchsorted(steps, differ[done], "right")), end[done])
        i, j, at = i[same], j[same], at[same] + 8
    last = np.maximum.accumulate(np.where(fresh, place, 0))
    return (length[last] - (place - last))[sa]


def compare(keys_a: np.ndarray, a: np.ndarray, keys_b: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """-1, 0 or 1: the strings of `size` bytes at a against those at b."""
    out = np.zeros(len(a), np.int8)
    left = np.arange(len(a))
    for at in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        x, y = keys_a[a[left] + at], keys_b[b[left] + at]
        differ = x != y
        out[left[differ]] = np.where(x[differ] < y[differ], -1, 1)
        left = left[~differ]
        if not len(left):
            break
    return out


def find(keys: np.ndarray, places: np.ndarray, keys_of: np.ndarray, wanted: np.ndarray, size: int) -> np.ndarray:
    """Index in places, sorted by their strings of `size` bytes, of the string at each wanted place; -1: none."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(places), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        mid = (low[open_] + high[open_]) // 2
        less = compare(keys, places[mid], keys_of, wanted[open_], size) < 0
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]
    found = np.full(len(wanted), -1, np.int64)
    inner = np.flatnonzero(low < len(places))
    equal = compare(keys, places[low[inner]], keys_of, wanted[inner], size) == 0
    found[inner[equal]] = low[inner[equal]]
    return found
