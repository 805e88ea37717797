"""Suffix arrays by induced sorting, and permuted common prefixes, in array operations.

Suffixes are of type L (larger than the next) or S (smaller). The leftmost S of each run is
sorted first: the substrings between them are sorted by inducing, get names, and where names
repeat the string of names is sorted the same way. Inducing again from their right order sorts
the rest. Both scans go over whole stretches of the array at a time: a stretch of buckets that
have all their entries can get no more, so what it induces can be placed at once; a bucket that
lacks entries gets them from itself, run by run. The work is linear.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True for suffixes of type S; the last is of type L, as the end is smaller than all."""
    n = len(s)
    differs = np.append(s[1:] != s[:-1], True)
    smaller = np.append(s[:-1] < s[1:], False)
    place = np.where(differs, np.arange(n), n)
    return smaller[np.minimum.accumulate(place[::-1])[::-1]]


class _Scan:
    """One direction of inducing. Downwards, everything is seen through mirrored symbols and
    slots, so that one procedure serves both."""

    def __init__(self, s, typed, sizes, heads, down: bool):
        self.s, self.down = s, down
        self.wanted = typed if down else ~typed
        self.room = np.bincount(s[self.wanted], minlength=len(sizes))
        self.got = np.zeros(len(sizes), np.int64)
        self.heads, self.sizes = heads, sizes

    def place(self, array: np.ndarray, entries: np.ndarray) -> None:
        """What precedes the entries, if of this scan's type, goes to its bucket in their order."""
        j = entries[entries > 0] - 1
        j = j[self.wanted[j]]
        if not len(j):
            return
        c = self.s[j]
        if len(j) == 1:
            at, one = self.got[c], c
            self.got[one] += 1
        else:
            order = np.argsort(c, kind="stable")
            j, c = j[order], c[order]
            first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            count = np.diff(np.append(first, len(c)))
            at = self.got[c] + np.arange(len(c)) - np.repeat(first, count)
            self.got[c[first]] += count
        array[self.heads[c + 1] - 1 - at if self.down else self.heads[c] + at] = j

    def _incomplete(self, b: int) -> int:
        """The first bucket from b on (in the scan's direction) that lacks entries, or the end."""
        step = 64
        k = len(self.sizes)
        while True:
            if self.down:
                lo = max(0, b - step + 1)
                lacks = np.flatnonzero(self.got[lo : b + 1] < self.room[lo : b + 1])
                if len(lacks):
                    return lo + int(lacks[-1])
                if lo == 0:
                    return -1
                b = lo - 1
            else:
                hi = min(k, b + step)
                lacks = np.flatnonzero(self.got[b:hi] < self.room[b:hi])
                if len(lacks):
                    return b + int(lacks[0])
                if hi == k:
                    return k
                b = hi
            step *= 2

    def run(self, array: np.ndarray) -> None:
        k = len(self.sizes)
        b, end = (k - 1, -1) if self.down else (0, k)
        heads = self.heads
        while b != end:
            stop = self._incomplete(b)
            if stop != b:  # a stretch of buckets that are complete
                part = array[heads[stop + 1] : heads[b + 1]][::-1] if self.down else array[heads[b] : heads[stop]]
                self.place(array, part)
                b = stop
                continue
            done = 0
            while (got := int(self.got[b])) > done:  # its own entries bring more of them
                lo, hi = (heads[b + 1] - got, heads[b + 1] - done) if self.down else (heads[b] + done, heads[b] + got)
                self.place(array, array[lo:hi][::-1].copy() if self.down else array[lo:hi].copy())
                done = got
            # and then the entries of the other type
            other = array[heads[b] : heads[b + 1] - done][::-1] if self.down else array[heads[b] + done : heads[b + 1]]
            self.place(array, other.copy())
            b += -1 if self.down else 1


def _induced(s, typed, sizes, heads, order) -> np.ndarray:
    """All suffixes from the leftmost S ones in `order`."""
    n = len(s)
    array = np.full(n, -1, np.int64)
    c = s[order]
    ranks = np.argsort(c, kind="stable")
    ranked = c[ranks]
    count = np.bincount(c, minlength=len(sizes))
    at = heads[ranked + 1] - count[ranked]
    before = np.concatenate([[0], np.cumsum(count)])[ranked]
    array[at + np.arange(len(ranks)) - before] = order[ranks]
    up = _Scan(s, typed, sizes, heads, down=False)
    up.place(array, np.array([n]))  # the end precedes everything
    up.run(array)
    large = np.bincount(s[~typed], minlength=len(sizes))
    slots = np.arange(n) - heads[np.repeat(np.arange(len(sizes)), sizes)]
    array[slots >= np.repeat(large, sizes)] = -1  # S entries are placed anew
    _Scan(s, typed, sizes, heads, down=True).run(array)
    return array


def _same(s: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the substrings of equal lengths at a and b are equal."""
    equal = np.ones(len(a), bool)
    left = np.arange(len(a))
    k = 0
    while len(left):
        same = s[a[left] + k] == s[b[left] + k]
        equal[left[~same]] = False
        k += 1
        left = left[same & (lengths[left] > k)]
    return equal


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of s in their order. Symbols are 0, 1, ... without large gaps."""
    s = s.astype(np.int64, copy=False)
    n = len(s)
    if n < 2:
        return np.arange(n)
    typed = _types(s)
    sizes = np.bincount(s)
    heads = np.concatenate([[0], np.cumsum(sizes)])
    first = np.flatnonzero(typed[1:] & ~typed[:-1]) + 1
    if not len(first):
        return _induced(s, typed, sizes, heads, first)
    sorted_all = _induced(s, typed, sizes, heads, first)
    marked = np.zeros(n, bool)
    marked[first] = True
    ranked = sorted_all[marked[sorted_all]]
    # a substring reaches to the next leftmost S, that included; the last one to the end
    reach = np.zeros(n, np.int64)
    reach[first] = np.append(np.diff(first) + 1, n - first[-1] + 1)
    a, b = ranked[:-1], ranked[1:]
    alike = (reach[a] == reach[b]) & (a != first[-1]) & (b != first[-1])
    where = np.flatnonzero(alike)
    alike[where] = _same(s, a[where], b[where], reach[a[where]])
    names = np.concatenate([[0], np.cumsum(~alike)])
    if names[-1] + 1 < len(ranked):
        name_of = np.empty(n, np.int64)
        name_of[ranked] = names
        ranked = first[suffix_array(name_of[first])]
    return _induced(s, typed, sizes, heads, ranked)


def permuted_prefixes(s: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For every position, how far its suffix agrees with the one before it in the array. Only
    positions whose left neighbours differ are compared; right of them it is one less each."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    left = np.full(n, True)
    inner = np.flatnonzero((before > 0) & (np.arange(n) > 0))
    left[inner] = s[inner - 1] != s[before[inner] - 1]
    start = np.flatnonzero(left)
    a, b = start, before[start]
    length = np.zeros(len(start), np.int64)
    active = np.flatnonzero(b >= 0)
    while len(active):
        p, q = a[active] + length[active], b[active] + length[active]
        inside = (p < n) & (q < n)
        active, p, q = active[inside], p[inside], q[inside]
        active = active[s[p] == s[q]]
        length[active] += 1
    which = np.maximum.accumulate(np.where(left, np.arange(n), 0))
    value = np.zeros(n, np.int64)
    value[start] = length
    return value[which] - (np.arange(n) - which)
