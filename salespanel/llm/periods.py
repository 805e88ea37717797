"""Periodic runs of words, by descending common prefixes.

A run is a stretch of consecutive words with smallest period q, at least `least` words and two
periods long, that no neighbouring word extends. Words are numbered anew in each document, so
suffixes of different documents have nothing in common and many documents go through the same
array operations. Suffixes are ordered by prefix doubling; only those that still have an equal
are sorted again, which in plain text are few after two rounds. The ranks of all rounds give the
common prefix of neighbours in that order.

Then, as in Kruskal's algorithm, neighbours are united by decreasing common prefix, in a
union-find whose classes are ordered sets of positions. If p and p' become neighbours in a set
at level l and d = p' - p <= l, the words from p to p' + l have period d, and no smaller one: a
smaller one would have put a position between them. Conversely, all places p of a run with
p + 2 q <= its end become a neighbour of p + q this way, at level end - q - p. So the seeds with
the same period and end make one run, which begins at the least of them. A run has a seed at
level max(least / 2, q) or more, so lower levels are never united.

Work on a document is n log n in its repeated part and stays in one task; documents do not meet,
so there is no shuffle and no hot key. Memory follows the longest document.

Nulls and texts without a word have no run. Equal texts are done one by one, as each row counts.
Empty tables give empty results; columns other than those read are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import to_columns, with_columns

LOAD = 1024  # positions in a part of an ordered set
KNOWN = 4  # words that positions must share to be looked at


@dataclass(frozen=True)
class Periodic:
    """`least`: words of the shortest run."""

    least: int = 12

    def __post_init__(self):
        if self.least < 2 * KNOWN:
            raise ValueError(f"runs of less than {2 * KNOWN} words are not looked for")


class Positions:
    """An ordered set of positions, in parts of bounded length."""

    __slots__ = ("parts", "heads", "size")

    def __init__(self, first: int):
        self.parts, self.heads, self.size = [[first]], [first], 1

    def __iter__(self):
        for part in self.parts:
            yield from part

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The positions before and after x, which is not in the set."""
        k = bisect_right(self.heads, x) - 1
        if k < 0:
            return None, self.heads[0]
        part = self.parts[k]
        i = bisect_right(part, x)
        if i < len(part):
            return part[i - 1], part[i]
        return part[-1], self.heads[k + 1] if k + 1 < len(self.heads) else None

    def add(self, x: int) -> None:
        k = max(0, bisect_right(self.heads, x) - 1)
        part = self.parts[k]
        part.insert(bisect_right(part, x), x)
        self.heads[k] = part[0]
        self.size += 1
        if len(part) > 2 * LOAD:
            self.parts.insert(k + 1, part[LOAD:])
            self.heads.insert(k + 1, part[LOAD])
            del part[LOAD:]


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, equal only for equal words of one text, each text
    followed by a mark of its own; and where the texts begin."""
    ids: list[int] = []
    first, base = [], 0
    for words in texts:
        first.append(len(ids))
        number: dict[bytes, int] = {}
        ids += [base + number.setdefault(w, len(number)) for w in words]
        base += len(number)
        ids.append(base)
        base += 1
    return np.array(ids, np.int64), np.array(first, np.int64)


def prefix_ranks(ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(k, rank) for k = 1, 2, 4, ... until all ranks differ: the place of each suffix in the
    order of the first k symbols, that of the first one for equals. Symbols are 0, 1, ..., and
    positions with equal prefixes are followed by another symbol."""
    n = len(ids)
    sizes = np.bincount(ids)
    rank = (np.cumsum(sizes) - sizes)[ids]
    left = np.argsort(rank, kind="stable")
    left = left[sizes[ids[left]] > 1]
    levels, k = [(1, rank.astype(np.int32))], 1
    while len(left):
        key = rank[left] * n + rank[left + k]
        order = np.argsort(key, kind="stable")
        left, key = left[order], key[order]
        group = rank[left]
        place = np.arange(len(left))
        new_group = np.append(True, group[1:] != group[:-1])
        new = np.append(True, key[1:] != key[:-1])
        of_group = np.maximum.accumulate(np.where(new_group, place, 0))
        start = np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy()
        rank[left] = group + start - of_group
        alone = new & np.append(new[1:], True)
        left = left[~alone]
        k *= 2
        levels.append((k, rank.astype(np.int32)))
    return levels


def common_prefixes(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How far the suffixes at a and b agree."""
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k, rank in reversed(levels):
        step = np.where(rank[a] == rank[b], k, 0)
        a += step
        b += step
        total += step
    return total


def seeds(left: list[int], right: list[int], level: list[int]) -> dict[tuple[int, int], int]:
    """(period, end) of runs, and their least place, from pairs of suffixes that are neighbours
    in their order, by decreasing common prefix."""
    parent: dict[int, int] = {}
    sets: dict[int, Positions] = {}
    found: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        if x not in parent:
            parent[x] = x
            sets[x] = Positions(x)
            return x
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def meet(p: int, q: int, l: int) -> None:
        if q - p <= l:
            run = (q - p, q + l)
            if p < found.get(run, p + 1):
                found[run] = p

    for x, y, l in zip(left, right, level):
        x, y = root(x), root(y)
        large, small = sets.pop(x), sets.pop(y)
        if large.size < small.size:
            large, small, x, y = small, large, y, x
        parent[y] = x
        sets[x] = large
        come = list(small)
        for i, p in enumerate(come):
            before, after = large.around(p)
            if before is not None and (i == 0 or come[i - 1] < before):
                meet(before, p, l)
            if after is not None and (i + 1 == len(come) or come[i + 1] > after):
                meet(p, after, l)
        for p in come:
            large.add(p)
    return found


def runs_of(texts: list[list[bytes]], like: Periodic = Periodic()) -> list[list[tuple[int, int, int]]]:
    """For each text (its words), the runs as (start, length, period), by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    ids, first = numbered(texts)
    if not len(ids):
        return out
    levels = prefix_ranks(ids)
    known = next((rank for k, rank in levels if k == KNOWN), None)
    if known is None:
        return out
    count = np.bincount(known, minlength=len(ids))
    places = np.flatnonzero(count[known] > 1)
    places = places[np.argsort(levels[-1][1][places], kind="stable")]
    a, b = places[:-1], places[1:]
    same = known[a] == known[b]
    a, b = a[same], b[same]
    level = common_prefixes(levels, a, b)
    order = np.argsort(-level, kind="stable")
    order = order[level[order] >= (like.least + 1) // 2]
    del levels
    for (period, end), start in seeds(a[order].tolist(), b[order].tolist(), level[order].tolist()).items():
        if end - start >= like.least:
            text = int(np.searchsorted(first, start, side="right")) - 1
            out[text].append((start - int(first[text]), end - start, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words some run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def longest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length; of equals that of smallest start, then period."""
    return min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)


def _words(batch: pa.RecordBatch) -> list[list[bytes]]:
    return [(t or "").encode().split() for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def collapse(docs: DataFrame, like: Periodic = Periodic()) -> DataFrame:
    """The documents with `runs` (start, length, period of each, in words); in texts with a run,
    words that a run repeats are left out and the others joined by one space. Other texts are
    as they were."""

    def one(batch: pa.RecordBatch) -> dict:
        words = _words(batch)
        runs = runs_of(words, like)
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        for i, (w, r) in enumerate(zip(words, runs)):
            if r:
                texts[i] = _left(w, r).decode()
        return {
            "text": texts,
            "runs": [[dict(zip(("start", "length", "period"), x)) for x in r] for r in runs],
        }

    order = [c for c in docs.columns if c != "runs"]
    made = with_columns(docs, one, "text string, runs array<struct<start:bigint,length:bigint,period:bigint>>")
    return made.select(*[f"`{c}`" for c in order], "runs")


def _left(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    gone = dropped(len(words), runs)
    return b" ".join([words[i] for i in np.flatnonzero(~gone)]) if runs else b" ".join(words)


def with_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document as the query's contract gives them a periodic end: for one in ten
    documents, told by a checksum of its number. A document without a number keeps its own."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def periodic_runs(docs: DataFrame, like: Periodic = Periodic()) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli (of the longest run, else null),
    runs_sha256, collapsed_sha256 of every document, with the contract's periodic ends."""

    def one(batch: pa.RecordBatch) -> dict:
        ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
        words = [with_period(w, i) for w, i in zip(_words(batch), ids)]
        runs = runs_of(words, like)
        best = [longest(r) for r in runs]
        listed = ["".join(f"{s},{n},{q}\n" for s, n, q in r).encode() for r in runs]
        return {
            "doc_id": ids,
            "n_runs": list(map(len, runs)),
            "start": [b and b[0] for b in best],
            "length": [b and b[1] for b in best],
            "period": [b and b[2] for b in best],
            "exponent_milli": [b and 1000 * b[1] // b[2] for b in best],
            "runs_sha256": [hashlib.sha256(x).hexdigest() for x in listed],
            "collapsed_sha256": [hashlib.sha256(_left(w, r)).hexdigest() for w, r in zip(words, runs)],
        }

    numbers = "n_runs long, start long, length long, period long, exponent_milli long"
    return to_columns(
        docs.selectExpr("cast(doc_id as long) doc_id", "text"), one,
        f"doc_id long, {numbers}, runs_sha256 string, collapsed_sha256 string",
    )
