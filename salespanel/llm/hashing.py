"""Stable 64-bit hashes of words, runs of words and runs of bytes, over many texts at once.

A byte is looked up in a table of random numbers; a run has the sum of its numbers times powers
of an odd base, modulo 2^64, which prefix sums give for every run in a few array operations.
Words of more than 64 bytes have a digest instead. Hashes are the same in every process. They
propose; where equality decides a result, texts or 128-bit digests do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

LONG_WORD = 64  # bytes
SLICE = 1 << 20  # bytes of text that are worked on at a time; a longer text is on its own
SPACES = b" \t\n\x0b\x0c\r"

_BYTES = np.frombuffer(hashlib.shake_128(b"salespanel").digest(2048), np.uint64)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.isin(np.arange(256), list(SPACES))
_powers: dict[int, np.ndarray] = {}


def _geometric(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64, at least n of them; grown by doubling and kept."""
    known = _powers.get(base)
    if known is None:
        known = np.ones(1, np.uint64)
    while len(known) < n:
        step = np.uint64(pow(base, len(known), 1 << 64))
        known = np.concatenate([known, known * step])
    _powers[base] = known
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def slices(texts: list[bytes | None], most: int = SLICE) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of together at most `most` bytes, each with the number of its first."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t or b"") + 1
        if size and size + n > most:
            yield lo, [x or b"" for x in texts[lo:i]]
            lo, size = i, 0
        size += n
    if size:
        yield lo, [x or b"" for x in texts[lo:]]


class Runs:
    """Hashes of runs of bytes in one buffer."""

    def __init__(self, buffer: np.ndarray):
        n = len(buffer)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[buffer] * _geometric(_BASE, n), out=self.sums[1:])
        self.inverse = _geometric(pow(_BASE, -1, 1 << 64), n + 1)

    def of(self, starts, ends) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


class Words:
    """The words (runs of anything but ASCII white space) of some texts: `starts` and `ends` in
    `buffer`, `text` (whose they are, in order), `first` (number of each text's first word, and
    the end), `hashes`."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        self.buffer = np.frombuffer(joined, np.uint8)
        space = _SPACE[self.buffer]
        turn = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            turn = np.concatenate([[0], turn])
        self.starts, self.ends = turn[0::2], turn[1::2]
        begins = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
        self.first = np.searchsorted(self.starts, begins)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hashes = Runs(self.buffer).of(self.starts, self.ends)
        # Sums modulo 2^64 meet for some long words under every base, so these have a digest.
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD):
            word = self.buffer[self.starts[i] : self.ends[i]].tobytes()
            self.hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on, over the ends of texts too."""
        h = self.hashes
        m = max(0, len(h) - n + 1)
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * _geometric(_BASE, len(h)), out=sums[1:])
        return mixed((sums[n : n + m] - sums[:m]) * _geometric(pow(_BASE, -1, 1 << 64), m))


def sliding_least(values: np.ndarray, width: int, most: int = 1 << 23) -> np.ndarray:
    """Place of the least value (the first of equals) in every `width` neighbours. Values are
    compared by their upper 40 bits; longer arrays go in parts, which makes no difference."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    if n > most:
        parts = (sliding_least(values[lo : lo + most + width - 1], width) + lo for lo in range(0, n, most))
        return np.concatenate(list(parts))
    low = np.uint64(0xFFFFFF)
    padded = np.full(-(-len(values) // width) * width, np.uint64(2**64 - 1))
    padded[: len(values)] = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    blocks = padded.reshape(-1, width)
    after = np.minimum.accumulate(blocks, axis=1).ravel()
    before = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(before[:n], after[width - 1 : width - 1 + n]) & low).astype(np.int64)


def anchor_runs(grams: np.ndarray, first: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, ...]:
    """Windows of `window` units of the texts that begin at `first`, by their anchors. A window's
    anchor is the least of the grams inside, so equal windows have equal anchors at equal
    places. For each run of windows of one text with one anchor: text, first and last window
    start (from the text's start), place of the anchor, its hash."""
    total = int(first[-1])
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = max(0, total - window + 1)
    starts = np.flatnonzero(of[:n] == of[window - 1 : window - 1 + n])
    if not len(starts):
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    at = sliding_least(grams, window - gram + 1)[starts]
    whose = of[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (whose[1:] != whose[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(starts)) - 1
    text = whose[lo]
    base = first[text]
    return text, starts[lo] - base, starts[hi] - base, at[lo] - base, grams[at[lo]]
