"""Removing repeated passages of words, with a count-min prefilter.

A window is `window` consecutive words of one document. It is counted by its anchor, the least
of the `gram`-word hashes inside: equal windows have equal anchors, and neighbours mostly share
one, so a sketch has about one entry for a dozen words. Every partition fills a sketch of its
own; the sketches are merged, block by block, into counts that are never too small. A block is
of fixed size and their number follows the input, so the sketch is as sharp on a large table
as on a small one and no task holds more than a block. A second pass asks the merged blocks
about its anchors; only windows whose anchor is estimated to occur twice are grouped exactly,
by 128-bit digests of their words, each distinct text once with its number of copies. No
repeated window is lost: all its occurrences have the same anchor, which is counted twice.

An anchor that a partition has seen twice itself need not be asked about and is not sent, so
what a block gets of a hot anchor is one entry per partition.

Words: runs of anything but ASCII white space. Nulls have no words. Windows do not cross
documents; those of a document that is repeated as a whole are all repeated. Every word that a
repeated window covers goes. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage
from .arrow import hand_back, parts, to_columns, with_columns
from .hashing import Words, anchor_runs, mixed, slices
from .repeats import by_key, digest_of, keyed, suspects

ROWS = 3
CELL_BITS = 19  # cells in each row of a block
CELLS = 1 << CELL_BITS
CELLS_PER_ANCHOR = 12  # a lone anchor looks repeated once in two thousand times
FLUSH = 1_000_000  # anchors that a task gathers before it hands them on


@dataclass(frozen=True)
class Passage:
    """`window`: words that make a passage. `gram`: words whose hashes are compared for anchors."""

    window: int = 35
    gram: int = 10

    @property
    def asked(self) -> np.dtype:
        """An anchor as it is kept. `more`, the windows after the first of its run, is at most
        `window` - `gram`."""
        more = "u1" if self.window - self.gram < 256 else "<i4"
        return np.dtype([("hash", "<u8"), ("key", "<i8"), ("lo", "<i4"), ("more", more)])


def _cells(hashes: np.ndarray) -> list[np.ndarray]:
    """A hash's cells in the rows, one row after the other."""
    low = np.uint64(CELLS - 1)
    return [
        ((hashes >> np.uint64(r * CELL_BITS)) & low).astype(np.int64) + r * CELLS for r in range(ROWS)
    ]


def _blocks(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(hashes ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(blocks)).astype(np.int64)


def _anchors(batch: pa.RecordBatch, like: Passage) -> np.ndarray:
    """Hash, key and windows of every anchor in a batch of (text, key)."""
    texts = [t.encode() for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
    keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
    out = [np.empty(0, like.asked)]
    for at, part in slices(texts):
        words = Words(part)
        text, lo, hi, _, hashes = anchor_runs(words.grams(like.gram), words.first, like.gram, like.window)
        found = np.empty(len(text), like.asked)
        found["hash"], found["key"], found["lo"], found["more"] = hashes, keys[at + text], lo, hi - lo
        out.append(found)
    return np.concatenate(out)


def _gathered(batches, like: Passage):
    """Anchors of several batches, up to FLUSH or a bit more at a time."""
    held, size = [], 0
    for batch in (part for whole in batches for part in parts(whole)):
        found = _anchors(batch, like)
        held.append(found)
        size += len(found)
        if size >= FLUSH:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)
    held.clear()
    hand_back()


def _split(order: np.ndarray, block: np.ndarray):
    """(block, places) in the order of blocks."""
    ranked = block[order]
    cuts = np.flatnonzero(np.diff(ranked)) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(block[places[0]]), places


def sketch(docs: DataFrame, like: Passage, blocks: int) -> DataFrame:
    """block, bits: which cells are reached at least twice, as a stored table."""

    def fill(batches):
        for found in _gathered(batches, like):
            block = _blocks(found["hash"], blocks)
            rows = []
            for b, places in _split(np.argsort(block, kind="stable"), block):
                entries = []
                for cells in _cells(found["hash"][places]):
                    cell, n = np.unique(cells, return_counts=True)
                    entries.append(cell.astype(np.uint32) | ((n > 1).astype(np.uint32) << np.uint32(31)))
                rows.append((b, np.concatenate(entries).tobytes()))
            numbers, parts = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())], ["block", "part"])

    def merge(parts: pa.Table) -> pa.Table:
        counts = np.zeros(ROWS * CELLS, np.uint8)
        for part in parts.column("part"):
            entries = np.frombuffer(part.as_py(), np.uint32)
            cells = entries & np.uint32(2**31 - 1)  # each once in a partition's sketch
            counts[cells] = np.minimum(2, counts[cells] + 1 + (entries >> np.uint32(31)).astype(np.uint8))
        return pa.table({
            "block": pa.array([parts.column("block")[0].as_py()], pa.int32()),
            "bits": pa.array([np.packbits(counts > 1).tobytes()], pa.binary()),
        })

    parts = docs.select("text", "key").mapInArrow(fill, "block int, part binary")
    return cut_lineage(parts.groupBy("block").applyInArrow(merge, "block int, bits binary"), "sketch")


def estimated(docs: DataFrame, like: Passage, merged: DataFrame, blocks: int) -> DataFrame:
    """key, lo, hi: runs of windows whose anchor the sketch estimates to occur twice."""

    def ask(batches):
        for found in _gathered(batches, like):
            _, back, n = np.unique(found["hash"], return_inverse=True, return_counts=True)
            sure = n[back] > 1
            block = _blocks(found["hash"], blocks)
            rows = [(b, False, found[p].tobytes()) for b, p in _split(_ordered(~sure, block), block)]
            dealt = _dealt(found, blocks)  # what is known already goes along with any block
            rows += [(b, True, found[p].tobytes()) for b, p in _split(_ordered(sure, dealt), dealt)]
            numbers, known, parts = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(known, pa.bool_()), pa.array(parts, pa.binary())],
                ["block", "known", "part"],
            )

    def answer(parts: pa.Table, own: pa.Table) -> pa.Table:
        bits = np.unpackbits(np.frombuffer(own.column("bits")[0].as_py(), np.uint8)) if own.num_rows else None
        out = [np.empty(0, like.asked)]
        for part, known in zip(parts.column("part"), parts.column("known")):
            found = np.frombuffer(part.as_py(), like.asked)
            if not known.as_py():
                found = found[np.all([bits[c] for c in _cells(found["hash"])], axis=0)]
            out.append(found)
        found = np.concatenate(out)
        lo = found["lo"].astype(np.int32)
        return pa.table({"key": found["key"].astype(np.int64), "lo": lo, "hi": lo + found["more"].astype(np.int32)})

    asked = docs.select("text", "key").mapInArrow(ask, "block int, known boolean, part binary")
    return asked.groupBy("block").cogroup(merged.groupBy("block")).applyInArrow(answer, "key long, lo int, hi int")


def _ordered(which: np.ndarray, block: np.ndarray) -> np.ndarray:
    places = np.flatnonzero(which)
    return places[np.argsort(block[places], kind="stable")]


def _dealt(found: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(found["key"].view(np.uint64) ^ found["lo"].astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def _windows(texts: DataFrame, like: Passage) -> DataFrame:
    """one, two (the halves of a digest of a suspected window's words), digest, start, copies."""

    def one(batch: pa.RecordBatch) -> dict:
        column = {n: batch.column(batch.schema.get_field_index(n)) for n in ("digest", "copies", "text", "runs")}
        raw = [t.encode() for t in column["text"].to_pylist()]
        digests, copies = column["digest"].to_pylist(), column["copies"].to_pylist()
        out = {"one": [], "two": [], "digest": [], "start": [], "copies": []}
        for i, text in enumerate(raw):
            words = text.split()
            starts = run_starts(column["runs"][i].as_py(), len(words) - like.window + 1)
            stamps = np.frombuffer(_stamps(words, starts, like.window), np.int64).reshape(-1, 2)
            out["one"].append(stamps[:, 0])
            out["two"].append(stamps[:, 1])
            out["start"].append(starts)
            out["digest"] += [digests[i]] * len(starts)
            out["copies"] += [copies[i]] * len(starts)
        for name in ("one", "two", "start"):
            out[name] = np.concatenate([np.empty(0, np.int64), *out[name]])
        return out

    return to_columns(texts, one, "one long, two long, digest binary, start long, copies long")


def _stamps(words: list[bytes], starts: np.ndarray, window: int) -> bytes:
    """16 bytes for each window: a digest of its words, which have no spaces, joined by one."""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    begins = (ends - [len(w) + 1 for w in words])[starts].tolist()
    return b"".join(
        hashlib.blake2b(joined[lo:hi], digest_size=16).digest()
        for lo, hi in zip(begins, (ends[starts + window - 1] - 1).tolist())
    )


def run_starts(runs: list[dict], end: int) -> np.ndarray:
    """The window starts in some runs, each once, in order, and below `end`."""
    if end <= 0 or not runs:
        return np.empty(0, np.int64)
    marks = np.zeros(end + 1, np.int64)
    for r in runs:
        if r["lo"] < end:
            marks[r["lo"]] += 1
            marks[min(end, r["hi"] + 1)] -= 1
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def repeated_windows(docs: DataFrame, like: Passage) -> tuple[DataFrame, DataFrame]:
    """The suspected texts (digest, copies, text), and digest, starts: where their repeated
    windows start. `docs` is what `keyed` gave."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    anchors = size / 6 * 2 / (like.window - like.gram + 2)  # a word has six bytes or so
    blocks = max(1, int(np.ceil(anchors * CELLS_PER_ANCHOR / CELLS)))
    merged = sketch(docs, like, blocks)
    texts = suspects(docs, by_key(estimated(docs, like, merged, blocks)))
    windows = _windows(texts, like)
    twice = windows.groupBy("one", "two").agg(F.sum("copies").alias("n")).filter("n > 1").select("one", "two")
    starts = windows.join(twice, ["one", "two"]).groupBy("digest").agg(F.collect_list("start").alias("starts"))
    return texts.drop("runs"), starts


def _kept(words: list[bytes], starts: list[int], window: int) -> list[bytes]:
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.asarray(starts)
    cover[at] += 1  # each start once
    cover[at + window] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]


def _stripped(docs: DataFrame, like: Passage) -> DataFrame:
    """digest, left (the words that stay, joined by one space), n_left of texts that lose some."""
    texts, starts = repeated_windows(docs, like)

    def one(batch: pa.RecordBatch) -> dict:
        text, at = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "starts"))
        left = [_kept(t.as_py().encode().split(), s.as_py(), like.window) for t, s in zip(text, at)]
        return {"left": [b" ".join(x).decode() for x in left], "n_left": list(map(len, left))}

    return with_columns(texts.join(starts, "digest").drop("copies"), one, "left string, n_left long", ("text", "starts"))


def removal(docs: DataFrame, like: Passage = Passage()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    own = keyed(docs)
    done = _stripped(own, like).select("digest", "n_left", F.sha2("left", 256).alias("sha"))

    def one(batch: pa.RecordBatch) -> dict:
        words = [t.as_py().encode().split() for t in batch.column(batch.schema.get_field_index("text"))]
        return {
            "n_words": list(map(len, words)),
            "whole_sha": [hashlib.sha256(b" ".join(w)).hexdigest() for w in words],
        }

    rows = with_columns(
        own.select("doc_id", "text", digest_of(F.col("text")).alias("digest")), one,
        "n_words long, whole_sha string", ("text",),
    )
    return rows.join(done, "digest", "left").select(
        "doc_id", "n_words", (F.col("n_words") - F.coalesce("n_left", "n_words")).alias("n_removed"),
        F.coalesce("sha", "whole_sha").alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, like: Passage = Passage()) -> DataFrame:
    """The documents; a text that loses words has the others, joined by one space."""
    done = _stripped(keyed(docs), like).select("digest", "left")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), digest_of(F.col("text")).alias("digest"))
    return held.join(done, "digest", "left").select(*[
        (F.coalesce("left", F.col("row")[c]) if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns
    ])
