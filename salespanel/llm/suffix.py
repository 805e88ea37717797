"""Removing repeated strings of bytes, found in suffix arrays built by induced sorting.

A window is `window` consecutive bytes of one document. Equal windows share their anchor, the
least of the `gram`-byte hashes inside. Runs of windows whose anchor occurs more than once are
cut into pieces by how far the anchor lies inside (steps of `step`); the bytes that all windows
of such a piece have in common, hashed with the anchor, name its group, so that equal windows
are in one group. A piece that is found more than once is repeated as a whole, and if it is the
only one of its group there is nothing left to ask. All other groups are dealt to shards. A
shard's distinct pieces are joined, each once and under an end mark of its own; the suffix array
and the permuted common prefixes of the shard then say which windows start a second time.

Shards are made as many as their bytes ask for, so no task sorts more than a few megabytes.
A group with very many different pieces (a common passage a little shorter than a window, with
different surroundings) is cut again into single windows, of which equal ones are one piece and
lone ones drop out. Texts that are equal as a whole are one class, worked on once. Bytes cross
the network only for pieces of shared groups, each different piece once.

Nulls are empty texts, texts shorter than a window lose nothing. Strings do not cross documents.
Every byte that a repeated window covers goes. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage
from .arrow import hand_back, to_columns, with_columns
from .hashing import Runs, anchor_runs, mixed, slices
from .induced import permuted_prefixes, suffix_array
from .repeats import by_key, digest_of, keyed, suspects

SHARD_BYTES = 1_500_000
MANY_PIECES = 2_000  # of one group, about a megabyte


@dataclass(frozen=True)
class Strings:
    """`window`: bytes that make a repeated string."""

    window: int = 400
    gram: int = 64
    step: int = 112


def _runs(texts: list[bytes], like: Strings):
    """For every slice of the texts: number of its first, its bytes, where its texts start in
    them, hashes of runs of bytes, and the anchor runs."""
    for at, part in slices(texts):
        buffer = np.frombuffer(b"".join(part), np.uint8)
        first = np.concatenate([[0], np.cumsum([len(t) for t in part])])
        if len(buffer) < like.window:
            continue
        hashes = Runs(buffer)
        ends = np.arange(like.gram, len(buffer) + 1)
        grams = hashes.of(ends - like.gram, ends)
        yield at, buffer, first, hashes, anchor_runs(grams, first, like.gram, like.window)


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def anchors(docs: DataFrame, like: Strings) -> DataFrame:
    """hash, key, lo, hi of every anchor run."""

    def one(batch: pa.RecordBatch) -> dict:
        keys = np.array(_column(batch, "key"), np.int64)
        out = [[np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]]
        for at, _, _, _, (text, lo, hi, _, found) in _runs([t.encode() for t in _column(batch, "text")], like):
            for column, values in zip(out, (found, keys[at + text], lo, hi)):
                column.append(values)
        found, key, lo, hi = map(np.concatenate, out)
        return {"hash": found.view(np.int64), "key": key, "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)}

    return to_columns(docs.select("text", "key"), one, "hash long, key long, lo int, hi int")


PIECES = "group long, piece binary, digest binary, lo int, hi int, copies long"


def _pieces(texts: DataFrame, like: Strings) -> DataFrame:
    """PIECES of the suspected runs: lo to hi are the window starts in a piece."""

    def one(batch: pa.RecordBatch) -> dict:
        raw, digests = [t.encode() for t in _column(batch, "text")], _column(batch, "digest")
        copies = _column(batch, "copies")
        wanted = [{r["lo"] for r in runs} for runs in _column(batch, "runs")]
        rows, names = [], [np.empty(0, np.uint64)]
        for at, buffer, first, hashes, (text, lo, hi, place, found) in _runs(raw, like):
            cores, steps, whose = [], [], []
            for i, (t, a, b, p) in enumerate(zip(text.tolist(), lo.tolist(), hi.tolist(), place.tolist())):
                if a not in wanted[at + t]:
                    continue
                base = int(first[t])
                for q in range((p - b) // like.step, (p - a) // like.step + 1):
                    x, y = max(a, p - q * like.step - like.step + 1), min(b, p - q * like.step)
                    body = buffer[base + x : base + y + like.window].tobytes()
                    rows.append((_stamp(body), digests[at + t], x, y, copies[at + t]))
                    cores.append(base + p - q * like.step)
                    steps.append(2 * q + 1)
                    whose.append(i)
            core = np.array(cores, np.int64)
            common = hashes.of(core, core + like.window - like.step + 1)
            names.append(mixed(found[np.array(whose, np.int64)] ^ common * np.array(steps, np.uint64)))
        return _piece_columns(np.concatenate(names), rows)

    return to_columns(texts, one, PIECES)


def _single_windows(texts: DataFrame, like: Strings) -> DataFrame:
    """PIECES of one window each, of texts with the `runs` to be cut so."""

    def one(batch: pa.RecordBatch) -> dict:
        rows = []
        columns = (_column(batch, c) for c in ("text", "digest", "copies", "runs"))
        for text, digest, copies, runs in zip(*columns):
            raw = text.encode()
            for start in sorted({x for r in runs for x in range(r["lo"], r["hi"] + 1)}):
                stamp = _stamp(raw[start : start + like.window])
                rows.append((stamp, digest, start, start, copies))
        names = np.frombuffer(b"".join(r[0] for r in rows), np.uint64)[0::2]
        return _piece_columns(names, rows)

    return to_columns(texts, one, PIECES)


def _stamp(body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=16).digest()


def _piece_columns(names: np.ndarray, rows: list[tuple]) -> dict:
    columns = list(zip(*rows)) if rows else [()] * 5
    return {"group": names.view(np.int64), **dict(zip(("piece", "digest", "lo", "hi", "copies"), columns))}


def _shared(pieces: DataFrame) -> DataFrame:
    """group, piece, found (how often), first (one place of it), kinds (different pieces of the
    group) in groups with two or more."""
    different = pieces.groupBy("group", "piece").agg(
        F.sum("copies").alias("found"), F.min(F.struct("digest", "lo", "hi")).alias("first")
    )
    several = different.groupBy("group").agg(F.sum("found").alias("n"), F.count("*").alias("kinds"))
    return different.join(several.filter("n > 1").drop("n"), "group")


def _repeated_starts(bodies: list[bytes], window: int) -> list[np.ndarray]:
    """For each piece, the starts of its windows that start a second time among the pieces."""
    parts, places, at = [], [], 0
    for mark, body in enumerate(bodies):
        places.append(at)
        parts += [np.frombuffer(body, np.uint8).astype(np.int64) + len(bodies), np.array([mark])]
        at += len(body) + 1
    joined = np.concatenate(parts)
    used = np.flatnonzero(np.bincount(joined))
    rank = np.empty(used[-1] + 1, np.int64)
    rank[used] = np.arange(len(used))
    joined = rank[joined]
    array = suffix_array(joined)
    before = permuted_prefixes(joined, array)
    longest = before.copy()
    longest[array[:-1]] = np.maximum(before[array[:-1]], before[array[1:]])
    long = longest >= window
    return [np.flatnonzero(long[p : p + len(b) - window + 1]) for p, b in zip(places, bodies)]


def _as_runs(starts: np.ndarray) -> list[dict]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [
        {"lo": int(a), "hi": int(b)}
        for a, b in zip(starts[np.concatenate([[0], cut + 1])], starts[np.append(cut, len(starts) - 1)])
    ]


def _whole(piece: Column) -> Column:
    """All windows of a piece, as one run."""
    return F.array(F.struct(F.lit(0).alias("lo"), (piece["hi"] - piece["lo"]).cast("int").alias("hi")))


def _sorted_shards(shared: DataFrame, texts: DataFrame, like: Strings) -> DataFrame:
    """group, piece, again: the runs of window starts in a piece that are repeated."""
    alone = shared.filter("kinds = 1").select("group", "piece", _whole(F.col("first")).alias("again"))
    shared = shared.filter("kinds > 1")
    size = shared.agg(F.sum(F.col("first.hi") - F.col("first.lo") + like.window)).first()[0] or 0
    shards = int(np.ceil(size / SHARD_BYTES)) or 1
    here = shared.select(
        F.col("first.digest").alias("digest"),
        F.struct("group", "piece", F.col("first.lo").alias("lo"), F.col("first.hi").alias("hi"), F.col("found")).alias("of"),
    ).groupBy("digest").agg(F.collect_list("of").alias("of"))

    def cut(batch: pa.RecordBatch) -> dict:
        rows = []
        for text, of in zip(_column(batch, "text"), _column(batch, "of")):
            raw = text.encode()
            for p in of:
                rows.append((p["group"] % shards, p["group"], p["piece"], p["found"] > 1, raw[p["lo"] : p["hi"] + like.window]))
        return dict(zip(("shard", "group", "piece", "twice", "body"), list(zip(*rows)) or [()] * 5))

    def sort(shard: pa.Table) -> pa.Table:
        bodies, twice = shard.column("body").to_pylist(), shard.column("twice").to_pylist()
        again = [
            [{"lo": 0, "hi": len(b) - like.window}] if whole else _as_runs(x)
            for b, whole, x in zip(bodies, twice, _repeated_starts(bodies, like.window))
        ]
        hand_back()
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        return pa.table({"group": shard.column("group"), "piece": shard.column("piece"), "again": pa.array(again, kind)})

    bodies = to_columns(
        texts.join(here, "digest").select("text", "of"), cut,
        "shard long, group long, piece binary, twice boolean, body binary",
    )
    made = bodies.groupBy("shard").applyInArrow(sort, "group long, piece binary, again array<struct<lo:int,hi:int>>")
    return made.unionByName(alone)


def repeated_strings(docs: DataFrame, like: Strings) -> tuple[DataFrame, DataFrame]:
    """The suspected texts (digest, copies, text), and digest, runs: the runs of window starts
    that are repeated. `docs` is what `keyed` gave."""
    every = cut_lineage(anchors(docs, like), "anchors")
    several = every.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    texts = suspects(docs, by_key(every.join(several, "hash").select("key", "lo", "hi")))
    pieces = cut_lineage(_pieces(texts, like), "pieces")
    hot = cut_lineage(
        _shared(pieces).groupBy("group").agg(F.count("*").alias("n")).filter(F.col("n") > MANY_PIECES).select("group"), "hot"
    )
    again = pieces.join(hot, "group", "left_semi").groupBy("digest").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))
    # A piece is stored once: the hot groups are few (each has a megabyte), so leaving them out costs no shuffle.
    singles = cut_lineage(_single_windows(texts.drop("runs").join(again, "digest"), like), "singles")
    pieces = pieces.join(hot, "group", "left_anti").unionByName(singles)
    shared = cut_lineage(_shared(pieces), "shared")
    found = _sorted_shards(shared, texts.select("digest", "text"), like).filter(F.size("again") > 0)
    runs = (
        pieces.select("group", "piece", "digest", "lo").join(found, ["group", "piece"])
        .groupBy("digest").agg(F.collect_list(
            F.transform("again", lambda r: F.struct((F.col("lo") + r["lo"]).alias("lo"), (F.col("lo") + r["hi"]).alias("hi")))
        ).alias("runs"))
        .select("digest", F.flatten("runs").alias("runs"))
    )
    return texts.drop("runs"), runs


def left_over(raw: bytes, runs: list[dict], window: int) -> tuple[bytes, int]:
    """The bytes that no window covers, and how many maximal runs go."""
    cover = np.zeros(len(raw) + 1, np.int64)
    np.add.at(cover, [r["lo"] for r in runs], 1)
    np.add.at(cover, [r["hi"] + window for r in runs], -1)
    gone = np.cumsum(cover[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), spans


def _stripped(docs: DataFrame, like: Strings) -> DataFrame:
    """digest, left (bytes), n_spans of the texts that lose some."""
    texts, runs = repeated_strings(docs, like)

    def one(batch: pa.RecordBatch) -> dict:
        done = [left_over(t.encode(), r, like.window) for t, r in zip(_column(batch, "text"), _column(batch, "runs"))]
        return dict(zip(("left", "n_spans"), zip(*done)))

    return with_columns(texts.join(runs, "digest").drop("copies"), one, "left binary, n_spans long", ("text", "runs"))


def removal(docs: DataFrame, like: Strings = Strings()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    own = keyed(docs)
    done = _stripped(own, like).select(
        "digest", F.length("left").alias("n_left"), "n_spans", F.sha2("left", 256).alias("sha")
    )
    rows = own.select(
        "doc_id", digest_of(F.col("text")).alias("digest"), F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("whole_sha"),
    )
    return rows.join(done, "digest", "left").select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.coalesce("n_left", "n_bytes")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("sha", "whole_sha").alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, like: Strings = Strings()) -> DataFrame:
    """The documents; a text that loses bytes has the others. Characters cut in half are
    replaced, as a text must be UTF-8."""
    done = _stripped(keyed(docs), like).select("digest", F.decode(F.col("left"), "UTF-8").alias("left"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), digest_of(F.col("text")).alias("digest"))
    return held.join(done, "digest", "left").select(*[
        (F.coalesce("left", F.col("row")[c]) if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns
    ])
