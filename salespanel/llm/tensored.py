"""Near-duplicates by MinHash with tensored banding.

A document's set holds its distinct runs of `words` words. Two collections of half keys are
made, each of `tables` keys of `rows` minhashes; a table key is a pair of one half key from
either, so tables^2 tables cost 2 * tables half keys. Documents whose similarity is at the
limit share a table key but with probability `miss`, which fixes `tables`. A half key that no
other set has is in no shared table key, so half keys that occur once are dropped before pairs
are formed; this loses nothing.

Equal sets are one class and take part once. In every bucket of a table the members are
compared with a leader on their full sets: first with a pseudo-random one, then with the one
that has most links. Links inside a component need no proof, so a group of thousands of copies
costs a comparison each and not one for each pair. Where a bucket still holds different
components, members can be linked only if they differ from the leader in the same elements:
if x and the leader are not linked, the differences of x and y to the leader share at least
one element, and more the farther x or y are. So an index of the rarest differences, as many as
the bounds leave (prefix filter), finds every pair that can be linked, and these are compared.
No bucket is capped. Sets are built again for classes in shared buckets only.

Words: A-Z in lower case, runs of anything but ASCII white space. A text with fewer words than
`words` has its whole sequence as the only element; a null or wordless text has an empty set,
which is linked with nothing. Rows with one doc_id are one document, whose links are those of
all its rows. Rows without a doc_id take no part: their component is null, they are kept. An
empty table gives an empty result. Sets are compared as 64-bit hashes of their elements.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage
from .arrow import to_columns, with_columns
from .hashing import Words, mixed, slices
from .links import components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Likeness:
    """Documents are linked from `percent` on. `words` in an element; `rows` minhashes in a
    half key; `miss`: chance to overlook two documents just at the limit."""

    words: int = 5
    percent: int = 80
    rows: int = 4
    miss: float = 1e-4
    seed: int = 0

    @property
    def tables(self) -> int:
        lone = 1 - (self.percent / 100) ** self.rows  # a half key is not shared
        return int(np.ceil(np.log(1 - np.sqrt(1 - self.miss)) / np.log(lone)))


def sets_of(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct element hashes of each text."""
    raw = [t.encode().translate(_LOWER) if t else b"" for t in texts]
    out: list[np.ndarray] = []
    for _, part in slices(raw):
        w = Words(part)
        grams = w.grams(words)
        for lo, hi in zip(w.first[:-1], w.first[1:]):
            if hi - lo >= words:
                out.append(np.unique(grams[lo : hi - words + 1]))
            elif hi > lo:
                few = hashlib.blake2b(w.hashes[lo:hi].tobytes(), digest_size=8).digest()
                out.append(np.frombuffer(few, np.uint64))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def half_keys(elements: np.ndarray, like: Likeness) -> np.ndarray:
    """2 * tables half keys of a set that is not empty; each knows its collection and place."""
    n = 2 * like.tables
    draw = np.frombuffer(hashlib.shake_128(f"minhash {like.seed}".encode()).digest(16 * n * like.rows), np.uint64)
    factor, add = draw[0::2] | np.uint64(1), draw[1::2]
    least = np.full(n * like.rows, 2**64 - 1, np.uint64)
    for lo in range(0, len(elements), 2048):  # bounded memory for very long texts
        part = elements[lo : lo + 2048, None] * factor + add
        np.minimum(least, mixed_high(part).min(axis=0), out=least)
    key = np.arange(n, dtype=np.uint64)
    for r in range(like.rows):
        key = mixed(key ^ least[r::like.rows])
    return key


def mixed_high(h: np.ndarray) -> np.ndarray:
    """The upper half, which all bits of the product have reached, on both sides."""
    return h ^ (h >> np.uint64(32))


def signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null if empty), halves."""

    def one(batch: pa.RecordBatch) -> dict:
        sets = sets_of(batch.column(batch.schema.get_field_index("text")).to_pylist(), like.words)
        return {
            "n_shingles": list(map(len, sets)),
            "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "halves": [half_keys(s, like).view(np.int64) if len(s) else None for s in sets],
        }

    return with_columns(
        docs.select("doc_id", "text"), one, "n_shingles long, digest binary, halves array<long>", ("text",)
    )


def _buckets(classes: DataFrame, tables: int) -> DataFrame:
    """table key, digest: the classes in buckets of two or more."""
    halves = classes.select("digest", F.posexplode("halves").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    left = (
        halves.join(shared, "half").groupBy("digest").agg(
            F.collect_list(F.when(F.col("place") < tables, F.col("half"))).alias("one"),
            F.collect_list(F.when(F.col("place") >= tables, F.col("half"))).alias("other"),
        )
    )
    keys = left.select("digest", "other", F.explode("one").alias("a")).select(
        "digest", "a", F.explode("other").alias("b")
    ).select("digest", F.xxhash64("a", "b").alias("bucket"))
    keys = cut_lineage(keys, "table-keys")
    full = keys.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    return cut_lineage(keys.join(full, "bucket"), "buckets")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, like: Likeness) -> DataFrame:
    """digest, elements (bytes of sorted hashes) of the wanted classes, each once."""
    ids = classes.join(wanted, "digest", "left_semi").select(F.col("rep").alias("doc_id")).distinct()

    def one(batch: pa.RecordBatch) -> dict:
        sets = sets_of(batch.column(0).to_pylist(), like.words)
        return {
            "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "elements": [s.tobytes() for s in sets],
        }

    texts = docs.join(ids, "doc_id", "left_semi").select("text")
    # A document with several texts has several sets; the digest says which is meant.
    made = to_columns(texts, one, "digest binary, elements binary").join(wanted, "digest", "left_semi")
    return cut_lineage(made.dropDuplicates(["digest"]), "sets")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough."""

    def one(batch: pa.RecordBatch) -> dict:
        x, y = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "y"))
        found = []
        for p, q in zip(x, y):
            p, q = np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            found.append(100 * both >= percent * (len(p) + len(q) - both))
        return {"linked": found}

    mine = sets.select(F.col("digest").alias("a"), F.col("elements").alias("x"))
    other = sets.select(F.col("digest").alias("b"), F.col("elements").alias("y"))
    small, large = F.least(F.length("x"), F.length("y")), F.greatest(F.length("x"), F.length("y"))
    both = pairs.join(mine, "a").join(other, "b").filter(100 * small >= percent * large)
    return with_columns(both, one, "linked boolean", ("x", "y")).filter("linked").select("a", "b")


def _led(members: DataFrame, order, oriented: bool = False) -> DataFrame:
    """Pairs of each bucket's members with the one that is last in `order`: (a, b), or
    (digest, leader)."""
    lead = members.groupBy("bucket").agg(F.max(F.struct(order.alias("order"), "digest")).alias("lead"))
    pairs = members.join(lead.select("bucket", F.col("lead.digest").alias("leader")), "bucket").filter("digest <> leader")
    if oriented:
        return pairs.select("digest", "leader")
    return pairs.select(F.least("digest", "leader").alias("a"), F.greatest("digest", "leader").alias("b"))


def _differences(led: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """digest, leader, size, gap, near (linked with the leader), apart: the elements that only
    one of digest and leader holds, as an array; `led` has each pair once."""

    def one(batch: pa.RecordBatch) -> dict:
        x, y = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "y"))
        out = {"size": [], "gap": [], "near": [], "apart": []}
        for p, q in zip(x, y):
            p, q = np.frombuffer(p.as_py(), np.uint64), np.frombuffer(q.as_py(), np.uint64)
            apart = np.setxor1d(p, q, assume_unique=True)
            union = (len(p) + len(q) + len(apart)) // 2
            out["size"].append(len(p))
            out["gap"].append(len(q) - len(p))
            out["near"].append(100 * (union - len(apart)) >= percent * union)
            out["apart"].append(apart.view(np.int64))
        return out

    mine = sets.select("digest", F.col("elements").alias("x"))
    lead = sets.select(F.col("digest").alias("leader"), F.col("elements").alias("y"))
    return with_columns(
        led.join(mine, "digest").join(lead, "leader"), one,
        "size long, gap long, near boolean, apart array<long>", ("x", "y"),
    )


def _possible(apart: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that differ alike enough from a common leader.

    With t for the limit and k = (1 - t) / (1 + t), linked x and y differ in at most
    k (|x| + |y|) elements, which is at most |x| (1 - t) / t. So all but that many of x's
    differences are y's too; and if x is not linked with the leader, more than half of
    |differences of y| + k (|leader| - |y|) are shared. Of n differences of which s must be
    shared, one is among the n - s + 1 rarest on either side. Lengths and places leave out pairs
    that differ too much anyway."""
    t = percent / 100
    k = (1 - t) / (1 + t)
    n = F.size("apart")
    far = F.floor(F.col("size") * ((1 - t) / t) + 1e-9) + 1
    half = n - F.floor(F.greatest(F.lit(0.0), (n + k * F.col("gap")) / 2)) + 1
    head = F.least(n, F.when(F.col("near"), F.least(half, far)).otherwise(far)).cast("int")
    whole = cut_lineage(
        apart.join(roots.withColumnRenamed("key", "digest"), "digest", "left").select(
            "leader", "digest", F.coalesce("root", "digest").alias("root"), "size", "near", "apart",
            n.alias("n"), head.alias("head"),
        ),
        "differences",
    )
    each = whole.select("leader", "digest", F.explode("apart").alias("element"))
    often = each.groupBy("leader", "element").agg(F.count("*").alias("often")).filter("often > 1")
    # an element that nobody shares takes a place among the rarest but finds nothing
    shared = each.join(often, ["leader", "element"]).groupBy("leader", "digest").agg(
        F.sort_array(F.collect_list(F.struct("often", "element"))).alias("known")
    )
    heads = whole.drop("apart").join(shared, ["leader", "digest"]).withColumn(
        "left", F.col("head") - (F.col("n") - F.size("known"))
    ).filter("left > 0")
    index = heads.select(
        "leader", "digest", "root", "size", "near", "n", (F.col("n") - F.size("known")).alias("lone"),
        F.posexplode(F.slice("known", 1, F.col("left"))).alias("p", "e"),
    ).withColumns({"element": F.col("e.element"), "place": F.col("lone") + F.col("p")}).drop("e", "p", "lone")
    index = cut_lineage(index, "index")
    one = index.filter("NOT near").select("leader", "element", *[F.col(c).alias(f"{c}1") for c in ("digest", "root", "size", "n", "place")])
    two = index.select("leader", "element", *[F.col(c).alias(f"{c}2") for c in ("digest", "root", "size", "n", "near", "place")])
    most = k * (F.col("size1") + F.col("size2")) + 1e-9
    alike = (F.col("n1") + F.col("n2") - most) / 2  # so many differences are shared
    pairs = one.join(two, ["leader", "element"]).filter(
        (F.col("root1") != F.col("root2")) & (F.col("near2") | (F.col("digest1") < F.col("digest2")))
        & (F.abs(F.col("n1") - F.col("n2")) <= most)
        # the rarest shared one has that many shared ones from it on
        & (F.col("place1") <= F.col("n1") - alike) & (F.col("place2") <= F.col("n2") - alike)
    )
    return pairs.select(F.least("digest1", "digest2").alias("a"), F.greatest("digest1", "digest2").alias("b")).distinct()


def links(docs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """Verified links (a, b) between classes that connect whatever is connected."""
    buckets = _buckets(classes, like.tables)
    sets = _sets(docs, classes, buckets.select("digest").distinct(), like)
    first = cut_lineage(_led(buckets, F.xxhash64("digest")).distinct(), "pairs")
    found = cut_lineage(_linked(first, sets, like.percent), "linked")

    roots = cut_lineage(components(found), "roots")
    degree = (
        found.select(F.col("a").alias("digest")).union(found.select("b")).groupBy("digest")
        .agg(F.count("*").alias("degree"))
    )
    known = cut_lineage(
        buckets.join(roots.withColumnRenamed("key", "digest"), "digest", "left").join(degree, "digest", "left").select(
            "bucket", "digest", F.coalesce("root", "digest").alias("root"), F.coalesce("degree", F.lit(0)).alias("degree")
        ),
        "members",
    )
    several = known.groupBy("bucket").agg(F.min("root").alias("p"), F.max("root").alias("q")).filter("p <> q")
    divided = known.join(several.select("bucket"), "bucket").select("bucket", "digest", "degree")
    second = cut_lineage(_led(divided, F.struct("degree", F.xxhash64("digest")), oriented=True).distinct(), "pairs")
    apart = cut_lineage(_differences(second, sets, like.percent), "apart")
    found = found.union(apart.filter("near").select(F.col("digest").alias("a"), F.col("leader").alias("b")))

    roots = cut_lineage(components(found), "roots")
    pairs = cut_lineage(_possible(apart, roots, like.percent), "pairs")
    return found.union(cut_lineage(_linked(pairs, sets, like.percent), "linked"))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    rows = cut_lineage(signatures(docs, like), "signatures")
    classes = cut_lineage(
        rows.filter("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("halves").alias("halves")
        ),
        "classes",
    )
    found = links(docs, classes, like)
    own = rows.filter("doc_id IS NOT NULL").select("doc_id", "digest").join(classes.select("digest", "rep"), "digest", "left")
    # Rows of one document tie their classes together.
    tied = own.filter("digest IS NOT NULL").groupBy("doc_id").agg(
        F.min("digest").alias("a"), F.max("digest").alias("z"), F.collect_set("digest").alias("all")
    ).filter("a <> z").select("a", F.explode("all").alias("b"))
    roots = cut_lineage(components(found.union(tied)), "roots")
    least = (
        roots.join(classes.select(F.col("digest").alias("key"), "rep"), "key")
        .groupBy("root").agg(F.min("rep").alias("least"))
    )
    heads = roots.join(least, "root").select(F.col("key").alias("digest"), "least")
    of_class = classes.select("digest", "rep").join(heads, "digest", "left").select(
        "digest", F.coalesce("least", "rep").alias("head")
    )
    placed = rows.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("head", "doc_id"))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The documents without near-duplicates: of every group the one with the least doc_id
    stays, once. Rows without a doc_id stay."""
    ids = near_duplicates(docs, like).filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    held = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").alias("of"))
    mine = held.join(ids, F.col("of") == F.col("doc_id"))
    single = mine.filter("n = 1").select("row")
    # min_by sums before the shuffle, so a document that is repeated very often is no hot spot
    several = mine.filter("n > 1").groupBy("of").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return single.union(several).union(held.filter("of IS NULL").select("row")).select("row.*")
