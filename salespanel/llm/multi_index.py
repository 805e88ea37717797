"""Nearest neighbours by inner product, with an inverted multi-index.

Vectors are cut in two halves, and each half has its own codebook of `centroids`, fitted by
k-means on a bounded sample (at most `sample` rows and 4 million numbers, those with the least
hashes). Every row is then quantised; a pair of centroids is a cell, so k centroids for a half
make k^2 cells. k grows with the root of the rows until it reaches `centroids`.

For a query a centroid has a nearness: its half's inner product with it, and what entries around
the centroid may add (`reach`: so many times their root mean square in any direction, measured
over all rows; `exact`: at most the largest residual). The nearness of a cell is the sum of two.
A heap walks the cells by falling sums, as in the multi-sequence algorithm, until `first`
entries per wanted neighbour are gathered. These are reranked by their full inner products; the
worst of the neighbours so found is a floor. The walk then goes on through all cells that reach
the floor, however many they are, and what lies in them is reranked. With `exact` no cell
that is left out can hold a neighbour. Nothing else ends the walk: there is no cap on cells,
entries or queries.

Entries are dealt to blocks of neighbouring cells, of at most `block` rows; a cell with more has
several blocks. A query is sent only to blocks that hold a cell of its walk. A task holds one
block and streams the queries past it, so neither a hot cell nor many queries fill a task. Per
block and query at most the wanted number come back, and only those above the floor.

Left out: rows without vec_id, and vectors that are null, empty, zero, hold null or non-finite
components, or are of another length than the commonest. Ties go to the smaller vec_id. Rows
with one vec_id are entries of their own, none of them a neighbour of a query with this
vec_id; equal query rows are one query. Empty tables give empty results.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..params import cut_lineage
from .arrow import map_batches, parts, to_columns, with_columns
from .jacobi import _matrix, usable

MARGIN = 1e-12  # of |q| |v|: more than rounding may do to an inner product
SLICE = 256  # queries that are worked on at a time


@dataclass(frozen=True)
class MultiIndex:
    neighbours: int = 20
    centroids: int = 256
    per_cell: int = 50
    sample: int = 20_000
    first: int = 50
    reach: float = 2.6
    exact: bool = False
    block: int = 65_536
    blocks: int = 16
    rounds: int = 12


def k_means(points: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """At most k centroids of some points (Lloyd), from different ones of them."""
    start = np.unique(points, axis=0)
    centroids = start[np.random.default_rng(0).permutation(len(start))[:k]]
    for _ in range(rounds):
        own = nearest(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centroids))
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The number of the closest centroid of each point."""
    return ((centroids**2).sum(axis=1) - 2 * points @ centroids.T).argmin(axis=1)


@dataclass
class Books:
    """Centroids and reach of both halves, rows per cell, and where cells lie: the first of
    their blocks and how many they have. Its size is bounded by centroids, not by rows."""

    cut: int
    centroids: tuple[np.ndarray, np.ndarray]
    reach: tuple[np.ndarray, np.ndarray] | None = None
    count: np.ndarray | None = None
    start: np.ndarray | None = None
    split: np.ndarray | None = None
    longest: float = 0.0

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Cell of each vector, and its squared distance from the centroid in either half."""
        own, far = [], []
        for half, book in zip((x[:, : self.cut], x[:, self.cut :]), self.centroids):
            n = nearest(half, book)
            own.append(n)
            far.append(((half - book[n]) ** 2).sum(axis=1))
        return own[0] * len(self.centroids[1]) + own[1], far

    def nearness(self, q: np.ndarray) -> list[np.ndarray]:
        """For queries and centroids of either half, the most that entries there may score."""
        halves = (q[:, : self.cut], q[:, self.cut :])
        return [
            half @ book.T + np.linalg.norm(half, axis=1)[:, None] * reach
            for half, book, reach in zip(halves, self.centroids, self.reach)
        ]

    def margin(self, q: np.ndarray) -> np.ndarray:
        return MARGIN * self.longest * np.linalg.norm(q, axis=1)


def walk(one: np.ndarray, two: np.ndarray, count: np.ndarray, enough: int) -> float:
    """The sum of the last pair when pairs are taken by falling sums of their two numbers until
    their cells hold enough rows."""
    a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    x, y = one[a].tolist(), two[b].tolist()
    grid = count.reshape(len(one), len(two))
    heap, taken, held, last = [(-(x[0] + y[0]), 0, 0)], set(), 0, np.inf
    while heap and held < enough:
        low, i, j = heapq.heappop(heap)
        taken.add((i, j))
        held += grid[a[i], b[j]]
        last = -low
        if i + 1 < len(x) and (j == 0 or (i + 1, j - 1) in taken):
            heapq.heappush(heap, (-(x[i + 1] + y[j]), i + 1, j))
        if j + 1 < len(y) and (i == 0 or (i - 1, j + 1) in taken):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
    return last


def fit(rows: DataFrame, dim: int, n: int, like: MultiIndex) -> Books:
    """Codebooks from the sample."""
    most = max(1, min(like.sample, 4_000_000 // dim))
    picked = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(most).select("vector").toArrow()
    points = picked.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, dim)
    k = int(min(like.centroids, max(1, round((n / like.per_cell) ** 0.5))))
    cut = (dim + 1) // 2
    return Books(cut, (k_means(points[:, :cut], k, like.rounds), k_means(points[:, cut:], k, like.rounds)))


def index(rows: DataFrame, dim: int, books: Books, like: MultiIndex) -> DataFrame:
    """block, cell, id, vector of every row, from a stored table; fills in the books."""

    def quantised(batch: pa.RecordBatch) -> dict:
        x = _matrix(batch, "vector", dim).astype(np.float64)
        cell, (r1, r2) = books.cells(x)
        own = {c: batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "vector")}
        return {
            "id": own["vec_id"], "cell": cell.astype(np.int32), "salt": np.arange(len(x), dtype=np.int32),
            "r1": r1, "r2": r2, "size": np.linalg.norm(x, axis=1), "vector": own["vector"],
        }

    kind = dict(rows.dtypes)["vector"]
    coded = cut_lineage(
        to_columns(rows, quantised, f"id long, cell int, salt int, r1 double, r2 double, size double, vector {kind}"), "coded"
    )
    found = coded.groupBy("cell").agg(
        F.count("*").alias("n"), F.sum("r1").alias("s1"), F.max("r1").alias("m1"),
        F.sum("r2").alias("s2"), F.max("r2").alias("m2"), F.max("size").alias("size"),
    ).toArrow().sort_by("cell")
    at = {c: found.column(c).to_numpy() for c in found.column_names}
    k2 = len(books.centroids[1])
    books.longest = float(at["size"].max())
    books.count = np.zeros(len(books.centroids[0]) * k2, np.int64)
    books.count[at["cell"]] = at["n"]
    reach = []
    for own, book, s, m in ((at["cell"] // k2, books.centroids[0], "s1", "m1"), (at["cell"] % k2, books.centroids[1], "s2", "m2")):
        n = np.bincount(own, at["n"], len(book))
        square = np.bincount(own, at[s], len(book))
        far = np.zeros(len(book))
        np.maximum.at(far, own, at[m])
        # copies that sit on a centroid say nothing about the others around it
        mean = np.maximum(square / np.maximum(n, 1), square.sum() / n.sum()) / max(1, book.shape[1])
        reach.append(np.sqrt(far) if like.exact else like.reach * np.sqrt(mean))
    books.reach = tuple(reach)

    size = max(1, min(like.block, -(-int(books.count.sum()) // like.blocks)))
    books.start, books.split = np.zeros(len(books.count), np.int64), np.ones(len(books.count), np.int64)
    block, held = 0, 0
    for cell, n in enumerate(books.count.tolist()):
        if held and held + n > size:
            block, held = block + 1, 0
        books.start[cell], books.split[cell] = block, max(1, -(-n // size))
        held += n
        if books.split[cell] > 1:
            block, held = block + int(books.split[cell]), 0

    start, split = books.start, books.split

    def dealt(batch: pa.RecordBatch) -> dict:
        cell, salt = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("cell", "salt"))
        return {"block": (start[cell] + salt % split[cell]).astype(np.int32)}

    return with_columns(coded.select("cell", "id", "vector", "salt"), dealt, "block int", ("salt",))


def _visits(books: Books, q: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Which blocks (columns) hold a cell that reaches a query's floor."""
    filled = np.flatnonzero(books.count)
    several = books.split[filled]
    pair_cell = np.repeat(filled, several)
    pair_block = np.repeat(books.start[filled], several) + np.arange(len(pair_cell)) - np.repeat(np.cumsum(several) - several, several)
    first = np.flatnonzero(np.append(True, pair_block[1:] != pair_block[:-1]))
    one, two = books.nearness(q)
    k2 = two.shape[1]
    reached = one[:, pair_cell // k2] + two[:, pair_cell % k2] >= (floor - books.margin(q))[:, None]
    return np.logical_or.reduceat(reached, first, axis=1), pair_block[first]


def ranked(entries: dict, books: Books, ids, q, floor, least, k: int):
    """For queries: (query number, id, score) of the best k entries of a block in cells that
    reach `floor`, from a score of `least` on, best first."""
    cells, x, own = entries["cell"], entries["x"], entries["id"]
    begin = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    end = np.append(begin[1:], len(cells))
    one, two = books.nearness(q)
    k2, margin = two.shape[1], books.margin(q)
    here = cells[begin]
    reached = one[:, here // k2] + two[:, here % k2] >= (floor - margin)[:, None]
    score = np.full((len(q), len(x)), -np.inf)
    for c in np.flatnonzero(reached.any(axis=0)):
        who = np.flatnonzero(reached[:, c])
        score[who, begin[c] : end[c]] = q[who] @ x[begin[c] : end[c]].T
    score[ids[:, None] == own[None, :]] = -np.inf
    kth = np.partition(score, len(x) - k, axis=1)[:, len(x) - k] if len(x) > k else np.full(len(q), -np.inf)
    low = np.maximum(kth, least) - 2 * margin
    for i in range(len(q)):
        at = np.flatnonzero((score[i] >= low[i]) & (score[i] > -np.inf))
        if len(at):
            exact = (x[at] * q[i]).sum(axis=1)  # the same sums for equal vectors
            order = np.lexsort((own[at], -exact))[:k]
            yield i, own[at][order], exact[order]


def search(entries: DataFrame, queries: DataFrame, dim: int, books: Books, like: MultiIndex) -> DataFrame:
    """query_id, key, rank, vec_id, score: the best entries for each query (id, key, vector, floor,
    least) in the cells that reach its floor."""
    kind = dict(queries.dtypes)["vector"]
    blocks = int((books.start + books.split).max())

    def sent(batch: pa.RecordBatch) -> pa.RecordBatch:
        q = _matrix(batch, "vector", dim).astype(np.float64)
        floor = batch.column(batch.schema.get_field_index("floor")).to_numpy()
        rows, at = [], []
        step = max(1, (1 << 22) // len(books.count))
        for lo in range(0, len(q), step):
            seen, numbers = _visits(books, q[lo : lo + step], floor[lo : lo + step])
            i, b = np.nonzero(seen)
            rows.append(i + lo)
            at.append(numbers[b])
        taken = batch.take(pa.array(np.concatenate(rows)))
        columns = [taken.column(batch.schema.get_field_index(c)) for c in ("id", "key", "vector", "floor", "least")]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(at).astype(np.int32)), *columns], ["block", "id", "key", "vector", "floor", "least"]
        )

    asked = map_batches(
        queries.select("id", "key", "vector", "floor", "least"), sent,
        StructType.fromDDL(f"block int, id long, key long, vector {kind}, floor double, least double"),
    )
    lines = entries.selectExpr(
        "block", "0 kind", "cell", "id", "0L key", "vector", "0D floor", "0D least"
    ).unionByName(asked.selectExpr("block", "1 kind", "0 cell", "id", "key", "vector", "floor", "least"))
    k = like.neighbours

    def past(batches):
        block, held, ready = None, [], None
        for batch in batches:
            for part in parts(batch):
                b, asks, cell, ids, key, floor, least = (
                    part.column(part.schema.get_field_index(c)).to_numpy()
                    for c in ("block", "kind", "cell", "id", "key", "floor", "least")
                )
                x = _matrix(part, "vector", dim).astype(np.float64)
                turns = np.flatnonzero(np.append(True, (b[1:] != b[:-1]) | (asks[1:] != asks[:-1])))
                for lo, hi in zip(turns, np.append(turns[1:], len(b))):
                    if b[lo] != block:
                        block, held, ready = b[lo], [], None
                    if not asks[lo]:
                        held.append((cell[lo:hi], ids[lo:hi], x[lo:hi]))
                        continue
                    if ready is None and not held:
                        continue  # a part of a split cell to which no entry was dealt
                    if ready is None:
                        ready = dict(zip(("cell", "id", "x"), map(np.concatenate, zip(*held))))
                        held = []
                    step = max(1, min(SLICE, (1 << 22) // len(ready["x"])))
                    for s in range(lo, hi, step):
                        t = slice(s, min(hi, s + step))
                        yield from _answer(ready, books, ids[t], key[t], x[t], floor[t], least[t], k)

    found = lines.repartition(blocks, "block").sortWithinPartitions("block", "kind", "cell").mapInArrow(
        past, "query_id long, key long, vec_id long, score double"
    )
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _answer(entries, books, ids, key, q, floor, least, k):
    rows = list(ranked(entries, books, ids, q, floor, least, k))
    if rows:
        n = [len(r[1]) for r in rows]
        who = np.repeat([r[0] for r in rows], n)
        arrays = (ids[who], key[who], np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]))
        yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["query_id", "key", "vec_id", "score"])


def neighbours(rows: DataFrame, queries: DataFrame, like: MultiIndex = MultiIndex(), vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the entries of `rows` with the largest inner products with
    each row of `queries`; both have vec_id and the vectors."""

    def some(df: DataFrame) -> DataFrame:
        return df.filter(F.col("vec_id").isNotNull() & F.exists(F.col(f"`{vector}`"), lambda c: c != 0))

    entries, dim, n = usable(some(rows), vector)
    if not dim:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = fit(entries, dim, n, like)
    blocks = index(entries, dim, books, like)
    kind = dict(entries.dtypes)["vector"]
    asking = some(queries).select(
        F.col("vec_id").cast("long").alias("id"), F.col(f"`{vector}`").cast(kind).alias("vector")
    ).filter(F.size("vector") == dim).distinct()
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    asking = asking.filter(finite).withColumn("key", F.xxhash64("id", "vector"))
    enough = like.first * like.neighbours

    def begun(batch: pa.RecordBatch) -> dict:
        q = _matrix(batch, "vector", dim).astype(np.float64)
        floor = []
        for lo in range(0, len(q), 1024):
            one, two = books.nearness(q[lo : lo + 1024])
            floor += [walk(a, b, books.count, enough) for a, b in zip(one, two)]
        own = {c: batch.column(batch.schema.get_field_index(c)) for c in ("id", "key", "vector")}
        return own | {"floor": floor, "least": np.full(len(q), -np.inf)}

    first = cut_lineage(
        to_columns(asking, begun, f"id long, key long, vector {kind}, floor double, least double"), "queries"
    )
    known = (
        search(blocks, first, dim, books, like).groupBy("query_id", "key")
        .agg(F.count("*").alias("n"), F.min("score").alias("worst"))
        .filter(F.col("n") == like.neighbours).select(F.col("query_id").alias("id"), "key", "worst")
    )
    least = F.coalesce("worst", F.lit(float("-inf")))
    second = cut_lineage(
        first.drop("least").join(known, ["id", "key"], "left")
        .withColumn("least", least).withColumn("floor", F.least("floor", "least")).drop("worst"),
        "queries",
    )
    return search(blocks, second, dim, books, like).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_neighbours(rows: DataFrame, like: MultiIndex = MultiIndex(), every: int = 20) -> DataFrame:
    """The neighbours of all rows whose vec_id is divisible by `every`, among all rows."""
    return neighbours(rows, rows.filter(F.col("vec_id") % every == 0), like)
