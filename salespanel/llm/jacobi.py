"""Whitening of embeddings by principal components, found with Jacobi-Davidson.

The covariance is never formed. What is asked of it are products with a block of vectors, and a
product is one pass over the stored vectors: each task centres its rows, multiplies them with the
block and back, and hands on one number per cell of the block; Spark sums the cells. A pass
brings dimensions x block numbers to the driver, however many rows there are.

On the driver is a subspace of at most `basis` directions and its products. Its Rayleigh-Ritz
pairs with the largest values are corrected together: for each, some steps of MINRES solve the
correction equation, projected away from all locked and all current vectors, and the steps of
all go through one pass. Corrections extend the subspace. A pair whose residual is down to
rounding, 2^-46 of the largest value, is locked when all larger ones are; a full subspace
restarts from its best vectors. At the end no value in the subspace may exceed a locked one.

Vectors: rows are left out whose vector is null or empty or holds null or non-finite entries,
and rows of another length than the commonest (the longer of equals). Entries count as
floor(entry / `step`) + `shift`. Repeated rows and repeated numbers are rows of their own; a
null number stays null. Components without variance (below 1e-13 of the whole) are not
returned, so one row, or equal rows only, give an empty result, as does an empty table. Values
too large for exact longs raise. Columns that are not read are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage
from .arrow import parts, to_columns

ROUNDING = 2.0**-46
LARGEST = 2.0**36  # of entries, so that sums of a batch stay exact


@dataclass(frozen=True)
class Whitening:
    """`components` to find; `step`, `shift`: how entries become whole numbers; `inner`: steps
    of MINRES for a correction; `basis`: directions in a full subspace, per component."""

    components: int = 8
    step: float = 1 / 1024
    shift: int = 100_000
    inner: int = 8
    basis: int = 8
    rounds: int = 200
    seed: int = 0


def usable(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int, int]:
    """vec_id, vector of the rows that take part, the vectors' length (0 if there are none) and
    their number."""
    v = F.col(f"`{vector}`")
    if dict(rows.dtypes)[vector] != "array<float>":
        v = v.cast("array<double>")
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).filter(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & finite
    )
    lengths = whole.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if first is None:
        return whole, 0, 0
    return whole.filter(F.size("vector") == first["size"]), first["size"], first["n"]


def _matrix(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(column)).flatten()
    return values.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _cells(table: DataFrame, cells: Callable[[np.ndarray], np.ndarray], dim: int) -> np.ndarray:
    """The sum of `cells` (of the rows of a batch, always as many numbers) over all rows."""

    def one_task(batches):
        total = None
        for batch in batches:
            for part in parts(batch):
                made = cells(_matrix(part, "x", dim))
                total = made if total is None else total + made
        if total is not None:
            kind = pa.int64() if total.dtype == np.int64 else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, kind)], ["cell", "value"])

    kind = "long" if cells(np.zeros((1, dim), np.int64)).dtype == np.int64 else "double"
    made = table.select("x").mapInArrow(one_task, f"cell int, value {kind}")
    found = made.groupBy("cell").agg(F.sum("value").alias("value")).toArrow().sort_by("cell")
    return found.column("value").to_numpy()


class Centred:
    """Whole-numbered vectors with their exact sums, as a linear operator: their covariance."""

    def __init__(self, rows: DataFrame, like: Whitening, vector: str = "embedding"):
        whole, self.dim, self.n = usable(rows, vector)
        self.trace = 0.0
        if not self.dim:
            return
        dim, step, shift = self.dim, like.step, like.shift

        def numbers(batch: pa.RecordBatch) -> dict:
            raw = _matrix(batch, "vector", dim).astype(np.float64) / step
            if np.abs(raw).max() >= LARGEST:
                raise OverflowError("an entry is too large for exact sums")
            x = np.floor(raw).astype(np.int64) + shift
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * dim), pa.array(x.ravel()))
            return {"vec_id": batch.column(batch.schema.get_field_index("vec_id")), "x": lists}

        self.table = cut_lineage(to_columns(whole, numbers, "vec_id long, x array<long>"), "whole-numbers")
        self.sums = _cells(self.table, lambda x: x.sum(axis=0), dim).tolist()

    def spread(self) -> Callable[[np.ndarray], np.ndarray]:
        """n * x - sums of rows x, exactly."""
        n = self.n
        whole = np.array([s // n for s in self.sums], np.int64)
        rest = np.array([s % n for s in self.sums], np.int64)

        def exact(x: np.ndarray) -> np.ndarray:
            near = x - whole
            if float(np.abs(near).max(initial=0)) * n >= 2.0**62:
                raise OverflowError("vectors spread too far for exact longs")
            return near * n - rest

        return exact

    def dot(self, block: np.ndarray) -> np.ndarray:
        """Covariance times a block of vectors, in one pass; sets the trace too."""
        exact, n = self.spread(), self.n

        def cells(x: np.ndarray) -> np.ndarray:
            c = exact(x) / n
            return np.append((c.T @ (c @ block)).ravel(), (c * c).sum())

        found = _cells(self.table, cells, self.dim) / n
        self.trace = float(found[-1])
        return found[:-1].reshape(block.shape)


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Approximate solutions of several symmetric systems, column by column, in common steps;
    stops when all residuals are down to `enough` of the right side."""
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    left = beta.copy()  # residual norms, with sign
    v = right / np.where(beta > 0, beta, 1)
    start, before = beta.copy(), np.zeros_like(right)
    w0 = w1 = np.zeros_like(right)
    c0 = c1 = np.ones(len(beta))
    s0 = s1 = np.zeros(len(beta))
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * before
        after = np.linalg.norm(p, axis=0)
        delta = c1 * alpha - c0 * s1 * beta
        rho1 = np.hypot(delta, after)
        safe = np.where(rho1 > 0, rho1, 1)
        rho2, rho3 = s1 * alpha + c0 * c1 * beta, s0 * beta
        c0, s0, c1, s1 = c1, s1, delta / safe, after / safe
        w0, w1 = w1, (v - rho3 * w0 - rho2 * w1) / safe
        x = x + c1 * left * w1
        left = -s1 * left
        before, v, beta = v, p / np.where(after > 0, after, 1), after
        if (np.abs(left) <= enough * start).all():
            break
    return x


def _away(vectors: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Vectors without their parts in some orthonormal bases."""
    for _ in range(2):
        for b in bases:
            vectors = vectors - b @ (b.T @ vectors)
    return vectors


def _orthonormal(vectors: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the vectors add to the bases."""
    new = np.empty((len(vectors), 0))
    for column in vectors.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        c = _away((column / size)[:, None], *bases, new)
        left = np.linalg.norm(c)
        if left > 1e-10:
            c = _away(c / left, *bases, new)
            new = np.hstack([new, c / np.linalg.norm(c)])
    return new


def jacobi_davidson(
    dot: Callable[[np.ndarray], np.ndarray], dim: int, like: Whitening = Whitening()
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix without negative ones, falling, their unit
    vectors as columns, and their residuals as a part of the largest value."""
    wanted = min(like.components, dim)
    most = min(dim, max(like.basis, 3) * wanted)
    draw = np.random.default_rng(like.seed)
    locked, values, rests = np.empty((dim, 0)), [], []
    q = _orthonormal(draw.standard_normal((dim, min(dim, 2 * wanted))))
    aq = dot(q)
    stuck, best = 0, np.inf
    for _ in range(like.rounds):
        theta, y = np.linalg.eigh((h := q.T @ aq) / 2 + h.T / 2)
        theta, y = theta[::-1], y[:, ::-1]
        largest = max([theta[0] if len(theta) else 0.0, *values])
        if largest <= 0:
            break
        u, au = q @ y, aq @ y
        r = au - u * theta
        rest = np.linalg.norm(r, axis=0) / largest
        whole = q.shape[1] + locked.shape[1] == dim
        settled = whole and not stuck or stuck >= 3 and rest[0] < 1e-10
        k = 0
        while k < len(theta) and (rest[k] <= ROUNDING or settled and rest[k] < 1e-10):
            if len(values) >= wanted and theta[k] <= min(values):
                break
            values.append(float(theta[k]))
            rests.append(float(rest[k]))
            k += 1
        if k:
            locked = np.hstack([locked, _orthonormal(u[:, :k], locked)])
            stuck, best = 0, np.inf
        q, aq, theta, r = u[:, k:], au[:, k:], theta[k:], r[:, k:]
        if not len(theta) or len(values) >= wanted and theta[0] <= min(values) * (1 + 1e-12):
            break
        stuck, best = (0, rest[k]) if rest[k] < best / 2 else (stuck + 1, best)
        if q.shape[1] > most - wanted and not whole:  # restart from the best vectors
            q, aq = q[:, : 3 * wanted], aq[:, : 3 * wanted]
        now = max(1, min(wanted - len(values), q.shape[1]))
        u, theta, r = q[:, :now], theta[:now], r[:, :now]

        def project(t: np.ndarray) -> np.ndarray:
            return _away(t, locked, u)

        def corrected(t: np.ndarray) -> np.ndarray:
            t = project(t)
            return project(dot(t) - theta * t)

        t = minres(corrected, project(-r), like.inner, 0.1) if not whole else np.empty((dim, 0))
        new = _orthonormal(np.hstack([t, r]) if t.size else t, locked, q)[:, : t.shape[1]]
        if new.shape[1]:
            q, aq = np.hstack([q, new]), np.hstack([aq, dot(new)])
    else:
        raise RuntimeError(f"no convergence in {like.rounds} rounds; residuals {rests} and {rest[:3]}")
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    vectors = locked[:, order]
    turn = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]) if len(order) else 1
    return np.array(values)[order], vectors * turn, np.array(rests)[order]


def whiten(rows: DataFrame, like: Whitening = Whitening(), vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, value (of the
    component) and residual for every usable row and component."""
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double, value double, residual double"
    )
    spark = rows.sparkSession
    held = Centred(rows, like, vector)
    if not held.n:
        return spark.createDataFrame([], schema)
    values, vectors, rests = jacobi_davidson(held.dot, held.dim, like)
    there = values > 1e-13 * held.trace
    values, vectors, rests = values[there], vectors[:, there], rests[there]
    k, n, dim, exact = len(values), held.n, held.dim, held.spread()
    if not k:
        return spark.createDataFrame([], schema)
    scaled = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = exact(x) / n @ scaled
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    found = _cells(held.table, moments, dim) / n
    mean = found[k * k :]
    error = float(np.abs(found[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    explained = values / held.trace

    def one(batch: pa.RecordBatch) -> dict:
        y = exact(_matrix(batch, "x", dim))
        if ((y.astype(np.float64) ** 2).sum(axis=1) >= 2.0**63).any():
            raise OverflowError("a deviation does not fit a long")
        w = y / n @ scaled
        m = len(y)
        return {
            "vec_id": batch.column(batch.schema.get_field_index("vec_id")).take(pa.array(np.repeat(np.arange(m), k))),
            "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
            "n": np.full(m * k, n),
            "deviation": np.repeat((y * y).sum(axis=1), k),
            "whitened": w.ravel(),
            "explained": np.tile(explained, m),
            "identity_error": np.full(m * k, error),
            "value": np.tile(values, m),
            "residual": np.tile(rests, m),
        }

    return to_columns(held.table, one, schema)
