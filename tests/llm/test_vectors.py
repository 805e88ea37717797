import numpy as np
import pytest

from salespanel.llm import jacobi, multi_index
from salespanel.llm.jacobi import Whitening
from salespanel.llm.multi_index import MultiIndex

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, kind="float"):
    """With columns whose names the operators use themselves."""
    made = [(i, v, 1, "x", 0.5) for i, v in rows]
    return spark.createDataFrame(made, f"vec_id long, embedding array<{kind}>, n int, x string, score double").repartition(3)


def odd_rows(dim):
    bad = [None, [], [None] * dim, [NAN] * dim, [1.0] * (dim - 1) + [INF], [1.0] * (dim - 1), [0.5] * (dim - 1) + [None]]
    return [(10_000 + 20 * i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize("values", [
    np.r_[np.linspace(3, 2, 20), np.ones(30)], np.ones(40), np.r_[5.0, 5, 5, 1, 1, np.zeros(20)], np.array([2.0, 1]),
    1 / np.arange(1, 200), np.r_[np.full(12, 3.0), np.full(90, 2.999)],
])
def test_pairs_are_those_of_the_whole_matrix(values):
    dim = len(values)
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((dim, dim)))[0]
    matrix = q * values @ q.T
    found, u, rest = jacobi.jacobi_davidson(lambda b: matrix @ b, dim)
    k = min(8, dim)
    assert found == pytest.approx(np.sort(values)[::-1][:k], abs=1e-12)
    assert u.T @ u == pytest.approx(np.eye(k), abs=1e-12)
    assert np.abs(matrix @ u - u * found).max() < 1e-12 and (rest < 1e-12).all()


def test_products_are_asked_for_in_blocks_only():
    matrix = np.diag(np.linspace(1, 2, 300))
    widths = []
    jacobi.jacobi_davidson(lambda b: widths.append(b.shape[1]) or matrix @ b, 300)
    assert max(widths) <= 16  # never the whole space at once


def brute_whitening(rows, k=8):
    x = np.floor(1024 * np.array([v for _, v in rows], np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n = len(x)
    spread = n * x - x.sum(axis=0)
    cov = (spread / n).T @ (spread / n) / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, (spread**2).sum(axis=1), spread / n @ u / np.sqrt(e), e / np.trace(cov)


def test_whitening_equals_the_dense_one(spark):
    draw = np.random.default_rng(4)
    good = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((400, 24)) * np.linspace(1, 3, 24))]
    good += [good[7], (7, good[8][1]), (None, good[9][1])] + [(500 + i, good[3][1]) for i in range(60)]
    found = jacobi.whiten(vectors(spark, good + odd_rows(24))).toPandas()
    n, deviation, white, explained = brute_whitening(good)
    assert len(found) == 8 * len(good) and (found.n == n).all()
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    sides = {}
    for c in range(1, 9):
        own = found[found.component == c]
        assert own.explained.to_numpy() == pytest.approx(explained[c - 1], rel=1e-9)
        got = {}
        for i, d, w in zip(own.vec_id, own.deviation, own.whitened):
            got.setdefault(None if i != i else int(i), []).append((d, w))
        want = {}
        for (i, _), d, w in zip(good, deviation, white[:, c - 1]):
            want.setdefault(i, []).append((d, w))
        sides[c] = np.sign(got[0][0][1] * want[0][0][1])
        for i, pairs in want.items():
            mine = sorted(got[i], key=lambda p: (p[0], sides[c] * p[1]))
            assert [p[0] for p in mine] == [p[0] for p in sorted(pairs)]
            assert [sides[c] * p[1] for p in mine] == pytest.approx([p[1] for p in sorted(pairs)], abs=1e-9)


def test_whitening_of_little(spark):
    assert jacobi.whiten(vectors(spark, [])).collect() == []
    assert jacobi.whiten(vectors(spark, odd_rows(5)[:5])).collect() == []
    assert jacobi.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect() == []
    same = [(i, [1.0, 2.0]) for i in range(5)]
    assert jacobi.whiten(vectors(spark, same)).collect() == []
    found = jacobi.whiten(vectors(spark, same + [(9, [2.0, 2.0])])).toPandas()
    assert sorted(found.vec_id) == [0, 1, 2, 3, 4, 9] and set(found.component) == {1}
    assert found.explained.to_numpy() == pytest.approx(1)
    with pytest.raises(Exception, match="too large"):
        jacobi.whiten(vectors(spark, [(1, [1e30, 1.0]), (2, [1.0, 1.0])])).collect()


def brute_neighbours(rows, every=20, k=20):
    out = set()
    for qid, q in {(i, tuple(v)) for i, v in rows if i is not None and i % every == 0}:
        scored = [(-float((np.array(v) * np.array(q)).sum()), i) for i, v in rows if i is not None and i != qid]
        out |= {(qid, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def as_set(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("like", [MultiIndex(exact=True, per_cell=4, blocks=5), MultiIndex(exact=True, per_cell=4, block=13)])
def test_exact_search_equals_all_pairs(spark, like):
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((6, 7))
    rows = [(i, (centres[i % 6] + draw.standard_normal(7) / 4).round(3).tolist()) for i in range(700)]
    rows += [(1_000 + i, rows[40][1]) for i in range(350)]  # a third of all rows are copies
    rows += [rows[40], (None, rows[1][1]), (60, rows[2][1])]
    bad = odd_rows(7) + [(10_400, [0.0] * 7)]
    found = as_set(multi_index.nearest_neighbours(vectors(spark, rows + bad, "double"), like))
    want = brute_neighbours(rows)
    # rows with one vec_id that tie are told apart by nothing: compare without repeats
    assert {(q, i, s) for q, _, i, s in found} == {(q, i, s) for q, _, i, s in want}
    assert {(q, r, s) for q, r, _, s in found} == {(q, r, s) for q, r, _, s in want}


def test_recall_without_the_exact_bound(spark):
    draw = np.random.default_rng(6)
    x = draw.standard_normal((6_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = multi_index.nearest_neighbours(vectors(spark, rows)).toPandas()
    assert len(found) == 300 * 20
    score = x[::20].astype(np.float64) @ x.T.astype(np.float64)
    score[np.arange(300), np.arange(0, 6_000, 20)] = -np.inf
    worst = np.sort(score, axis=1)[:, -20]
    hit = (found.score.to_numpy() >= worst[found.query_id.to_numpy() // 20] - 1e-12).mean()
    assert hit >= 0.95


def test_walk_takes_pairs_by_falling_sums():
    draw = np.random.default_rng(7)
    for _ in range(50):
        one, two = draw.standard_normal(draw.integers(1, 9)), draw.standard_normal(draw.integers(1, 9))
        count = draw.integers(0, 5, len(one) * len(two))
        enough = int(draw.integers(1, 40))
        sums = (one[:, None] + two).ravel()
        order = np.argsort(-sums)
        held = np.cumsum(count[order])
        last = sums[order[min(np.searchsorted(held, enough), len(order) - 1)]]
        assert multi_index.walk(one, two, count, enough) == pytest.approx(last)


def test_search_in_little(spark):
    assert as_set(multi_index.nearest_neighbours(vectors(spark, []))) == set()
    assert as_set(multi_index.nearest_neighbours(vectors(spark, [(0, [1.0])]))) == set()
    rows = [(0, [1.0]), (3, [2.0]), (2, [2.0]), (20, [-1.0])]
    assert as_set(multi_index.nearest_neighbours(vectors(spark, rows))) == brute_neighbours(rows)
