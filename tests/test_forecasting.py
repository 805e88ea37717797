import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salespanel.operators.ensemble import (
    intervals,
    recurrence_ensemble,
    vote,
    vote_backtest,
    weight_table,
)
from salespanel.operators.evaluation import (
    combined_score,
    inverse_weights,
    metrics,
    roll_up,
    top_models,
)
from salespanel.operators.forecasting import backtest, forecast
from salespanel.operators.panel import regularise
from salespanel.operators.recurrence import folds, linear_coefficients, linear_forecast
from salespanel.operators.specs import CLASSICAL, Boosted, Linear, Naive, SeasonalMA
from salespanel.operators.tuning import SPACE, draw, keep_below_median, search


def literal_recursion(history, window, season, horizon):
    values = list(history)
    for _ in range(horizon):
        values.append(sum(values[len(values) - j * season] for j in range(1, window + 1)) / window)
    return values[len(history):]


@pytest.mark.parametrize("w,s,h", [(1, 1, 5), (1, 3, 8), (1, 6, 8), (1, 12, 15), (2, 3, 8), (2, 6, 14), (3, 4, 13)])
def test_coefficients_equal_literal_recursion(w, s, h):
    rng = np.random.default_rng(w * 100 + s)
    history = list(rng.normal(size=w * s + 5))
    got = [0.0] * h
    for _, step, back, weight in linear_coefficients([SeasonalMA(w, s)], h):
        got[step - 1] += weight * history[-1 - back]
    assert got == pytest.approx(literal_recursion(history, w, s, h), abs=1e-12)


def test_worked_recurrence():
    history = [1, 2, 3, 4, 5, 6]
    got = [0.0] * 8
    for _, step, back, weight in linear_coefficients([SeasonalMA(2, 3)], 8):
        got[step - 1] += weight * history[-1 - back]
    assert got == [2.5, 3.5, 4.5, 3.25, 4.25, 5.25, 2.875, 3.875]


def test_naive_is_a_one_value_average():
    for lag in (1, 3, 6, 12):
        a = [c[1:] for c in linear_coefficients([Naive(lag)], 9)]
        assert a == [c[1:] for c in linear_coefficients([SeasonalMA(1, lag)], 9)]


def test_folds():
    assert folds(3, 4) == [(0, 12, 0), (1, 8, 0), (2, 4, 0)]
    assert folds(2, 3, "constant") == [(0, 6, 0), (1, 3, 3)]
    with pytest.raises(ValueError, match="too few"):
        folds(3, 4, length=12)


def brute(values, window, season, horizon, end):
    """Log scale, fill from earlier values, recursion, back; values[:end] is training."""
    y = [None if v is None else math.log10(v + 1) for v in values[:end]]
    filled, seen = [], []
    for v in y:
        filled.append(v if v is not None else (sum(seen) / len(seen) if seen else None))
        if v is not None:
            seen.append(v)
    out = list(filled)
    for _ in range(horizon):
        parts = [out[len(out) - j * season] if len(out) >= j * season else None for j in range(1, window + 1)]
        out.append(None if None in parts else sum(parts) / window)
    return [None if v is None else 10**v - 1 for v in out[end:]]


VALUES = {
    "a": [3, None, 5, 9, 0, 4, None, 8, 2, 6, 7, 1, 5, 9, 3, 8],
    "late": [None] * 9 + [4, 8, 2, 9, None, 5, 3],
}


def panel_of(sales):
    return regularise(sales({k: {t: None if v is None else float(v) for t, v in enumerate(vs)} for k, vs in VALUES.items()}))


def check(rows, specs, horizon, start_of=lambda fold: 0, end_of=lambda fold: 16):
    by = {s.name: s.recurrence for s in specs}
    assert rows
    for r in rows:
        start, end = start_of(r.fold), end_of(r.fold)
        expected = brute(VALUES[r.segment][start:end], *by[r.model], horizon, end - start)[r.h - 1]
        assert r.yhat == (None if expected is None else pytest.approx(expected, abs=1e-9)), r


def test_forecast_equals_brute_force(spark, sales):
    rows = forecast(panel_of(sales), CLASSICAL, 7).collect()
    assert len(rows) == 2 * 8 * 7
    check(rows, CLASSICAL, 7)
    assert any(r.yhat is None for r in rows)
    assert {r.timestamp.strftime("%Y-%m") for r in rows if r.h == 1} == {"2021-05"}


@pytest.mark.parametrize("mode", ["expand", "constant"])
def test_backtest_equals_brute_force(spark, sales, mode):
    rows = backtest(panel_of(sales), CLASSICAL, 2, n_folds=3, mode=mode).collect()
    assert len(rows) == 2 * 8 * 2 * 3
    check(
        rows, CLASSICAL, 2, (lambda f: 2 * f) if mode == "constant" else (lambda f: 0),
        lambda f: 16 - (3 - f) * 2,
    )
    for r in rows:
        t = 16 - (3 - r.fold) * 2 + r.h - 1
        assert r.actual == VALUES[r.segment][t]


def test_months_ahead_ride_along_with_the_folds(spark, sales):
    panel = panel_of(sales)
    both = linear_forecast(panel, CLASSICAL, 2, [*folds(3, 2), (3, 0, 0)])
    ahead = sorted(map(tuple, both.filter("fold = 3").drop("fold").collect()), key=str)
    assert ahead == sorted(map(tuple, forecast(panel, CLASSICAL, 2).drop("fold").collect()), key=str)


POINTS = "model string, candidate_no int, fold int, segment string, h int, timestamp string, actual double, yhat double"


def test_metrics(spark):
    rows = [("m", 0, 0, "s", 1, "x", 4.0, 2.0), ("m", 0, 0, "s", 2, "x", 0.0, 1.0), ("m", 0, 0, "s", 3, "x", None, 1.0), ("m", 0, 0, "s", 4, "x", 1.0, None)]
    bt = spark.createDataFrame(rows, POINTS)
    got = metrics(bt).first()
    assert (got.mae, got.mse) == (1.5, 2.5) and got.rmse == pytest.approx(math.sqrt(2.5))
    assert got.smape == pytest.approx(100 * (4 / 6 + 2) / 2)
    assert got.mape == pytest.approx(100 * (0.5 + 1e15) / 2)
    assert metrics(bt, mape_zero="skip").first().mape == pytest.approx(50)


def scores(spark, rows):
    return spark.createDataFrame(rows, "model string, candidate_no int, score double")


def test_ties_go_to_the_earlier_candidate(spark):
    table = scores(spark, [("b", 4, 1.0 + 1e-13), ("a", 1, 1.0 + 2e-13), ("c", 0, 2.0), ("d", 3, None)])
    assert [r.model for r in top_models(table, 2).collect()] == ["a", "b"]
    assert [r.model for r in top_models(table, 2, dedupe=True).collect()] == ["a", "c"]
    assert top_models(table, 9).count() == 3


def test_weights(spark):
    got = {r.model: r.weight for r in inverse_weights(scores(spark, [("a", 0, 1.0), ("b", 1, 3.0)])).collect()}
    assert got == pytest.approx({"a": 0.75, "b": 0.25})
    zero = scores(spark, [("a", 0, 0.0), ("b", 1, 3.0), ("c", 2, 0.0)])
    assert {r.model: r.weight for r in inverse_weights(zero).collect()} == {"a": 0.5, "b": 0.0, "c": 0.5}


def test_vote_skips_missing_members(spark):
    rows = [("a", 0, 0, "s", 1, "x", None, 2.0), ("b", 1, 0, "s", 1, "x", None, None), ("a", 0, 0, "t", 1, "x", None, 2.0), ("b", 1, 0, "t", 1, "x", None, 6.0), ("a", 0, 0, "u", 1, "x", None, None)]
    voted = vote(spark.createDataFrame(rows, POINTS), weight_table(spark, {"a": 1, "b": 3}))
    assert {r.segment: r.yhat for r in voted.collect()} == {"s": 2.0, "t": 5.0, "u": None}


def test_vote_of_equal_members_is_the_member(spark, sales):
    bt = backtest(panel_of(sales), [Naive(3), SeasonalMA(1, 3)], 2)
    voted = vote_backtest(bt, weight_table(spark, {"naive_3": 0.3, "seasonal_1_3": 0.7}))
    single = bt.filter("model = 'naive_3'").select("segment", "fold", "h", "yhat")
    both = voted.join(single.withColumnRenamed("yhat", "one"), ["segment", "fold", "h"]).collect()
    assert len(both) == 12
    for r in both:
        assert r.yhat == (None if r.one is None else pytest.approx(r.one))


def test_one_pass_ensemble_equals_the_steps(spark, sales):
    panel = panel_of(sales)
    bt = backtest(panel, CLASSICAL, 2)
    weights = inverse_weights(top_models(combined_score(roll_up(metrics(bt)))))
    assert sum(r.weight for r in weights.collect()) == pytest.approx(1)
    steps = intervals(vote(forecast(panel, CLASSICAL, 2), weights), vote_backtest(bt, weights))
    key = ["segment", "timestamp"]
    expected = {(r[0], r[1]): r[2:] for r in steps.orderBy(*key).collect()}
    got = {(r[0], r[1]): r[2:] for r in recurrence_ensemble(panel, CLASSICAL, 2).collect()}
    assert got.keys() == expected.keys()
    for k, values in expected.items():
        assert got[k] == pytest.approx(values)


def test_intervals(spark):
    fc = spark.createDataFrame([("s", "x", 10.0), ("none", "x", 5.0)], "segment string, timestamp string, yhat double")
    bt = spark.createDataFrame([("v", 0, 0, "s", 1, "x", 1.0, 0.0), ("v", 0, 1, "s", 1, "x", 3.0, 0.0)], POINTS)
    got = {r.segment: r for r in intervals(fc, bt, (0.1, 0.95)).collect()}
    assert got["s"]["target_0.1"] == pytest.approx(10 - 1.2815515655)
    assert got["s"]["target_0.95"] == pytest.approx(10 + 1.6448536270)
    assert got["none"]["target_0.1"] is None


@pytest.fixture
def planted(spark, sales):
    """Level by segment and month: a tree model can learn it, a global mean can not."""
    series = {f"D|{s}": {t: float(20 * s + (30 if t % 12 < 3 else 0)) for t in range(30)} for s in range(6)}
    return regularise(sales(series)).cache()


def test_boosted_trees_beat_the_mean_and_repeat(spark, planted):
    spec = Boosted(max_iter=8, max_depth=4, step_size=0.4, seed=7)
    bt = backtest(planted, [spec], 3, n_folds=1).cache()
    mean = planted.agg(F.avg("target")).first()[0]
    errors = bt.agg(F.avg(F.abs(F.col("actual") - F.col("yhat"))), F.avg(F.abs(F.col("actual") - mean))).first()
    assert errors[0] < 0.5 * errors[1]
    again = backtest(planted, [spec], 3, n_folds=1)
    key = ["segment", "h"]
    assert [r.yhat for r in bt.orderBy(*key).collect()] == [r.yhat for r in again.orderBy(*key).collect()]


def test_linear_candidate_forecasts_every_segment(spark, planted):
    assert forecast(planted, [Naive(1), Linear(0.01, 0.5)], 2).count() == 6 * 2 * 2


def test_search_finds_a_trial_and_prunes(spark, planted):
    space = {"max_iter": ("int", 1, 2), "step_size": ("log", 0.05, 0.8), "max_depth": ("int", 1, 4)}
    best, trials = search(planted, 2, space, n_trials=3, n_folds=2, seed=1, prune=True)
    rows = trials.collect()
    assert len(rows) == 3 and any(r.pruned for r in rows)
    kept = [r for r in rows if not r.pruned]
    assert best.name == f"trial_{min(kept, key=lambda r: r.rmse).trial}"
    assert all(r.folds_run == 1 for r in rows if r.pruned)


def test_draws_repeat_and_stay_in_range():
    import random

    one, two = (draw(SPACE, random.Random(42)) for _ in range(2))
    assert one == two
    assert all(low <= one[k] <= high for k, (_, low, high) in SPACE.items())


def test_median_rule_keeps_the_better_half():
    specs = [Boosted(name=n) for n in "abcd"]
    kept = keep_below_median(specs, {"a": 1.0, "b": 2.0, "c": 3.0, "d": 4.0})
    assert [s.name for s in kept] == ["a", "b"]


def test_boosted_queries_take_all_candidates(monkeypatch):
    from salespanel.operators.specs import BOOSTED
    from salespanel.workloads import forecasts

    taken = []
    monkeypatch.setattr(forecasts, "sales_panel", lambda *a: None)
    monkeypatch.setattr(forecasts, "cut_lineage", lambda df: df)
    monkeypatch.setattr(forecasts, "forecast", lambda panel, specs, horizon: taken.append((tuple(specs), {})))
    monkeypatch.setattr(forecasts, "backtest", lambda panel, specs, horizon, **more: taken.append((tuple(specs), more)))
    forecasts.boosted_forecast(None, "")
    forecasts.boosted_backtest(None, "")
    assert taken == [(BOOSTED, {}), (BOOSTED, {})]  # and the default number of folds


def test_conformal_bounds_hold_a_new_residual_as_often_as_they_say(spark):
    import random

    from salespanel.operators.ensemble import conformal_intervals, intervals

    draw = random.Random(8)
    skewed = lambda: draw.expovariate(1) ** 2  # noqa: E731  far from normal
    segments = [(f"s{i}", 10.0 ** (i % 3)) for i in range(600)]
    past = [("m", s, 1.0, 1.0 + size * skewed()) for s, size in segments for _ in range(9)]
    past += [("m", "none", None, 1.0), ("m", "still", 5.0, 5.0)]
    bt = spark.createDataFrame(past, "model string, segment string, yhat double, actual double").persist()
    ahead = spark.createDataFrame(
        [(s, 1.0) for s, _ in segments] + [("none", 1.0), ("still", 5.0), ("new", 1.0)], "segment string, yhat double"
    ).selectExpr("segment", "timestamp_ntz '2020-01-01' timestamp", "yhat")
    size = dict(segments)

    def coverage(rows, low, high):
        hits = [r[low] <= 1.0 + size[r.segment] * skewed() <= r[high] for r in rows if r.segment in size for _ in range(20)]
        return sum(hits) / len(hits)

    own = conformal_intervals(ahead, bt, (0.1, 0.9)).collect()  # nine residuals are enough
    assert len(own) == 603 and 0.78 < coverage(own, "target_0.1", "target_0.9") < 0.87
    pooled = conformal_intervals(ahead, bt, (0.025, 0.975)).collect()
    assert coverage(pooled, "target_0.025", "target_0.975") > 0.92
    by = {r.segment: r for r in pooled}
    assert by["none"]["target_0.975"] is None and by["new"]["target_0.025"] is None
    assert by["still"]["target_0.975"] == 5.0
    assert set(intervals(ahead, bt, (0.025, 0.975)).columns) == set(conformal_intervals(ahead, bt, (0.025, 0.975)).columns)
    nothing = conformal_intervals(ahead, bt.limit(0)).collect()
    assert {r["target_0.975"] for r in nothing} == {None}
