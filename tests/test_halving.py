import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salespanel.operators.features import unlog
from salespanel.operators.halving import Rungs, binned_folds, run_rungs, search_halving
from salespanel.operators.learned import estimator, fold_forecast, fold_tables, segment_codes
from salespanel.operators.panel import regularise
from salespanel.operators.recurrence import folds
from salespanel.operators.specs import Boosted
from salespanel.plans import forecast_job, tune_job


@given(st.integers(1, 60), st.integers(1, 4), st.integers(2, 4), st.integers(1, 8), st.randoms())
def test_promotions_are_among_the_best_and_some_trial_gets_to_the_top(n, n_rungs, eta, width, draw):
    """Fits end in any order; a promotion is right for the scores there when it is made."""
    rungs, running, started = Rungs(n, n_rungs, eta), [], []
    quality = [draw.random() for _ in range(n)]
    while True:
        while len(running) < width and (job := rungs.next()):
            trial, rung = job
            if rung:
                below = rungs.ranked(rung - 1)
                allowed = len(below) // eta or (0 if running else 1)
                assert trial in below[: max(1, allowed)]
            running.append(job)
            started.append(job)
        if not running:
            break
        job = running.pop(draw.randrange(len(running)))
        rungs.done(*job, quality[job[0]])
    assert len(started) == len(set(started))
    assert {t for t, r in started if r == 0} == set(range(n))
    assert all((t, r - 1) in started for t, r in started if r)
    for r in range(1, n_rungs):
        best = rungs.ranked(r - 1)[: len(rungs.scores[r - 1]) // eta]
        assert set(best) <= set(rungs.scores[r])
    assert rungs.best() is not None


def test_rungs_one_at_a_time_and_without_scores():
    ended = run_rungs(Rungs(9, 3, 3), lambda t, r: float(t), 1)
    assert [e[:2] for e in ended] == [(0, 0), (1, 0), (2, 0), (0, 1), (3, 0), (4, 0), (5, 0), (1, 1),
                                      (6, 0), (7, 0), (8, 0), (2, 1), (0, 2)]
    silent = Rungs(5, 3, 3)
    assert len(run_rungs(silent, lambda t, r: None, 3)) == 5 and silent.best() is None
    some = Rungs(7, 2, 3)
    run_rungs(some, lambda t, r: None if t % 2 == 0 else float(-t), 4)
    assert some.best() == 5
    with pytest.raises(RuntimeError):
        def broken(t, r):
            raise RuntimeError("lost")
        run_rungs(Rungs(3, 2, 2), broken, 2)
    for wrong in ((0, 1, 2), (1, 0, 2), (1, 1, 1)):
        with pytest.raises(ValueError):
            Rungs(*wrong)


@pytest.fixture(scope="module")
def planted(spark):
    draw = random.Random(4)
    rows = [
        (f"d{k % 2}|a{k}", f"{2020 + m // 12}-{m % 12 + 1:02d}-01", 10.0 * (k + 1) * (1 + (m % 12 == 5)) + draw.random())
        for k in range(6) for m in range(48)
    ]
    df = spark.createDataFrame(rows, "segment string, timestamp string, target double")
    out = regularise(df.selectExpr("segment", "cast(timestamp as timestamp_ntz) timestamp", "target"))
    return out.cache()


def test_bins_keep_rows_and_splits(spark, planted):
    """With no more values than bins, a value has a bin of its own, in the order of values."""
    codes = segment_codes(planted)
    plain = [fold_tables(planted, codes, 3, end) for end in folds(2, 3, "constant")]
    binned = binned_folds(planted, 3, 2)
    assert [f for f, *_ in binned] == [0, 1]
    for (train, test), (_, b_train, b_test) in zip(plain, binned):
        assert b_train.count() == train.count() and b_test.count() == test.count()
        inputs = [c for c in train.columns if c != "y"]
        values = {tuple(float(r[c]) for c in inputs) for r in train.collect()}
        bins = {tuple(r.features.toArray()) for r in b_train.collect()}
        assert len(values) == len(bins)
        for i in range(len(inputs)):
            assert len({v[i] for v in values}) == len({b[i] for b in bins})
    spec = Boosted(max_iter=3, max_depth=3, max_bins=64)
    for (train, test), (_, b_train, b_test) in zip(plain, binned):
        want = {(r.segment, r.h): r.yhat for r in fold_forecast(train, test, spec, 0, 0).collect()}
        got = estimator(spec).fit(b_train).transform(b_test).select("segment", "h", unlog("prediction").alias("yhat"))
        assert {(r.segment, r.h): r.yhat for r in got.collect()} == pytest.approx(want)
    assert set(binned[0][2].columns) == {"segment", "timestamp", "actual", "h", "features"}


def test_halving_repeats_and_finds_the_planted_signal(spark, planted):
    space = {"max_iter": ("int", 2, 6), "step_size": ("log", 0.1, 0.8), "max_depth": ("int", 1, 4)}
    best, fits = search_halving(planted, 2, space, n_trials=4, n_folds=2, seed=3, n_rungs=2, eta=2)
    rows = fits.collect()
    assert sorted(r.trial for r in rows if r.rung == 0) == [0, 1, 2, 3]
    top = [r for r in rows if r.rung == 1]
    assert 2 <= len(top) <= 4 and all(r.trees == r.max_iter for r in top)
    assert best.name == f"trial_{min(top, key=lambda r: (r.rmse, r.trial)).trial}"
    assert all(r.trees == -(-r.max_iter // 2) for r in rows if r.rung == 0)
    _, again = search_halving(planted, 2, space, n_trials=4, n_folds=2, seed=3, n_rungs=2, eta=2)
    for a, b in zip(again.collect(), rows, strict=True):
        assert a.rmse == pytest.approx(b.rmse) and a.asDict() | {"rmse": 0} == b.asDict() | {"rmse": 0}
    spread = planted.agg(F.stddev("target")).first()[0]
    assert min(r.rmse for r in top) < spread


def test_a_panel_without_folds_raises(spark, planted):
    with pytest.raises(Exception):
        search_halving(planted.filter("t_idx < 1"), 2, {"max_iter": ("int", 1, 1)}, n_trials=1, n_folds=1)


def test_tuned_by_halving_is_stored_and_forecasts(spark, tmp_path, planted):
    panel = str(tmp_path / "panel")
    planted.selectExpr("segment", "timestamp", "target", "split(segment, '[|]')[0] department").write.parquet(panel)
    space = {"max_iter": ("int", 2, 4), "max_depth": ("int", 1, 2)}
    best = tune_job(spark, panel, str(tmp_path / "m"), 2, n_trials=3, n_folds=1, space=space, halving=True, parallelism=2)
    assert isinstance(best, Boosted)
    assert {"trial", "rung", "trees", "rmse", "ended"} < set(spark.read.parquet(str(tmp_path / "m/trials")).columns)
    assert forecast_job(spark, str(tmp_path / "m/model"), panel, str(tmp_path / "f")).count() == 12
