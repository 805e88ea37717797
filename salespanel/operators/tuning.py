"""Random search over boosted-tree settings, scored by backtest RMSE."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from statistics import median

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage, parameter_table
from .evaluation import metrics
from .learned import fit, fold_forecast, fold_tables, segment_codes
from .recurrence import folds
from .specs import Boosted

# The searched ranges. Each is (kind, low, high); 'log' is log-uniform.
SPACE = {
    "max_iter": ("int", 500, 1500),
    "step_size": ("log", 0.05, 0.8),
    "max_depth": ("int", 4, 8),
    "max_bins": ("int", 8, 512),
    "subsampling_rate": ("float", 0.5, 1.0),
}
N_TRIALS = 100
N_FOLDS = 5
SEED = 42


def draw(space: dict, rng: random.Random) -> dict:
    values = {}
    for name, (kind, low, high) in space.items():
        if kind == "int":
            values[name] = rng.randint(low, high)
        elif kind == "log":
            values[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            values[name] = rng.uniform(low, high)
    return values


def _fold_rmse(panel, codes, specs, horizon, end, holidays, parallelism) -> dict[str, float]:
    """Mean RMSE over segments, per spec, on one fold: one number per spec comes back.
    The fold's tables are made once; each fit is a distributed job, ``parallelism`` of
    them in flight at a time."""
    train, test = fold_tables(panel, codes, horizon, end, holidays)

    def one(spec):
        bt = fold_forecast(train, test, spec, 0, end[0])
        return spec.name, metrics(bt).agg(F.avg("rmse")).first()[0]

    with ThreadPool(parallelism) as pool:
        return dict(pool.map(inheritable_thread_target(panel.sparkSession)(one), specs))


def search(
    panel: DataFrame, horizon: int, space: dict = SPACE, n_trials: int = N_TRIALS,
    n_folds: int = N_FOLDS, seed: int = SEED, prune: bool = False, warmup_folds: int = 1,
    holidays: DataFrame | None = None, parallelism: int = 1,
) -> tuple[Boosted, DataFrame]:
    """(best spec, trials). Trials are drawn up front from ``seed`` and scored on
    constant-length folds; the score is the mean RMSE over folds and segments.

    With ``prune`` a trial whose running mean is above the median of the running trials
    is dropped after each fold from ``warmup_folds`` on. ``trials`` has ``trial, rmse,
    folds_run, pruned`` and one column per searched setting.
    """
    rng = random.Random(seed)
    draws = [draw(space, rng) for _ in range(n_trials)]
    specs = [Boosted(**d, seed=seed, name=f"trial_{i}") for i, d in enumerate(draws)]
    scores: dict[str, list[float]] = {s.name: [] for s in specs}
    alive = list(specs)
    codes = cut_lineage(segment_codes(panel), "segment-codes")
    for done, end in enumerate(folds(n_folds, horizon, "constant"), start=1):
        for name, rmse in _fold_rmse(
            panel, codes, alive, horizon, end, holidays, parallelism
        ).items():
            if rmse is not None:
                scores[name].append(rmse)
        alive = [s for s in alive if scores[s.name]]
        if prune and done >= warmup_folds and done < n_folds and len(alive) > 1:
            alive = keep_below_median(alive, {n: sum(v) / len(v) for n, v in scores.items() if v})
    if not alive:
        raise ValueError("no trial could be scored: the panel is too short for the folds")
    mean = {s.name: sum(scores[s.name]) / len(scores[s.name]) for s in specs if scores[s.name]}
    best = min(alive, key=lambda s: (mean[s.name], s.name))
    running = {s.name for s in alive}
    rows = [
        (i, mean.get(s.name), len(scores[s.name]), s.name not in running, *draws[i].values())
        for i, s in enumerate(specs)
    ]
    trials = parameter_table(
        panel.sparkSession, rows, ("trial", "rmse", "folds_run", "pruned", *space)
    )
    return best, trials


def keep_below_median(specs: Sequence[Boosted], running: dict[str, float]) -> list[Boosted]:
    middle = median(running[s.name] for s in specs)
    return [s for s in specs if running[s.name] <= middle]


def refit(panel: DataFrame, best: Boosted, holidays: DataFrame | None = None):
    """The chosen spec fitted on the whole panel."""
    return fit(panel, best, holidays=holidays)
