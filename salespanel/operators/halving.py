"""Search over boosted-tree settings by successive halving with asynchronous promotion.

Every trial is first fitted with a small share of its trees; of the trials scored at a share, the
best one in ``eta`` goes on to the next share. A trial is promoted as soon as it is among those,
without waiting for the others of its rung, so that the cluster stays busy. Training and test
rows of the folds are made, binned and assembled once and stored; all fits of all trials read
these tables. Only one score per fit set comes to the driver.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.feature import QuantileDiscretizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage, parameter_table
from .attributes import Attributes
from .evaluation import metrics
from .features import unlog
from .learned import estimator, fold_tables, segment_codes
from .recurrence import folds
from .specs import Boosted
from .tuning import N_FOLDS, N_TRIALS, SEED, SPACE, draw

ETA = 3
N_RUNGS = 4
MOST_BINS = 512


class Rungs:
    """Which trial is to be fitted next, and with which share of its trees.

    Trials start in order of their number. A trial is promoted when it is among the best
    ``len(rung) // eta`` of the scored ones of its rung; higher rungs come first. When nothing
    else is left and the top is empty, the best of the highest rung goes on, so that some trial
    is always scored with all its trees. A trial without a score is never promoted.
    """

    def __init__(self, n_trials: int, n_rungs: int = N_RUNGS, eta: int = ETA):
        if n_trials < 1 or n_rungs < 1 or eta < 2:
            raise ValueError("halving needs a trial, a rung, and an eta of 2 or more")
        self.n_trials, self.top, self.eta = n_trials, n_rungs - 1, eta
        self.scores: list[dict[int, float | None]] = [{} for _ in range(n_rungs)]
        self.promoted: list[set[int]] = [set() for _ in range(n_rungs)]
        self.started = self.running = 0

    def ranked(self, rung: int) -> list[int]:
        scored = {t: s for t, s in self.scores[rung].items() if s is not None}
        return sorted(scored, key=lambda t: (scored[t], t))

    def _promote(self, rung: int, among: int) -> tuple[int, int] | None:
        for trial in self.ranked(rung)[:among]:
            if trial not in self.promoted[rung]:
                self.promoted[rung].add(trial)
                self.running += 1
                return trial, rung + 1
        return None

    def next(self) -> tuple[int, int] | None:
        """(trial, rung), or None if there is nothing to start before a running fit ends."""
        for rung in reversed(range(self.top)):
            if job := self._promote(rung, len(self.scores[rung]) // self.eta):
                return job
        if self.started < self.n_trials:
            self.started += 1
            self.running += 1
            return self.started - 1, 0
        if not self.running and not self.scores[self.top]:
            highest = max((r for r in range(self.top) if self.ranked(r)), default=None)
            return None if highest is None else self._promote(highest, 1)
        return None

    def done(self, trial: int, rung: int, score: float | None) -> None:
        self.running -= 1
        self.scores[rung][trial] = score

    def best(self) -> int | None:
        """The best trial of the top rung."""
        return next(iter(self.ranked(self.top)), None)


def run_rungs(rungs: Rungs, score: Callable[[int, int], float | None], parallelism: int) -> list:
    """(trial, rung, score) in the order of their ends, with at most ``parallelism`` running."""
    ended, running = [], {}
    with ThreadPoolExecutor(parallelism) as pool:
        while True:
            while len(running) < parallelism and (job := rungs.next()):
                running[pool.submit(score, *job)] = job
            if not running:
                return ended
            over, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in sorted(over, key=running.__getitem__):
                job = running.pop(future)
                rungs.done(*job, future.result())
                ended.append((*job, rungs.scores[job[1]][job[0]]))


def binned_folds(
    panel: DataFrame, horizon: int, n_folds: int, holidays: DataFrame | None = None,
    attributes: Attributes | None = None, bins: int = MOST_BINS,
) -> list[tuple[int, DataFrame, DataFrame]]:
    """(fold, training rows, test rows), stored with the vector ``features``. Each feature is the
    number of its quantile bin among the training rows; one with at most ``bins`` values keeps
    them apart, and trees split the numbers as they would the values."""
    codes, out = cut_lineage(segment_codes(panel), "segment-codes"), []
    for end in folds(n_folds, horizon, "constant"):
        train, test = fold_tables(panel, codes, horizon, end, holidays, attributes)
        inputs = [c for c in train.columns if c != "y"]
        cut = QuantileDiscretizer(
            inputCols=inputs, outputCols=[f"bin_{c}" for c in inputs], numBuckets=bins,
            relativeError=0.25 / bins, handleInvalid="keep",
        )
        cutter, whole = cut.fit(train), VectorAssembler(inputCols=inputs, outputCol="features")

        def binned(rows: DataFrame, *kept: str) -> DataFrame:
            # Without their metadata the bins are numbers in order, not categories.
            bins_only = [F.col(f"bin_{c}").alias(c, metadata={}) for c in inputs]
            return whole.transform(cutter.transform(rows).select(*kept, *bins_only)).drop(*inputs)

        out.append((
            end[0],
            cut_lineage(binned(train, "y"), "binned-train"),
            cut_lineage(binned(test, "segment", "timestamp", "actual", "h"), "binned-test"),
        ))
    return out


def _mean_rmse(tables, spec: Boosted) -> float | None:
    """Mean over folds of the mean RMSE over segments: a fit per fold and one job for the rest."""
    scored = reduce(DataFrame.unionByName, [
        estimator(spec).fit(train).transform(test).select(
            F.lit(spec.name).alias("model"), F.lit(0).alias("candidate_no"),
            F.lit(fold).alias("fold"), "segment", "actual", unlog("prediction").alias("yhat"),
        )
        for fold, train, test in tables
    ])
    by_fold = metrics(scored).groupBy("fold").agg(F.avg("rmse").alias("rmse"))
    return by_fold.agg(F.avg("rmse")).first()[0]


def search_halving(
    panel: DataFrame, horizon: int, space: dict = SPACE, n_trials: int = N_TRIALS,
    n_folds: int = N_FOLDS, seed: int = SEED, n_rungs: int = N_RUNGS, eta: int = ETA,
    holidays: DataFrame | None = None, attributes: Attributes | None = None, parallelism: int = 1,
) -> tuple[Boosted, DataFrame]:
    """(best spec, fits). Trials are drawn from ``seed`` as those of :func:`tuning.search`; the
    score is the mean RMSE over constant-length folds and segments. On rung ``r`` a trial has
    ``eta ** (r + 1 - n_rungs)`` of its trees (at least one).

    ``fits`` has ``trial, rung, trees, rmse, ended`` (number in order of the ends) and a column
    per searched setting, a row per scored (trial, rung). Which trials are promoted depends on
    which fits end first, so they repeat by seed with ``parallelism`` 1 only (scores are sums over
    tasks, the same but for their last bits). Folds without any scored row raise.
    """
    rng = random.Random(seed)
    draws = [draw(space, rng) for _ in range(n_trials)]
    specs = [Boosted(**d, seed=seed, name=f"trial_{i}") for i, d in enumerate(draws)]
    rungs = Rungs(n_trials, n_rungs, eta)
    most = max(MOST_BINS, *(s.max_bins for s in specs))
    tables = binned_folds(panel, horizon, n_folds, holidays, attributes, most)

    def at(trial: int, rung: int) -> Boosted:
        trees = math.ceil(specs[trial].max_iter / eta ** (n_rungs - 1 - rung))
        return replace(specs[trial], max_iter=trees)

    one = inheritable_thread_target(panel.sparkSession)(lambda t, r: _mean_rmse(tables, at(t, r)))
    ended = run_rungs(rungs, one, parallelism)
    if rungs.best() is None:
        raise ValueError("no trial could be scored: the panel is too short for the folds")
    rows = [
        (trial, rung, at(trial, rung).max_iter, rmse, n, *draws[trial].values())
        for n, (trial, rung, rmse) in enumerate(ended)
    ]
    names = ("trial", "rung", "trees", "rmse", "ended", *space)
    return specs[rungs.best()], parameter_table(panel.sparkSession, rows, names)
