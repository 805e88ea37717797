"""Weighted vote of several forecasters, its backtest, and prediction intervals."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..params import cut_lineage, parameter_table
from .evaluation import TOP_N, combined_score, inverse_weights, metrics, roll_up, top_models
from .panel import by_segment
from .recurrence import folds, linear_forecast

ENSEMBLE = "voting_ensemble"

# The quantile pairs of the two forecast paths, and the fixed vote weights.
ENSEMBLE_QUANTILES = (0.025, 0.975)
SINGLE_QUANTILES = (0.1, 0.95)
FIXED_VOTE = {"naive_12": 1.0, "seasonal_2_3": 9.0, "boosted_even": 4.0}


def weight_table(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    rows = [(name, float(w)) for name, w in weights.items()]
    return parameter_table(spark, rows, ("model", "weight"))


def vote(forecasts: DataFrame, weights: DataFrame) -> DataFrame:
    """``sum(w * yhat) / sum(w)`` over the members that have a forecast, per segment and
    step (and fold); NULL when none has. ``weights(model, weight)`` has one row per
    member, so it is broadcast."""
    w = F.broadcast(weights.select("model", "weight"))
    present = F.when(F.col("yhat").isNotNull(), F.col("weight"))
    total = F.sum(present)
    return (
        forecasts.join(w, "model")
        .groupBy("segment", "fold", "h", "timestamp")
        .agg(
            F.max("actual").alias("actual"),
            F.when(total > 0, F.sum(F.col("weight") * F.col("yhat")) / total).alias("yhat"),
        )
        .select(
            F.lit(ENSEMBLE).alias("model"), F.lit(0).alias("candidate_no"),
            "fold", "segment", "h", "timestamp", "actual", "yhat",
        )
    )


def vote_backtest(bt: DataFrame, weights: DataFrame) -> DataFrame:
    """The ensemble's backtest from its members' backtest rows; nothing is refitted."""
    return vote(bt, weights)


def quantile_column(q: float) -> str:
    return f"target_{q:g}"


def residual_spread(bt: DataFrame) -> DataFrame:
    """``segment, sigma``: population standard deviation of the backtest residuals."""
    residual = F.col("actual") - F.col("yhat")
    return bt.groupBy("segment").agg(F.stddev_pop(residual).alias("sigma"))


def intervals(
    forecast: DataFrame, bt: DataFrame, quantiles: Sequence[float] = ENSEMBLE_QUANTILES
) -> DataFrame:
    """``segment, timestamp, target, target_<q>...``: bound(q) = yhat + z(q) * sigma.
    A segment without residuals has NULL bounds."""
    joined = forecast.join(residual_spread(bt), "segment", "left")
    return joined.select(
        "segment", "timestamp", F.col("yhat").alias("target"), *_bounds(quantiles)
    )


def _bounds(quantiles: Sequence[float]):
    return [
        (F.col("yhat") + F.lit(NormalDist().inv_cdf(q)) * F.col("sigma")).alias(quantile_column(q))
        for q in quantiles
    ]


def conformal_intervals(
    forecast: DataFrame, bt: DataFrame, quantiles: Sequence[float] = ENSEMBLE_QUANTILES
) -> DataFrame:
    """As :func:`intervals`, with bounds that assume nothing about how residuals are spread.

    Split-conformal: of a segment's n backtest residuals, the one of rank
    ceil((n + 1) * level) on the bound's side is how far the bound lies off, so that a new
    residual of the same kind stays within it with a chance of ``level`` or more. A segment
    with too few residuals for the level takes that rank among the residuals of all segments,
    each divided by the mean absolute one of the others of its segment (a new residual is not
    in that mean either) and scaled back. NULL if these are too few, or the segment has none. Ranks over all segments are exact up to 100,000 residuals
    and off by 1 in 100,000 beyond. Pass a stored ``bt``; it is read for their number.
    """
    off = F.col("actual") - F.col("yhat")
    rows = bt.filter(off.isNotNull()).select("segment", off.alias("off"))
    of = Window.partitionBy("segment")
    size, n = F.sum(F.abs("off")).over(of), F.count("off").over(of)
    rows = rows.withColumns({"n": n, "scale": size / n, "others": (size - F.abs("off")) / F.nullif(n - 1, F.lit(0))})
    total = rows.filter("others > 0").count()
    bounds, pooled = [], []
    for i, q in enumerate(quantiles):
        side, level = (-1, 1 - q) if q < 0.5 else (1, q)
        score = F.col("off") * side
        rows = rows.withColumns({f"s{i}": score, f"r{i}": F.row_number().over(of.orderBy(score))})
        bounds.append(F.max(F.when(F.col(f"r{i}") == F.ceil((F.col("n") + 1) * level - 1e-9), F.col(f"s{i}"))).alias(f"own{i}"))
        rank = math.ceil((total + 1) * level - 1e-9)
        ratio = F.when(F.col("others") > 0, score / F.col("others"))
        pooled.append(
            (F.percentile_approx(ratio, (rank - 0.5) / total, 100_000) if 0 < rank <= total else F.lit(None).cast("double")).alias(f"all{i}")
        )
    each = rows.groupBy("segment").agg(F.max("scale").alias("scale"), *bounds)
    off_by = rows.agg(*pooled)
    near = forecast.join(each, "segment", "left")
    for i, q in enumerate(quantiles):
        far = F.coalesce(f"own{i}", off_by.select(f"all{i}").scalar() * F.col("scale"))
        near = near.withColumn(quantile_column(q), F.col("yhat") + (far if q >= 0.5 else -far))
    return near.select(
        "segment", "timestamp", F.col("yhat").alias("target"), *[F.col(f"`{quantile_column(q)}`") for q in quantiles]
    )


def recurrence_ensemble(
    panel: DataFrame, specs: Sequence, horizon: int, n_folds: int = 3, top_n: int = TOP_N,
    quantiles: Sequence[float] = ENSEMBLE_QUANTILES,
) -> DataFrame:
    """Score all recurrence specs, vote the best and bound the vote.

    Test months and the months ahead come out of one pass over the panel. The scores and the
    vote both read these points, so they are stored. The residual spread is a window over a
    segment's (n_folds + 1) * horizon voted rows. Columns as from :func:`intervals`.
    """
    ends = [*folds(n_folds, horizon), (n_folds, 0, 0)]
    points = cut_lineage(linear_forecast(panel, specs, horizon, ends), "points")
    scores = combined_score(roll_up(metrics(points)))
    voted = vote(points, inverse_weights(top_models(scores, top_n)))
    sigma = F.stddev_pop(F.col("actual") - F.col("yhat")).over(by_segment())
    return voted.withColumn("sigma", sigma).filter(F.col("fold") == n_folds).select(
        "segment", "timestamp", F.col("yhat").alias("target"), *_bounds(quantiles)
    )


def as_forecast(
    with_bounds: DataFrame, quantiles: Sequence[float] = ENSEMBLE_QUANTILES
) -> DataFrame:
    """Forecast table with the lowest and highest quantile as ``target_lower/upper``."""
    return with_bounds.select(
        "segment", "timestamp", "target",
        F.col(f"`{quantile_column(min(quantiles))}`").alias("target_lower"),
        F.col(f"`{quantile_column(max(quantiles))}`").alias("target_upper"),
    )
