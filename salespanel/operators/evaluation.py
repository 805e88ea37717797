"""Error metrics, their roll-up, the combined score and the choice of models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

METRICS = ("mae", "mse", "rmse", "smape", "mape")

# Weights of MAE, RMSE, SMAPE and MAPE in the combined score.
SCORE_WEIGHTS = (0.4, 0.3, 0.2, 0.1)
TOP_N = 5


def metrics(bt: DataFrame, eps: float = 1e-15, mape_zero: str = "clip") -> DataFrame:
    """Per (model, fold, segment), over rows that have an actual and a forecast.

    A zero actual makes MAPE divide by ``eps`` (``mape_zero='clip'``, which lets such
    rows dominate) or is left out of MAPE (``'skip'``).
    """
    if mape_zero not in ("clip", "skip"):
        raise ValueError(f"mape_zero must be 'clip' or 'skip', not {mape_zero!r}")
    a, f = F.col("actual"), F.col("yhat")
    e = a - f
    size = F.greatest(F.abs(a) + F.abs(f), F.lit(eps))
    share = F.abs(e) / F.greatest(F.abs(a), F.lit(eps))
    if mape_zero == "skip":
        share = F.when(a != 0, share)
    return (
        bt.filter(a.isNotNull() & f.isNotNull())
        .groupBy("segment", "model", "candidate_no", "fold")
        .agg(
            F.avg(F.abs(e)).alias("mae"),
            F.avg(e * e).alias("mse"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            (F.avg(2 * F.abs(e) / size) * 100).alias("smape"),
            (F.avg(share) * 100).alias("mape"),
        )
        .select("model", "candidate_no", "fold", "segment", *METRICS)
    )


def metrics_per_segment(m: DataFrame) -> DataFrame:
    """Mean over folds."""
    return m.groupBy("segment", "model", "candidate_no").agg(*[F.avg(c).alias(c) for c in METRICS])


def roll_up(m: DataFrame) -> DataFrame:
    """One row per model: mean over folds per segment, then mean over segments."""
    return (
        metrics_per_segment(m)
        .groupBy("model", "candidate_no")
        .agg(*[F.avg(c).alias(c) for c in METRICS])
    )


def combined_score(rolled: DataFrame, weights: Sequence[float] = SCORE_WEIGHTS) -> DataFrame:
    parts = zip(weights, ("mae", "rmse", "smape", "mape"))
    return rolled.withColumn("score", sum(F.lit(float(w)) * F.col(c) for w, c in parts))


def top_models(scored: DataFrame, n: int = TOP_N, dedupe: bool = False) -> DataFrame:
    """The ``n`` lowest scores; ties go to the earlier candidate.

    Scores are compared at nine decimals: two specs can be the same model (a lag-3 naive
    and a one-value season-3 average), and float noise must not order them. ``dedupe``
    keeps just the first of equal scores.
    """
    ranked = scored.filter(F.col("score").isNotNull()).withColumn("_key", F.round("score", 9))
    if dedupe:
        # One row per candidate model, so this window sees a handful of rows.
        first = F.row_number().over(W.partitionBy("_key").orderBy("candidate_no"))
        ranked = ranked.withColumn("_first", first).filter("_first = 1").drop("_first")
    return ranked.orderBy("_key", "candidate_no").limit(n).drop("_key")


def inverse_weights(top: DataFrame) -> DataFrame:
    """``model, candidate_no, weight`` with weights proportional to 1/score, summing to 1.
    Models with score 0 share all the weight."""
    zero = F.col("score") == 0
    # At most n rows reach this window.
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    zeros = F.sum(F.when(zero, 1).otherwise(0)).over(everything)
    inverse = F.when(~zero, F.lit(1.0) / F.col("score"))
    weight = F.when(
        zeros > 0, F.when(zero, F.lit(1.0) / zeros).otherwise(F.lit(0.0))
    ).otherwise(inverse / F.sum(inverse).over(everything))
    return top.select("model", "candidate_no", weight.alias("weight"))
