"""Models, backtests, ensemble and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clip0_fill, clip0_keep
from ..operators.ensemble import (
    SINGLE_QUANTILES,
    conformal_intervals,
    recurrence_ensemble,
    vote,
    vote_backtest,
    weight_table,
)
from ..operators.evaluation import (
    METRICS,
    combined_score,
    inverse_weights,
    metrics,
    roll_up,
    top_models,
)
from ..operators.forecasting import backtest, forecast
from ..operators.halving import search_halving
from ..operators.learned import learned_forecast
from ..operators.recurrence import linear_forecast
from ..operators.specs import BOOSTED, CLASSICAL, Linear, Naive, SeasonalMA
from ..operators.tuning import SPACE, refit, search
from ..params import cut_lineage
from ..plans import select_ensemble
from .registry import Registry
from .tables import (
    AHEAD,
    BACKTEST,
    ENSEMBLE,
    ENSEMBLE_POINTS,
    HORIZON,
    IMPUTED,
    METRICS as METRICS_SQL,
    MODELS,
    PANEL,
    ROLLED,
    SELECTION,
    forecast_sql,
    sales_panel,
)

query = Registry()


def rounded(df, *columns, places=4):
    return df.withColumns({c: F.round(c, places) for c in columns})


POINTS = """SELECT model, fold, segment, h, ts AS "timestamp", actual,
       round(yhat, 4) + 0.0 AS yhat FROM points"""

AHEAD_POINTS = """SELECT model, segment, h, ts AS "timestamp", round(yhat, 4) + 0.0 AS yhat
FROM ahead"""


@query(f"""WITH {IMPUTED}, {MODELS}, {AHEAD} {AHEAD_POINTS} WHERE model LIKE 'naive%'""")
def naive_forecast(spark, sf_dir):
    specs = [Naive(lag) for lag in (1, 3, 6, 12)]
    points = linear_forecast(sales_panel(spark, sf_dir), specs, HORIZON)
    return rounded(points, "yhat").drop("candidate_no", "fold", "actual")


@query(f"""WITH {IMPUTED}, {MODELS}, {AHEAD} {AHEAD_POINTS} WHERE model LIKE 'seasonal%'""")
def seasonal_average_forecast(spark, sf_dir):
    specs = [SeasonalMA(w, s) for w, s in ((1, 3), (1, 6), (2, 3), (2, 6))]
    points = linear_forecast(sales_panel(spark, sf_dir), specs, HORIZON)
    return rounded(points, "yhat").drop("candidate_no", "fold", "actual")


@query(f"""WITH {IMPUTED}, {MODELS}, {AHEAD}
SELECT model, candidate_no, segment, h, ts AS "timestamp", round(yhat, 4) + 0.0 AS yhat
FROM ahead""")
def classical_forecast(spark, sf_dir):
    points = forecast(sales_panel(spark, sf_dir), CLASSICAL, HORIZON)
    return rounded(points, "yhat").drop("fold", "actual")


@query(f"WITH {BACKTEST} {POINTS}")
def backtest_expanding(spark, sf_dir):
    points = backtest(sales_panel(spark, sf_dir), CLASSICAL, HORIZON)
    return rounded(points, "yhat").drop("candidate_no")


CONSTANT_FOLDS = "(0, 15), (1, 12), (2, 9), (3, 6), (4, 3)"
CONSTANT = f"""{PANEL},
starts(fold_no, train_start) AS (VALUES (0, 0), (1, 3), (2, 6), (3, 9), (4, 12)),
per_fold AS (
  SELECT fold_no, segment, t_idx, from_end, log10(target + 1) AS ylog
  FROM panel JOIN starts ON t_idx >= train_start),
imputed_per_fold AS (
  SELECT *, coalesce(ylog, avg(ylog) OVER (
    PARTITION BY fold_no, segment ORDER BY t_idx
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS y
  FROM per_fold), {forecast_sql(CONSTANT_FOLDS, "imputed_per_fold", fold_key=True)}"""


@query(f"WITH {CONSTANT} {POINTS}")
def backtest_constant_length(spark, sf_dir):
    panel = sales_panel(spark, sf_dir)
    points = backtest(panel, CLASSICAL, HORIZON, n_folds=5, mode="constant")
    return rounded(points, "yhat").drop("candidate_no")


METRIC_COLUMNS = ", ".join(f"round({m}, 4) + 0.0 AS {m}" for m in METRICS)


def _backtest(spark, sf_dir):
    return backtest(sales_panel(spark, sf_dir), CLASSICAL, HORIZON)


def _scored(spark, sf_dir):
    return combined_score(roll_up(metrics(_backtest(spark, sf_dir))))


@query(f"""WITH {BACKTEST}, {METRICS_SQL}
SELECT model, fold, segment, {METRIC_COLUMNS} FROM metrics""")
def fold_metrics(spark, sf_dir):
    return rounded(metrics(_backtest(spark, sf_dir)), *METRICS).drop("candidate_no")


@query(f"""WITH {BACKTEST}, {METRICS_SQL}, {ROLLED}
SELECT model, {METRIC_COLUMNS} FROM rolled""")
def metric_roll_up(spark, sf_dir):
    return rounded(roll_up(metrics(_backtest(spark, sf_dir))), *METRICS).drop("candidate_no")


@query(f"""WITH {BACKTEST}, {METRICS_SQL}, {ROLLED}
SELECT model, round(score, 4) AS score FROM scored""")
def combined_scores(spark, sf_dir):
    return rounded(_scored(spark, sf_dir), "score").select("model", "score")


@query(f"""WITH {SELECTION} SELECT model, candidate_no, round(score, 4) AS score FROM top5""")
def best_five_models(spark, sf_dir):
    top = top_models(_scored(spark, sf_dir))
    return rounded(top, "score").select("model", "candidate_no", "score")


@query(f"""WITH {BACKTEST}, {METRICS_SQL}, {ROLLED},
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY round(score, 9) ORDER BY candidate_no) AS k
  FROM scored)
SELECT model, candidate_no, round(score, 4) AS score FROM firsts WHERE k = 1
ORDER BY round(score, 9), candidate_no LIMIT 5""")
def best_distinct_models(spark, sf_dir):
    top = top_models(_scored(spark, sf_dir), dedupe=True)
    return rounded(top, "score").select("model", "candidate_no", "score")


@query(f"""WITH {SELECTION} SELECT model, candidate_no, round(weight, 6) AS weight FROM weights""")
def ensemble_weights(spark, sf_dir):
    weights = inverse_weights(top_models(_scored(spark, sf_dir)))
    return rounded(weights, "weight", places=6)


@query(f"""WITH {ENSEMBLE}
SELECT segment, h, ts AS "timestamp", round(yhat, 4) + 0.0 AS yhat FROM voted""")
def ensemble_forecast(spark, sf_dir):
    panel = sales_panel(spark, sf_dir)
    weights = inverse_weights(top_models(_scored(spark, sf_dir)))
    voted = vote(forecast(panel, CLASSICAL, HORIZON), weights)
    return rounded(voted, "yhat").select("segment", "h", "timestamp", "yhat")


@query(f"""WITH {IMPUTED}, {MODELS}, {AHEAD},
fixed(model, weight) AS (VALUES ('naive_12', 1.0::DOUBLE), ('seasonal_2_3', 9.0), ('naive_1', 4.0))
SELECT segment, h, ts AS "timestamp",
       round(sum(weight * yhat) / sum(CASE WHEN yhat IS NOT NULL THEN weight END), 4) + 0.0 AS yhat
FROM ahead JOIN fixed USING (model) GROUP BY ALL""")
def fixed_weight_vote(spark, sf_dir):
    specs = [Naive(12), SeasonalMA(2, 3), Naive(1)]
    points = forecast(sales_panel(spark, sf_dir), specs, HORIZON)
    voted = vote(points, weight_table(spark, {"naive_12": 1, "seasonal_2_3": 9, "naive_1": 4}))
    return rounded(voted, "yhat").select("segment", "h", "timestamp", "yhat")


ENSEMBLE_METRICS = f"""{SELECTION}, {ENSEMBLE_POINTS},
ensemble_points AS (
  SELECT 'voting_ensemble' AS model, 0 AS candidate_no, fold, segment, actual, yhat FROM voted_bt),
{METRICS_SQL.replace("metrics AS", "ensemble_metrics AS").replace("FROM points", "FROM ensemble_points")},
ensemble_segments AS (
  SELECT model, segment, avg(mae) AS mae, avg(mse) AS mse, avg(rmse) AS rmse,
         avg(smape) AS smape, avg(mape) AS mape
  FROM ensemble_metrics GROUP BY ALL)"""


@query(f"""WITH {ENSEMBLE_METRICS}
SELECT model, {", ".join(f"round(avg({m}), 4) AS {m}" for m in METRICS)}
FROM ensemble_segments GROUP BY model""")
def ensemble_backtest(spark, sf_dir):
    bt = _backtest(spark, sf_dir)
    weights = inverse_weights(top_models(_scored(spark, sf_dir)))
    return rounded(roll_up(metrics(vote_backtest(bt, weights))), *METRICS).drop("candidate_no")


@query(f"""WITH {ENSEMBLE}
SELECT segment, ts AS "timestamp", round(target, 4) + 0.0 AS target,
       round(lower_bound, 4) + 0.0 AS "target_0.025",
       round(upper_bound, 4) + 0.0 AS "target_0.975" FROM bounded""")
def prediction_intervals(spark, sf_dir):
    bounded = recurrence_ensemble(sales_panel(spark, sf_dir), CLASSICAL, HORIZON)
    return bounded.select(
        "segment", "timestamp",
        *[F.round(f"`{c}`", 4).alias(c) for c in bounded.columns[2:]],
    )


@query(f"""WITH {ENSEMBLE}
SELECT segment, ts AS "timestamp", round(greatest(target, 0), 4) + 0.0 AS target,
       CASE WHEN lower_bound IS NOT NULL THEN round(greatest(lower_bound, 0), 4) + 0.0 END AS target_lower,
       CASE WHEN upper_bound IS NOT NULL THEN round(greatest(upper_bound, 0), 4) + 0.0 END AS target_upper
FROM bounded""")
def clipped_forecast(spark, sf_dir):
    bounded = recurrence_ensemble(sales_panel(spark, sf_dir), CLASSICAL, HORIZON)
    return bounded.select(
        "segment", "timestamp", F.round(clip0_fill("target"), 4).alias("target"),
        F.round(clip0_keep("`target_0.025`"), 4).alias("target_lower"),
        F.round(clip0_keep("`target_0.975`"), 4).alias("target_upper"),
    )


@query(f"""WITH {SELECTION}, {ENSEMBLE_POINTS}, {AHEAD},
voted AS (
  SELECT segment, h, ts,
         sum(weight * yhat) / sum(CASE WHEN yhat IS NOT NULL THEN weight END) AS yhat
  FROM ahead JOIN weights USING (model) GROUP BY ALL),
off AS (
  SELECT segment, actual - yhat AS e, avg(abs(actual - yhat)) OVER (PARTITION BY segment) AS scale,
         (sum(abs(actual - yhat)) OVER (PARTITION BY segment) - abs(actual - yhat))
           / nullif(count(*) OVER (PARTITION BY segment) - 1, 0) AS others,
         count(*) OVER (PARTITION BY segment) AS n,
         row_number() OVER (PARTITION BY segment ORDER BY actual - yhat) AS up,
         row_number() OVER (PARTITION BY segment ORDER BY yhat - actual) AS down
  FROM voted_bt WHERE actual IS NOT NULL AND yhat IS NOT NULL),
own AS (
  SELECT segment, any_value(scale) AS scale,
         max(-e) FILTER (down = ceil((n + 1) * 0.9 - 1e-9)) AS low,
         max(e) FILTER (up = ceil((n + 1) * 0.95 - 1e-9)) AS high
  FROM off GROUP BY segment),
pool AS (
  SELECT count(*) AS n, list_sort(list(-e / others)) AS low, list_sort(list(e / others)) AS high
  FROM off WHERE others > 0)
SELECT v.segment, v.ts AS "timestamp", round(v.yhat, 4) + 0.0 AS target,
       round(v.yhat - coalesce(o.low, o.scale * p.low[CAST(ceil((p.n + 1) * 0.9 - 1e-9) AS BIGINT)]), 4) + 0.0 AS "target_0.1",
       round(v.yhat + coalesce(o.high, o.scale * p.high[CAST(ceil((p.n + 1) * 0.95 - 1e-9) AS BIGINT)]), 4) + 0.0 AS "target_0.95"
FROM voted v LEFT JOIN own o USING (segment) CROSS JOIN pool p""")
def conformal_bounds(spark, sf_dir):
    """Bounds of the ensemble by ranks of its backtest residuals; with nine residuals a
    segment has its own lower bound and takes the upper one from all segments."""
    panel = cut_lineage(sales_panel(spark, sf_dir))
    chosen, weights, bt = select_ensemble(panel, CLASSICAL, HORIZON)
    table = weight_table(spark, weights)
    ahead = vote(forecast(panel, chosen, HORIZON), table)
    tested = cut_lineage(vote_backtest(bt, table), "ensemble-backtest")
    bounded = conformal_intervals(ahead, tested, SINGLE_QUANTILES)
    return bounded.select(
        "segment", "timestamp", *[F.round(f"`{c}`", 4).alias(c) for c in bounded.columns[2:]]
    )


# Trained models have no SQL twin; these are checked by property tests.
@query()
def boosted_forecast(spark, sf_dir):
    panel = cut_lineage(sales_panel(spark, sf_dir))
    return forecast(panel, BOOSTED, HORIZON)


@query()
def boosted_backtest(spark, sf_dir):
    panel = cut_lineage(sales_panel(spark, sf_dir))
    return backtest(panel, BOOSTED, HORIZON)


@query()
def linear_model_forecast(spark, sf_dir):
    panel = cut_lineage(sales_panel(spark, sf_dir))
    return forecast(panel, [Linear(reg_param=0.01, elastic_net=0.5)], HORIZON)


@query()
def settings_search(spark, sf_dir):
    panel = cut_lineage(sales_panel(spark, sf_dir))
    space = {"max_iter": ("int", 1, 3), "step_size": ("log", 0.05, 0.8), "max_depth": ("int", 2, 3)}
    _, trials = search(panel, HORIZON, space, n_trials=3, n_folds=2, prune=True)
    return trials


@query()
def settings_search_halving(spark, sf_dir):
    """27 trials on five folds; a trial has a ninth, a third or all of its trees."""
    panel = cut_lineage(sales_panel(spark, sf_dir))
    space = {**SPACE, "max_iter": ("int", 3, 9), "max_depth": ("int", 2, 4)}
    _, fits = search_halving(panel, HORIZON, space, n_trials=27, n_rungs=3, parallelism=4)
    return fits


@query()
def refitted_best_forecast(spark, sf_dir):
    panel = cut_lineage(sales_panel(spark, sf_dir))
    space = {"max_iter": ("int", 1, 2), "max_depth": ("int", 2, 3)}
    best, _ = search(panel, HORIZON, space, n_trials=2, n_folds=1)
    return learned_forecast(panel, {best.name: refit(panel, best)}, {best.name: 0}, HORIZON)
