"""Whole runs, from stored table to stored result. Each step that is read more than once
is written to the run's folder first, so a lost executor costs one step, not the run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.accuracy import accuracy_detail, accuracy_summary
from ..operators.attributes import Attributes
from ..operators.cleaning import stage_upload
from ..operators.ensemble import (
    ENSEMBLE_QUANTILES,
    SINGLE_QUANTILES,
    as_forecast,
    conformal_intervals,
    intervals,
    vote,
    vote_backtest,
    weight_table,
)
from ..operators.evaluation import (
    TOP_N,
    combined_score,
    inverse_weights,
    metrics,
    roll_up,
    top_models,
)
from ..operators.forecasting import backtest, forecast, split_specs
from ..operators.halving import search_halving
from ..operators.incremental import cast_ahead, cast_backtest, cast_origins
from ..operators.learned import attribute_sums, learned_backtest, segment_codes
from ..operators.learned import fit as fit_learned
from ..operators.panel import regularise
from ..operators.recurrence import folds
from ..operators.report import combined_report
from ..operators.specs import CANDIDATES
from ..operators.summary import (
    attach_meta,
    clip_quantiles,
    forecast_summary,
    latest_attributes,
    quantile_totals,
)
from ..operators.tuning import SPACE, search
from ..functions import clip0_fill
from ..params import cut_lineage
from ..sources import (
    load_model,
    load_specs,
    read_forecast,
    read_panel,
    read_report,
    read_upload,
    save_model,
    save_specs,
    write_forecast,
    write_invalid,
    write_panel,
    write_report,
)


def upload_job(
    spark: SparkSession, upload_path: str, out: str, on_bad: str = "fail",
    rejected_path: str | None = None, key_share: float | None = None,
) -> dict[str, int]:
    """Raw upload to a prepared panel table; rejected rows go to ``rejected_path``. The upload is
    read once. Returns the number of ``panel`` and ``rejected`` rows."""
    staged = stage_upload(read_upload(spark, upload_path), on_bad, key_share)
    write_panel(staged.panel, out)
    if on_bad == "quarantine" and rejected_path:
        write_invalid(staged.rejected, rejected_path)
    return {"panel": staged.n_panel, "rejected": staged.n_rejected}


def _stored_panel(spark: SparkSession, panel_path: str, folder: str) -> DataFrame:
    rows = read_panel(spark, panel_path).select("segment", "timestamp", "target")
    regularise(rows, drop_zero=True).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def _stored_codes(panel: DataFrame, folder: str) -> DataFrame:
    """The segment codes that models are fitted with, kept beside them."""
    segment_codes(panel).write.mode("overwrite").parquet(folder)
    return panel.sparkSession.read.parquet(folder)


def _stored_attributes(
    spark: SparkSession, panel_path: str, columns: Sequence[str], folder: str
) -> Attributes | None:
    """The values of some columns of the raw rows over time, one row per segment and time."""
    if not columns:
        return None
    rows = read_panel(spark, panel_path)
    changes = rows.groupBy("segment", "timestamp").agg(*[F.max(f"`{c}`").alias(c) for c in columns])
    changes.write.mode("overwrite").parquet(folder)
    return Attributes(spark.read.parquet(folder), tuple(columns))


def _described(
    spark: SparkSession, panel_path: str, columns: Sequence[str], folder: str
) -> DataFrame | None:
    """``segment, department, article``: the latest value of the two columns per segment."""
    if not columns:
        return None
    department, article = columns
    meta = latest_attributes(read_panel(spark, panel_path), cols=[department, article])
    meta.select(
        "segment", F.col(f"`{department}`").alias("department"), F.col(f"`{article}`").alias("article")
    ).write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def _write_summaries(bounded: DataFrame, meta: DataFrame | None, out: str) -> None:
    """Sums per department and article, and of every quantile. Without metadata the two are
    the parts of the segment."""
    described = bounded if meta is None else attach_meta(bounded, meta)
    forecast_summary(described, ordered=False).write.mode("overwrite").parquet(f"{out}/summary")
    quantile_totals(described).write.mode("overwrite").parquet(f"{out}/quantile_totals")


def select_ensemble(
    panel: DataFrame, specs: Sequence, horizon: int, n_folds: int = 3, top_n: int = TOP_N,
    holidays: DataFrame | None = None, bt: DataFrame | None = None,
) -> tuple[list, dict[str, float], DataFrame]:
    """(chosen specs, weight by name, all backtest rows). One row per chosen model, at
    most ``top_n``, comes back to the driver."""
    if bt is None:
        bt = backtest(panel, specs, horizon, n_folds, holidays=holidays)
    chosen = inverse_weights(top_models(combined_score(roll_up(metrics(bt))), top_n))
    rows = sorted(chosen.collect(), key=lambda r: (-r.weight, r.candidate_no))
    by_name = {s.name: s for s in specs}
    return [by_name[r.model] for r in rows], {r.model: r.weight for r in rows}, bt


def _clipped(with_bounds: DataFrame, quantiles) -> DataFrame:
    """What is stored: no negative values; a missing bound stays missing."""
    clean = clip_quantiles(with_bounds).withColumn("target", clip0_fill("target"))
    return as_forecast(clean, quantiles)


def refresh_job(
    spark: SparkSession, panel_path: str, out: str, horizon: int, specs: Sequence = CANDIDATES,
    n_folds: int = 3, top_n: int = TOP_N, quantiles: Sequence[float] = ENSEMBLE_QUANTILES,
    holidays: DataFrame | None = None, layout: str = "rows", attributes: Sequence[str] = (),
    metadata: Sequence[str] = (), conformal: bool = False, keep_casts: bool = False,
    since: str | None = None,
) -> dict[str, float]:
    """Backtest all candidates, keep the best, store the ensemble and its forecast.

    Under ``out``: ``panel``, ``backtest``, ``scores``, ``model`` (specs, fitted learned models
    and what they need), ``ensemble_scores``, ``forecast``, ``summary`` (per department and
    article) and ``quantile_totals``. Returns the weights. ``attributes`` are columns of the
    panel table that learned models use, as known at the time. ``metadata`` names the two
    columns that say a segment's department and article in the summary; the latest values count.
    Bounds are normal ones, or ``conformal`` ones.

    ``keep_casts`` stores the recurrence forecasts by origin, ``casts`` and ``digests``. ``since``
    is the ``out`` of an earlier run that did, and implies it: forecasts that rest on the same
    months are taken from there. Scores, weights and bounds are made of all rows, so the result
    is that of a whole refresh. Learned models span all segments and are always fitted anew.
    """
    if since is not None and since.rstrip("/") == out.rstrip("/"):
        raise ValueError("a run cannot overwrite the one it starts from")
    panel = _stored_panel(spark, panel_path, f"{out}/panel")
    known = _stored_attributes(spark, panel_path, attributes, f"{out}/attributes")
    meta = _described(spark, panel_path, metadata, f"{out}/metadata")
    fixed, fixed_no, learned, learned_no = split_specs(specs)
    casts = None
    if (keep_casts or since is not None) and fixed:
        ends = folds(n_folds, horizon)
        casts = cast_origins(panel, fixed, horizon, [*ends, (n_folds, 0, 0)], out, since)
        tested = cast_backtest(casts, panel, fixed, ends, fixed_no)
        if learned:
            part = learned_backtest(panel, learned, learned_no, horizon, ends, holidays, known)
            tested = tested.unionByName(part)
    else:
        tested = backtest(panel, specs, horizon, n_folds, holidays=holidays, attributes=known)
    tested.write.mode("overwrite").parquet(f"{out}/backtest")
    bt = spark.read.parquet(f"{out}/backtest")
    combined_score(roll_up(metrics(bt))).write.mode("overwrite").parquet(f"{out}/scores")
    chosen, weights, _ = select_ensemble(panel, specs, horizon, n_folds, top_n, bt=bt)
    table = weight_table(spark, weights)
    ensemble_bt = vote_backtest(bt, table)
    roll_up(metrics(ensemble_bt)).write.mode("overwrite").parquet(f"{out}/ensemble_scores")
    codes = _stored_codes(panel, f"{out}/model/segment_codes")
    models = {
        s.name: fit_learned(panel, s, codes, holidays, known)
        for s in chosen if not hasattr(s, "recurrence")
    }
    sums = None
    if known:
        attribute_sums(panel, known).write.mode("overwrite").parquet(f"{out}/model/attribute_sums")
        sums = spark.read.parquet(f"{out}/model/attribute_sums")
    for name, model in models.items():
        save_model(model, f"{out}/model/learned/{name}")
    settings = {
        "horizon": horizon, "n_folds": n_folds, "quantiles": list(quantiles),
        "attributes": list(attributes), "conformal": conformal,
    }
    save_specs(spark, chosen, weights, settings, f"{out}/model/specs")
    anew = [s for s in chosen if casts is None or not hasattr(s, "recurrence")]
    members = [forecast(panel, anew, horizon, models, holidays, codes, known, sums)] if anew else []
    if len(anew) < len(chosen):
        members.append(cast_ahead(casts, panel, [s for s in chosen if s not in anew]))
    ahead = vote(reduce(DataFrame.unionByName, members), table)
    if conformal:
        bounded = conformal_intervals(ahead, cut_lineage(ensemble_bt, "ensemble-backtest"), quantiles)
    else:
        bounded = intervals(ahead, ensemble_bt, quantiles)
    bounded = cut_lineage(bounded, "bounded")
    write_forecast(_clipped(bounded, quantiles), f"{out}/forecast", layout, mode="overwrite")
    _write_summaries(bounded, meta, out)
    return weights


def tune_job(
    spark: SparkSession, panel_path: str, out: str, horizon: int, n_trials: int = 100,
    n_folds: int = 5, seed: int = 42, space: dict = SPACE, prune: bool = True,
    holidays: DataFrame | None = None, parallelism: int = 1, halving: bool = False,
):
    """Search boosted-tree settings, refit the best on all data, store model and trials. With
    ``halving`` most trials see a share of their trees only, and ``trials`` has a row per fit."""
    panel = _stored_panel(spark, panel_path, f"{out}/panel")
    if halving:
        best, trials = search_halving(
            panel, horizon, space, n_trials, n_folds, seed, holidays=holidays, parallelism=parallelism
        )
    else:
        best, trials = search(
            panel, horizon, space, n_trials, n_folds, seed, prune, holidays=holidays,
            parallelism=parallelism,
        )
    trials.write.mode("overwrite").parquet(f"{out}/trials")
    codes = _stored_codes(panel, f"{out}/model/segment_codes")
    save_model(fit_learned(panel, best, codes, holidays), f"{out}/model/learned/{best.name}")
    settings = {"horizon": horizon, "n_folds": 3, "quantiles": list(SINGLE_QUANTILES)}
    save_specs(spark, [best], {best.name: 1.0}, settings, f"{out}/model/specs")
    return best


def forecast_job(
    spark: SparkSession, model_path: str, panel_path: str, out: str,
    quantiles: Sequence[float] | None = None, holidays: DataFrame | None = None,
    layout: str = "rows",
) -> DataFrame:
    """Load what :func:`refresh_job` or :func:`tune_job` stored, forecast the given panel,
    write the forecast to ``{out}/forecast`` and return it as read back. ``{out}/summary`` and
    ``{out}/quantile_totals`` have its sums. Columns that the models use are read from the panel.

    Interval widths come from a backtest on the given panel. Segments are coded as they were
    when the models were fitted; a segment that is new gets its forecast from the members
    that need no code, or NULL.
    """
    specs, weights, settings = load_specs(spark, f"{model_path}/specs")
    horizon, n_folds = settings["horizon"], settings["n_folds"]
    quantiles = settings["quantiles"] if quantiles is None else quantiles
    panel = _stored_panel(spark, panel_path, f"{out}/panel")
    models = {
        s.name: load_model(spark, f"{model_path}/learned/{s.name}")
        for s in specs if not hasattr(s, "recurrence")
    }
    table = weight_table(spark, weights)
    codes = spark.read.parquet(f"{model_path}/segment_codes")
    known = _stored_attributes(spark, panel_path, settings.get("attributes", ()), f"{out}/attributes")
    sums = spark.read.parquet(f"{model_path}/attribute_sums") if known else None
    ahead = vote(forecast(panel, specs, horizon, models, holidays, codes, known, sums), table)
    tested = backtest(panel, specs, horizon, n_folds, holidays=holidays, attributes=known)
    tested = cut_lineage(vote_backtest(tested, table), "ensemble-backtest")
    bound = conformal_intervals if settings.get("conformal") else intervals
    bounded = cut_lineage(bound(ahead, tested, quantiles), "bounded")
    write_forecast(_clipped(bounded, quantiles), f"{out}/forecast", layout, mode="overwrite")
    _write_summaries(bounded, None, out)
    return read_forecast(spark, f"{out}/forecast", layout)


def report_job(
    spark: SparkSession, panel_path: str, forecast_path: str, out: str,
    grain: str = "department", layout: str = "rows",
) -> DataFrame:
    """Prepared panel and stored forecast to a combined report, as CSV in ``out``; returned
    as read back."""
    report = combined_report(
        read_panel(spark, panel_path), read_forecast(spark, forecast_path, layout), grain
    )
    write_report(report, out, mode="overwrite")
    return read_report(spark, out)


def accuracy_job(
    spark: SparkSession, report_path: str, out: str, variant: int = 1, language: str = "ru"
) -> DataFrame:
    """A stored department report to ``{out}/summary`` and, per row, ``{out}/detail`` (CSV).
    Returns the summary as read back."""
    report = read_report(spark, report_path)
    accuracy_summary(report, variant).write.mode("overwrite").parquet(f"{out}/summary")
    write_report(accuracy_detail(report, language=language), f"{out}/detail", mode="overwrite")
    return spark.read.parquet(f"{out}/summary")
