"""Naive and seasonal moving-average forecasts as fixed linear combinations.

Such a forecast at step h is a weighted sum of observed values at fixed distances from
the end of the training range, predicted values being replaced by the observations they
are made of. The weights depend on the spec and the horizon only, so all models, folds
and steps become one small table, and one join plus one sum gives every forecast. The
panel is hash-partitioned by segment already, so the sum does not shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_index, month_start
from ..params import parameter_table
from .features import impute_seasonal, log_target, unlog


def linear_coefficients(specs: Sequence, horizon: int) -> list[tuple[str, int, int, float]]:
    """``(model, h, back, weight)``: the value ``back`` steps before the end of training
    (0 is the last one) counts ``weight`` in the forecast of step ``h``."""
    out = []
    for spec in specs:
        window, season = spec.recurrence
        made: dict[int, dict[int, float]] = {}
        for h in range(1, horizon + 1):
            terms: dict[int, float] = {}
            for j in range(1, window + 1):
                lag = j * season - h
                # lag < 0 points at an earlier forecast step; use its own terms.
                for back, weight in ({lag: 1.0} if lag >= 0 else made[-lag]).items():
                    terms[back] = terms.get(back, 0.0) + weight / window
            made[h] = terms
            out += [(spec.name, h, back, terms[back]) for back in sorted(terms)]
    return out


def folds(
    n: int, horizon: int, mode: str = "expand", length: int | None = None
) -> list[tuple[int, int, int]]:
    """``(fold, train_end, train_start)``: training is ``from_end >= train_end`` and
    ``t_idx >= train_start``; the test range is the next ``horizon`` months.

    ``expand`` trains from the first month on. ``constant`` moves the start along, so
    that every training range has the same length. With ``length`` (months in the panel)
    a series too short for the folds is refused.
    """
    if mode not in ("expand", "constant"):
        raise ValueError(f"mode must be 'expand' or 'constant', not {mode!r}")
    if length is not None and length <= n * horizon:
        raise ValueError(f"{length} months are too few for {n} folds of {horizon}")
    return [(k, (n - k) * horizon, k * horizon if mode == "constant" else 0) for k in range(n)]


COLUMNS = (
    "model", "candidate_no", "fold", "h", "position", "weight", "n_terms", "months_on",
)


def _roles(specs, numbers, horizon, ends) -> list[tuple]:
    """Every (model, fold, step) with the panel positions it reads, plus one weightless
    row for its anchor. For a test month the anchor is that month. For a month after the
    panel it is the last month, ``months_on`` months before."""
    coefficients = linear_coefficients(specs, horizon)
    rows = []
    for fold, train_end, _ in ends:
        for spec, number in zip(specs, numbers):
            mine = [c for c in coefficients if c[0] == spec.name]
            for h in range(1, horizon + 1):
                terms = [(back, weight) for _, step, back, weight in mine if step == h]
                on = h if train_end == 0 else 0
                head = (spec.name, number, fold, h)
                rows += [(*head, train_end + back, w, len(terms), on) for back, w in terms]
                rows.append((*head, train_end - h + on, None, len(terms), on))
    return rows


def _prepared(panel: DataFrame) -> DataFrame:
    """Model input: log scale first, then imputation, which looks backwards only."""
    return impute_seasonal(log_target(panel, out_col="y"), column="y")


def _prepared_per_fold(panel: DataFrame, ends) -> DataFrame:
    """The same inside each fold's own training range, as a copy of it per fold."""
    starts = [F.when(F.col("t_idx") >= start, F.lit(fold)) for fold, _, start in ends]
    fold_of = F.filter(F.array(*starts), lambda f: f.isNotNull())
    copies = log_target(panel, out_col="y").withColumn("fold_no", F.explode(fold_of))
    return impute_seasonal(copies, column="y", by=("segment", "fold_no"))


def linear_forecast(
    panel: DataFrame, specs: Sequence, horizon: int, ends=None, numbers=None
) -> DataFrame:
    """Forecasts of every recurrence spec from the end(s) of the panel.

    With ``ends=None`` these are the months after the panel. With ``ends`` from
    :func:`folds` each fold's test months are forecast and ``actual`` holds what was
    observed. An end ``(fold, 0, start)`` adds the months after the panel to the folds.
    A forecast is NULL when a value it needs is missing.

    Columns: ``model, candidate_no, fold, segment, h, timestamp, actual, yhat``.
    """
    ends = [(0, 0, 0)] if ends is None else ends
    numbers = list(range(len(specs))) if numbers is None else numbers
    per_fold = any(start > 0 for _, _, start in ends)
    roles = parameter_table(panel.sparkSession, _roles(specs, numbers, horizon, ends), COLUMNS)
    data = _prepared_per_fold(panel, ends) if per_fold else _prepared(panel)
    match = data["from_end"] == roles["position"]
    if per_fold:
        match = match & (data["fold_no"] == roles["fold"])
    is_term = F.col("weight").isNotNull()
    observed = F.when(is_term & F.col("y").isNotNull(), F.col("weight") * F.col("y"))
    grouped = data.join(roles, match).groupBy(
        "segment", "model", "candidate_no", "fold", "h", "n_terms", "months_on"
    ).agg(
        F.sum(observed).alias("total"),
        F.count(observed).alias("found"),
        F.max(F.when(~is_term, month_index("timestamp"))).alias("anchor_month"),
        F.max(F.when(~is_term, F.col("target"))).alias("anchor_target"),
    )
    # An anchor outside the panel leaves a group without a date: not a real test month.
    dated = grouped.filter(F.col("anchor_month").isNotNull())
    return dated.select(
        "model", "candidate_no", "fold", "segment", "h",
        month_start(F.col("anchor_month") + F.col("months_on")).alias("timestamp"),
        F.when(F.col("months_on") == 0, F.col("anchor_target")).alias("actual"),
        F.when(F.col("found") == F.col("n_terms"), unlog("total")).alias("yhat"),
    )
