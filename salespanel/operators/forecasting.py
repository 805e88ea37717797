"""Backtest and forecast any mix of specs through one call each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .attributes import Attributes
from .learned import learned_backtest, learned_forecast
from .learned import fit as fit_learned
from .recurrence import folds, linear_forecast


def split_specs(specs: Sequence):
    """(recurrence specs, their numbers, learned specs, their numbers); a spec's number
    is its place in ``specs`` and breaks ties between equal scores."""
    fixed = [(s, i) for i, s in enumerate(specs) if hasattr(s, "recurrence")]
    learned = [(s, i) for i, s in enumerate(specs) if not hasattr(s, "recurrence")]
    return (
        [s for s, _ in fixed], [i for _, i in fixed],
        [s for s, _ in learned], [i for _, i in learned],
    )


def backtest(
    panel: DataFrame, specs: Sequence, horizon: int, n_folds: int = 3, mode: str = "expand",
    holidays: DataFrame | None = None, attributes: Attributes | None = None,
) -> DataFrame:
    """``model, candidate_no, fold, segment, h, timestamp, actual, yhat``.

    All recurrence specs and folds are one lazy query. Each learned spec is fitted once
    per fold when this is called; pass a panel that is stored, not recomputed.
    """
    fixed, fixed_no, learned, learned_no = split_specs(specs)
    ends = folds(n_folds, horizon, mode)
    out = linear_forecast(panel, fixed, horizon, ends, fixed_no) if fixed else None
    if learned:
        part = learned_backtest(panel, learned, learned_no, horizon, ends, holidays, attributes)
        out = part if out is None else out.unionByName(part)
    return out


def forecast(
    panel: DataFrame, specs: Sequence, horizon: int, models: dict | None = None,
    holidays: DataFrame | None = None, codes: DataFrame | None = None,
    attributes: Attributes | None = None, sums: DataFrame | None = None,
) -> DataFrame:
    """The months after the panel, per spec. Learned specs are fitted on the whole panel
    unless ``models`` already has them by name; ``codes`` are the segment codes of those and
    ``sums`` their attribute sums."""
    fixed, fixed_no, learned, learned_no = split_specs(specs)
    out = linear_forecast(panel, fixed, horizon, None, fixed_no) if fixed else None
    if learned:
        models = dict(models or {})
        for spec in learned:
            if spec.name not in models:
                models[spec.name] = fit_learned(panel, spec, codes, holidays, attributes)
        part = learned_forecast(
            panel, {s.name: models[s.name] for s in learned},
            {s.name: i for s, i in zip(learned, learned_no)}, horizon, holidays, codes,
            attributes, sums,
        )
        out = part if out is None else out.unionByName(part)
    return out
