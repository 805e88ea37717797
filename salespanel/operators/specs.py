"""Forecaster specs: what to fit, with no data attached."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Naive:
    """Repeat the value ``lag`` steps back."""

    lag: int = 1
    name: str = ""

    def __post_init__(self):
        object.__setattr__(self, "name", self.name or f"naive_{self.lag}")

    @property
    def recurrence(self) -> tuple[int, int]:
        return 1, self.lag


@dataclass(frozen=True)
class SeasonalMA:
    """Mean of the last ``window`` values that lie ``seasonality`` steps apart."""

    window: int = 1
    seasonality: int = 1
    name: str = ""

    def __post_init__(self):
        object.__setattr__(
            self, "name", self.name or f"seasonal_{self.window}_{self.seasonality}"
        )

    @property
    def recurrence(self) -> tuple[int, int]:
        return self.window, self.seasonality


@dataclass(frozen=True)
class Boosted:
    """One gradient-boosted tree model over all segments."""

    max_iter: int = 20
    max_depth: int = 5
    step_size: float = 0.1
    max_bins: int = 32
    subsampling_rate: float = 1.0
    seed: int = 42
    name: str = "boosted"


@dataclass(frozen=True)
class Linear:
    """One elastic-net linear model over all segments."""

    reg_param: float = 0.0
    elastic_net: float = 0.0
    name: str = "linear"


# Lags, and (window, seasonality) pairs, of the candidate set.
NAIVE_LAGS = (1, 3, 6, 12)
SEASONAL_PAIRS = ((1, 3), (1, 6), (2, 3), (2, 6))

CLASSICAL = tuple(Naive(lag) for lag in NAIVE_LAGS) + tuple(
    SeasonalMA(w, s) for w, s in SEASONAL_PAIRS
)

#: Three boosted candidates with different tree shapes.
BOOSTED = (
    Boosted(max_iter=20, max_depth=5, step_size=0.1, name="boosted_even"),
    Boosted(max_iter=30, max_depth=6, step_size=0.3, name="boosted_deep"),
    Boosted(max_iter=40, max_depth=4, step_size=0.1, subsampling_rate=0.8, name="boosted_light"),
)

CANDIDATES = CLASSICAL + BOOSTED
