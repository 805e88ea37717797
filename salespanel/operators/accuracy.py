"""Accuracy of a combined report: past actual total against future forecast total.

The two totals cover different months (the last 123 days of history, and the months
ahead), so this is a plausibility figure, not a holdout test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import accuracy, accuracy_note
from .cleaning import require_columns

ACTUAL, FORECAST = "last_123_days_sum", "forecast_123_days_mean"
ZERO_ZERO = {1: "null", 2: "hundred"}


def with_accuracy(report: DataFrame, variant: int = 1) -> DataFrame:
    """The report with ``accuracy_percent``. Variant 1 excludes 0-0 rows (NULL), variant
    2 counts them as 100."""
    require_columns(report, (ACTUAL, FORECAST))
    return report.withColumn("accuracy_percent", accuracy(ACTUAL, FORECAST, ZERO_ZERO[variant]))


def accuracy_summary(report: DataFrame, variant: int = 1) -> DataFrame:
    """One row of means and counts, from one pass over the report."""
    a, f, p = F.col(ACTUAL), F.col(FORECAST), F.col("accuracy_percent")
    both_zero = (a == 0) & (f == 0)
    counts = [
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(both_zero).alias("zero_zero_items"),
        F.count_if(f != 0).alias("non_zero_forecast_items"),
    ]
    non_zero_forecast = F.avg(F.when(f != 0, p)).alias("avg_accuracy_non_zero_forecast")
    rows = with_accuracy(report, variant)
    if variant == 1:
        return rows.agg(
            *counts,
            F.count(p).alias("valid_items"),
            F.coalesce(F.avg(p), F.lit(0.0)).alias("avg_accuracy"),
            non_zero_forecast,
        )
    return rows.agg(
        *counts,
        F.count_if((a != 0) | (f != 0)).alias("other_items"),
        F.avg(p).alias("avg_accuracy"),
        F.avg(F.when((a != 0) | (f != 0), p)).alias("avg_accuracy_without_zero_zero"),
        non_zero_forecast,
    )


def accuracy_detail(report: DataFrame, key: str = "Артикул", language: str = "ru") -> DataFrame:
    """``key, actual, forecast, accuracy_percent, note`` per report row."""
    require_columns(report, (key,))
    rows = with_accuracy(report, 1)
    return rows.select(
        F.col(f"`{key}`"),
        F.col(ACTUAL).alias("actual"),
        F.col(FORECAST).alias("forecast"),
        "accuracy_percent",
        accuracy_note(ACTUAL, FORECAST, "accuracy_percent", language).alias("note"),
    )
