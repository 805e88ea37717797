"""From raw sales rows to a regular monthly panel.

A panel is long: ``segment, t_idx, from_end, timestamp, target``. ``t_idx`` counts months
from the first month of the whole panel, ``from_end`` down to 0 at its last month. Folds
and lags are written against ``from_end``, so they are constants and need no lookup.

Raw rows are summed per (segment, month) before anything is keyed by segment alone, so
a segment that holds a third of all rows still arrives as one row per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import month_index, month_start, present

def by_segment():
    """Window over one segment: the way panel data is already partitioned."""
    return W.partitionBy("segment")


def drop_zero_segments(
    df: DataFrame, null_is_nonzero: bool = True, key: str = "segment", value: str = "target",
) -> DataFrame:
    """Keep rows of keys with any non-zero value; a missing value counts as non-zero
    unless ``null_is_nonzero=False``.

    Rows keep their grain, so a hot key stays hot; its side of the semi-join is one that
    Spark can split at run time.
    """
    v = F.col(value)
    nonzero = (v != 0) | v.isNull() if null_is_nonzero else F.coalesce(v != 0, F.lit(False))
    kept = df.filter(nonzero & F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    return df.join(kept, F.col(key) == F.col("_key"), "left_semi")


def monthly_totals(
    df: DataFrame, duplicates: str = "sum", null_is_nonzero: bool = True
) -> DataFrame:
    """``segment, month_no, target, nonzero``: one row per observed segment and month."""
    if duplicates not in ("sum", "error"):
        raise ValueError(f"duplicates must be 'sum' or 'error', not {duplicates!r}")
    target = present("target")
    total = F.sum(target)
    if duplicates == "error":
        total = F.when(
            F.count(F.lit(1)) > 1,
            F.raise_error(F.lit("two rows for one segment and month")).cast("double"),
        ).otherwise(total)
    nonzero = F.max(F.coalesce(target != 0, F.lit(null_is_nonzero)))
    return (
        df.filter(F.col("segment").isNotNull() & F.col("timestamp").isNotNull())
        .groupBy("segment", F.trunc("timestamp", "month").alias("month"))
        .agg(total.alias("target"), nonzero.alias("nonzero"))
        .select("segment", month_index("month").alias("month_no"), "target", "nonzero")
    )


def regularise(
    df: DataFrame, freq: str = "MS", duplicates: str = "sum", drop_zero: bool = False,
    null_is_nonzero: bool = True,
) -> DataFrame:
    """Every kept segment gets every month from the first to the last month of the data;
    a month without rows has a NULL target. ``drop_zero`` first leaves out segments that
    never sold.

    Two shuffles: (segment, month) for the sums, then segment. Gaps are filled from the
    distance to the next observed month, so there is no calendar join, and the output
    stays hash-partitioned by segment for the windows and sums that follow. The bounds
    come from the same monthly sums; Spark runs that exchange once and reuses it.
    """
    if freq != "MS":
        raise ValueError("only month-start panels (freq='MS') are supported")
    monthly = monthly_totals(df, duplicates, null_is_nonzero)
    if drop_zero:
        monthly = monthly.withColumn("keep", F.max("nonzero").over(by_segment())).filter("keep")
    # count(target) makes both readers of the monthly sums need the same columns, which
    # is what lets Spark see the two exchanges as one.
    bounds = monthly.agg(
        F.struct(
            F.min("month_no").alias("lo"), F.max("month_no").alias("hi"),
            F.count("target").alias("observed"),
        )
    ).scalar()
    by_month = by_segment().orderBy("month_no")
    runs = monthly.select(
        "segment", "month_no", "target",
        bounds.getField("lo").alias("lo"), bounds.getField("hi").alias("hi"),
        F.lag("month_no").over(by_month).alias("previous"),
        F.lead("month_no").over(by_month).alias("next"),
    )
    start = F.when(F.col("previous").isNull(), F.col("lo")).otherwise(F.col("month_no"))
    stop = F.coalesce(F.col("next") - 1, F.col("hi"))
    grid = runs.select(
        "segment", "month_no", "target", "lo", "hi", F.explode(F.sequence(start, stop)).alias("m")
    )
    return grid.select(
        "segment",
        (F.col("m") - F.col("lo")).alias("t_idx"),
        (F.col("hi") - F.col("m")).alias("from_end"),
        month_start(F.col("m")).alias("timestamp"),
        F.when(F.col("m") == F.col("month_no"), F.col("target")).alias("target"),
    )


def future_grid(panel: DataFrame, horizon: int) -> DataFrame:
    """The ``horizon`` months after the panel, per segment: ``segment, t_idx, h, timestamp``."""
    last = panel.filter("from_end = 0")
    steps = last.select(
        "segment", "t_idx", "timestamp",
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"),
    )
    return steps.select(
        "segment", (F.col("t_idx") + F.col("h")).alias("t_idx"), "h",
        month_start(month_index("timestamp") + F.col("h")).alias("timestamp"),
    )
