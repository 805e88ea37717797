"""Sums and look-ups over forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clip0_keep, present, process_number, round_half_even, split_segment

MEASURES = ("target", "target_lower", "target_upper")
# Fixed value: label of the grand-total row.
TOTAL_LABEL = "ИТОГО"


def quantile_columns(fc: DataFrame) -> list[str]:
    """The forecast's quantile columns (``target_<q>``), in column order."""
    return [c for c in fc.columns if c.startswith("target_")]


def with_split_segment(fc: DataFrame) -> DataFrame:
    """``department`` and ``article`` from the first two parts of the segment."""
    department, article = split_segment("segment")
    return fc.withColumn("department", department).withColumn("article", article)


def clip_quantiles(fc: DataFrame) -> DataFrame:
    """Lower bound 0 on every quantile column; missing stays missing."""
    return fc.withColumns({c: clip0_keep(F.col(f"`{c}`")) for c in quantile_columns(fc)})


def horizon_totals(fc: DataFrame, keys: Sequence[str] = ("segment",)) -> DataFrame:
    """Rounded non-negative totals over the horizon: ``forecast_mean/lower/upper``."""
    rows = fc
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(
        *[
            process_number(F.sum(present(c))).alias(f"forecast_{name}")
            for c, name in zip(MEASURES, ("mean", "lower", "upper"))
        ]
    )


def forecast_summary(fc: DataFrame, ordered: bool = True) -> DataFrame:
    """Sums per (department, article). Quantiles are clipped before and rounded after the
    sum; ``target`` is neither. Rows with a missing key are left out."""
    quantiles = quantile_columns(fc)
    if "department" not in fc.columns:
        fc = with_split_segment(fc)
    sums = (
        clip_quantiles(fc)
        .filter(F.col("department").isNotNull() & F.col("article").isNotNull())
        .groupBy("department", "article")
        .agg(
            F.coalesce(F.sum(present("target")), F.lit(0.0)).alias("target"),
            *[
                round_half_even(F.coalesce(F.sum(f"`{c}`"), F.lit(0.0))).alias(c)
                for c in quantiles
            ],
        )
    )
    return sums.orderBy("department", "article") if ordered else sums


def quantile_totals(fc: DataFrame) -> DataFrame:
    """One row: the sum of each clipped quantile column."""
    return clip_quantiles(fc).agg(
        *[
            F.coalesce(F.sum(f"`{c}`"), F.lit(0.0)).alias(f"sum_{c}")
            for c in quantile_columns(fc)
        ]
    )


def segment_sums(fc: DataFrame, total_label: str = TOTAL_LABEL) -> DataFrame:
    """``segment, total, is_total``: forecast total per segment and one grand-total row."""
    return (
        fc.filter(F.col("segment").isNotNull())
        .rollup("segment")
        .agg(
            F.coalesce(F.sum(present("target")), F.lit(0.0)).alias("total"),
            F.grouping("segment").alias("is_total"),
        )
        .select(
            F.when(F.col("is_total") == 1, F.lit(total_label))
            .otherwise(F.col("segment")).alias("segment"),
            "total",
            F.col("is_total").cast("int").alias("is_total"),
        )
    )


def latest_attributes(
    df: DataFrame, key: str = "segment", ts: str = "timestamp", cols: Sequence[str] = ()
) -> DataFrame:
    """The latest non-missing value of each column per key; among rows of the same time
    the largest value. One aggregate with partial results, so a hot key is no problem."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[
            F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("t"), F.col(c).alias("v"))))
            .getField("v").alias(c)
            for c in cols
        ]
    )


def attach_meta(
    fc: DataFrame, meta: DataFrame, department_default: str = "UNKNOWN"
) -> DataFrame:
    """Join ``meta(segment, department, article)``; a missing department becomes the
    default, a missing article the segment itself (also kept as ``article_code``)."""
    joined = fc.join(meta.select("segment", "department", "article"), "segment", "left")
    return joined.withColumns(
        {
            "department": F.coalesce("department", F.lit(department_default)),
            "article_code": F.col("segment"),
            "article": F.coalesce("article", "segment"),
        }
    )


def segment_series(fc: DataFrame) -> DataFrame:
    """The rows behind each (department, article) chart, in time order inside it.

    A range over all three columns places the rows, so one long series may span several
    tasks instead of having to fit in one; files written from it are in order as a whole.
    """
    if "department" not in fc.columns:
        fc = with_split_segment(fc)
    rows = fc.filter(F.col("department").isNotNull() & F.col("article").isNotNull())
    order = ("department", "article", "timestamp")
    return rows.select(*order, "target").orderBy(*order)
