"""Target validity checks on a text ``target`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_valid_target, na_to_null

REPORT_COLUMNS = ("department", "productName", "timestamp", "target")
SAMPLE = 20


def invalid_targets(df: DataFrame) -> DataFrame:
    """Rows whose target is missing, not a number, negative or fractional."""
    return df.filter(~is_valid_target("target"))


def invalid_preview(df: DataFrame, n: int = SAMPLE, columns=REPORT_COLUMNS) -> DataFrame:
    """First ``n`` invalid rows by all shown columns."""
    return invalid_targets(df).select(*columns).orderBy(*columns).limit(n)


def target_profile(df: DataFrame, n: int = SAMPLE, na_tokens: tuple | None = None) -> DataFrame:
    """One row: ``total, missing, empty, invalid`` counts and ``sample``, the first ``n``
    distinct values in sorted order (missing first). With ``na_tokens`` those texts count
    as missing, so ``empty`` is 0 when the empty text is one of them."""
    if na_tokens is not None:
        df = df.withColumn("target", na_to_null("target", na_tokens))
    t = F.col("target")
    first = df.select("target").distinct().orderBy("target").limit(n)
    # At most n values, with the missing one written as the text NULL.
    sample = first.agg(
        F.array_sort(F.collect_list(F.coalesce(t, F.lit("NULL"))))
    ).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(t.isNull()).alias("missing"),
        F.count_if(t == "").alias("empty"),
        F.count_if(~is_valid_target("target")).alias("invalid"),
    ).withColumn("sample", sample)


def invalid_value_counts(df: DataFrame) -> DataFrame:
    """``target, n``: how often each invalid text occurs, most frequent first."""
    return (
        invalid_targets(df)
        .filter(F.col("target").isNotNull())
        .groupBy("target")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "target")
    )
