"""Nested forecasts: ``{segment: [{timestamp, target, target_lower, target_upper}]}``.

Three layouts. ``long`` is plain Parquet, one row per point. ``rows`` is JSON Lines, one
segment per line. ``object`` is the one big JSON object other tools read: it is written
as ordered part files whose concatenation is that object, and read back by splitting the
text at array ends, so neither side ever holds the whole object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_label

POINT_SCHEMA = (
    "struct<timestamp:string,target:double,target_lower:double,target_upper:double>"
)
LONG_COLUMNS = ("segment", "timestamp", "target", "target_lower", "target_upper")

# An array that holds points ends on a line of its own in two-space-indented JSON, and
# JSON strings hold no raw line breaks, so this text never occurs inside a value.
ARRAY_END = "\n  ],\n"


def _long(fc: DataFrame) -> DataFrame:
    """The long columns; a forecast without quantiles has NULL bounds."""
    missing = F.lit(None).cast("double")
    return fc.select(
        *LONG_COLUMNS[:3],
        *[F.col(c) if c in fc.columns else missing.alias(c) for c in LONG_COLUMNS[3:]],
    )


def nest_forecast(fc: DataFrame) -> DataFrame:
    """One row per segment: ``segment, points``. A segment has one point per horizon
    step, so the array is bounded by the horizon. Bounds that ``fc`` lacks are NULL."""
    fc = _long(fc).withColumns({c: F.col(c).cast("double") for c in LONG_COLUMNS[2:]})
    point = F.struct(
        day_label("timestamp").alias("timestamp"),
        *LONG_COLUMNS[2:],
    )
    return fc.filter(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.sort_array(F.collect_list(F.when(F.col("timestamp").isNotNull(), point))).alias("points")
    )


def unnest_forecast(nested: DataFrame) -> DataFrame:
    """Back to long form. A segment with no points keeps one row with NULL values."""
    flat = nested.select("segment", F.explode_outer("points").alias("p"))
    return flat.select(
        "segment",
        F.col("p.timestamp").cast("timestamp_ntz").alias("timestamp"),
        *[F.col(f"p.{c}").alias(c) for c in LONG_COLUMNS[2:]],
    )


def _json_text(c: Column) -> Column:
    as_array = F.to_json(F.array(c))
    return F.substring(as_array, F.lit(2), F.length(as_array) - 2)


def _object_lines(nested: DataFrame) -> DataFrame:
    bounds = nested.agg(F.struct(F.min("segment").alias("lo"), F.max("segment").alias("hi")).alias("ends"))
    ends = bounds.scalar()
    nothing = bounds.filter("ends.lo IS NULL").select(F.lit("{\n}").alias("value"))
    points = F.array_join(
        F.transform("points", lambda p: F.to_json(p, {"ignoreNullFields": "false"})), ",\n    "
    )
    body = F.when(F.size("points") == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("[\n    "), points, F.lit("\n  ]"))
    )
    return (
        nested.withColumn("ends", ends)
        .repartitionByRange("segment")
        .sortWithinPartitions("segment")
        .select(
            F.concat(
                F.when(F.col("segment") == F.col("ends.lo"), F.lit("{\n")).otherwise(F.lit("")),
                F.lit("  "), _json_text(F.col("segment")), F.lit(": "), body,
                F.when(F.col("segment") == F.col("ends.hi"), F.lit("\n}")).otherwise(F.lit(",")),
            ).alias("value")
        )
        .unionByName(nothing)
    )


def write_forecast(
    fc: DataFrame, path: str, layout: str = "rows", mode: str = "errorifexists"
) -> None:
    if layout == "long":
        _long(fc).write.mode(mode).parquet(path)
    elif layout == "rows":
        nest_forecast(fc).write.mode(mode).option("ignoreNullFields", False).json(path)
    elif layout == "object":
        _object_lines(nest_forecast(fc)).write.mode(mode).text(path)
    else:
        raise ValueError(f"layout must be 'long', 'rows' or 'object', not {layout!r}")


def read_forecast(spark: SparkSession, path, layout: str = "rows") -> DataFrame:
    """``segment, timestamp, target, target_lower, target_upper`` from any layout.

    ``object`` takes two-space-indented JSON: the ``object`` layout above, or what
    ``json.dumps(..., indent=2)`` gives. Anything else stops the job with an error.
    """
    if layout == "long":
        return spark.read.parquet(path).select(*LONG_COLUMNS)
    if layout == "rows":
        return unnest_forecast(
            spark.read.schema(f"segment string, points array<{POINT_SCHEMA}>").json(path)
        )
    if layout != "object":
        raise ValueError(f"layout must be 'long', 'rows' or 'object', not {layout!r}")
    text = spark.read.option("lineSep", ARRAY_END).text(path)
    # A chunk is some `"segment": [` entries, the last one cut before its `]`. Only the
    # chunk that closes the object still has `]` (or `[]`) before its final brace.
    body = F.regexp_replace("value", r"^\s*\{|^\s+", "")
    closed = F.regexp_replace(body, r"\s*,?\s*\}\s*$", "")
    is_last = F.col("value").rlike(r"(\]|^\s*\{)\s*\}\s*$")
    # Part files cut between entries: such a chunk ends in a finished entry and a comma.
    finished = F.col("value").rlike(r"\],?\s*$")
    entries = (
        F.when(is_last, closed)
        .when(finished, F.regexp_replace(body, r",\s*$", ""))
        .otherwise(F.concat(body, F.lit("]")))
    )
    parsed = F.from_json(
        F.concat(F.lit("{"), entries, F.lit("}")), f"map<string,array<{POINT_SCHEMA}>>"
    )
    checked = F.coalesce(
        parsed,
        F.raise_error(F.lit("forecast object is not two-space-indented JSON")).cast(
            f"map<string,array<{POINT_SCHEMA}>>"
        ),
    )
    nested = text.filter(F.trim("value") != "").select(
        F.explode(checked).alias("segment", "points")
    )
    return unnest_forecast(nested)
