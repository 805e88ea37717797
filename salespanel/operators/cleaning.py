"""Upload cleaning: columns, keys, properties, fills."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clip0_fill, parse_number, segment_key
from ..params import work_dir
from .properties import (
    flatten_frequent,
    flatten_props,
    is_json_object,
    parse_props,
    schema_from_text,
)

def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def _count_columns(df: DataFrame, among: Column | None = None) -> list[Column]:
    aggs = []
    for i, c in enumerate(df.columns):
        value = F.col(f"`{c}`") if among is None else F.when(among, F.col(f"`{c}`"))
        aggs.append(F.count(value).alias(f"n{i}"))
        text = isinstance(df.schema[c].dataType, T.StringType)
        number = parse_number(value) if text else F.lit(None)
        aggs.append(F.count(number).alias(f"x{i}"))
    return aggs


def _counts(df: DataFrame, row) -> dict[str, tuple[int, int]]:
    return {c: (row[f"n{i}"], row[f"x{i}"]) for i, c in enumerate(df.columns)}


def column_counts(df: DataFrame) -> dict[str, tuple[int, int]]:
    """Per column: (values present, values that read as a number). One aggregate."""
    return _counts(df, df.agg(*_count_columns(df)).first())


def upload_profile(df: DataFrame) -> tuple[dict[str, tuple[int, int]], T.StructType]:
    """Column counts and the union schema of the properties, from one pass."""
    text = F.col("productProperties")
    objects = F.when(is_json_object(text), F.try_parse_json(text))
    row = df.agg(*_count_columns(df), F.schema_of_variant_agg(objects).alias("props")).first()
    return _counts(df, row), schema_from_text(row["props"])


def drop_empty_columns(df: DataFrame, counts: dict | None = None) -> DataFrame:
    """Without the columns that have no value at all. One aggregate, unless counted."""
    counts = column_counts(df) if counts is None else counts
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c][0] > 0])


def drop_columns_matching(df: DataFrame, regex: str = "^Unnamed") -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not re.search(regex, c)])


def type_numeric_columns(df: DataFrame, counts: dict, keep_text: Sequence[str]) -> DataFrame:
    """Text columns whose every value reads as a number become DOUBLE."""
    out = []
    for c in df.columns:
        present, numeric = counts[c]
        col = F.col(f"`{c}`")
        if c not in keep_text and present > 0 and present == numeric:
            col = parse_number(col).alias(c)
        out.append(col)
    return df.select(*out)


def fill_unknown(df: DataFrame, text: str = "unknown", num: float = 0) -> DataFrame:
    """Text: empty or missing becomes ``text``. Numbers: missing (NULL, NaN) becomes
    ``num``. Booleans become the texts True and False, or ``text``, as they have to share
    a column with it. Other types stay as they are."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            c = F.when(c.isNull() | (c == ""), F.lit(text)).otherwise(c)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.coalesce(F.nanvl(c, F.lit(float(num))), F.lit(float(num)))
        elif isinstance(field.dataType, T.BooleanType):
            c = F.coalesce(F.initcap(c.cast("string")), F.lit(text))
        elif isinstance(field.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(num).cast(field.dataType))
        out.append(c.alias(field.name))
    return df.select(*out)


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing numbers become 0, in ``cols`` or in every numeric column."""
    return df.fillna(0, subset=list(cols) if cols is not None else None)


def fill_from(df: DataFrame, col: str, other: Column | str | int | float) -> DataFrame:
    """Missing values of ``col`` from another column (a Column) or a constant."""
    value = other if isinstance(other, Column) else F.lit(other)
    return df.withColumn(col, F.coalesce(F.col(f"`{col}`"), value))


def rename_suffix(df: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    """Every column but the keys gets ``suffix`` appended."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keys})


def clean_upload(
    raw: DataFrame, on_bad: str = "fail", prop_schema: T.StructType | None = None,
    counts: dict | None = None, key_share: float | None = None,
) -> DataFrame:
    """Raw upload to prepared panel columns: junk columns out, ``segment`` built, target
    clipped, properties flattened to ``prop_*``, gaps filled.

    One pass finds empty columns, numeric columns and property keys; give ``counts`` and
    ``prop_schema`` to do without it (a stream has to). With ``key_share`` only keys of that
    share of the rows become columns and the others go to the map ``prop_rest``; give it
    where keys are without number. A target that is
    not a number, or properties that are not a JSON object, stop the job
    (``on_bad='fail'``) or drop the row into :func:`rejected_rows` (``'quarantine'``).
    """
    required = ("department", "article", "productProperties")
    require_columns(raw, required)
    df = drop_columns_matching(raw)
    if on_bad == "quarantine":
        df = df.filter(_problem(df).isNull())
    if key_share is not None:
        counts = column_counts(df) if counts is None else counts
    elif counts is None or prop_schema is None:
        found_counts, found_schema = upload_profile(df)
        counts = found_counts if counts is None else counts
        prop_schema = found_schema if prop_schema is None else prop_schema
    panel = _panel_columns(df, counts, parse_props(df, "productProperties", "fail"))
    if key_share is not None:
        return fill_unknown(flatten_frequent(panel, "productProperties", key_share))
    return fill_unknown(flatten_props(panel, "productProperties", "prop_", prop_schema))


def _panel_columns(df: DataFrame, counts: dict, parsed: DataFrame) -> DataFrame:
    """``parsed`` (``df`` with its properties as VARIANT) without empty columns, typed, with
    ``segment`` and the clipped target."""
    required = ("department", "article", "productProperties")
    df = parsed.select(*[F.col(f"`{c}`") for c in df.columns if c in required or counts[c][0] > 0])
    df = type_numeric_columns(
        df, counts, keep_text=(*required, "target", "timestamp")
    )
    df = df.withColumn("segment", segment_key("department", "article"))
    if "target" in df.columns:
        number = parse_number("target")
        bad = F.col("target").isNotNull() & number.isNull()
        number = F.when(
            bad, F.raise_error(F.concat(F.lit("target is not a number: "), F.col("target"))).cast("double")
        ).otherwise(number)
        df = df.withColumn("target", clip0_fill(number))
    return df.drop("article")


def _problem(df: DataFrame) -> Column:
    """Why a row is bad, or NULL."""
    text = F.coalesce("productProperties", F.lit("NULL"))
    problem = F.when(~is_json_object("productProperties"), F.concat(F.lit("not a JSON object: "), text))
    if "target" in df.columns:
        wrong = F.col("target").isNotNull() & parse_number("target").isNull()
        problem = problem.when(wrong, F.concat(F.lit("target is not a number: "), F.col("target")))
    return problem


def rejected_rows(raw: DataFrame) -> DataFrame:
    """The raw rows ``clean_upload(on_bad='quarantine')`` leaves out."""
    return raw.filter(_problem(raw).isNotNull())


@dataclass(frozen=True)
class StagedUpload:
    """An upload that was read once: ``panel`` as from :func:`clean_upload`, ``rejected`` as
    from :func:`rejected_rows`, and how many rows each has."""

    panel: DataFrame
    rejected: DataFrame
    n_panel: int
    n_rejected: int


# Columns of the job-private table of an upload.
_BAD, _PARSED = "_bad_row", "_parsed_props"


def stage_upload(
    raw: DataFrame, on_bad: str = "fail", key_share: float | None = None
) -> StagedUpload:
    """Panel and rejected rows from one reading of an upload.

    That reading parses the properties and writes a job-private table, bad rows in a folder of
    their own. On the way it counts good and bad rows and the values and numbers per column,
    and, without ``key_share``, unites the types of the properties. Panel and rejected rows are
    read from a folder each. With ``on_bad='fail'`` a bad row stops the reading. An upload
    without rows gives empty tables.
    """
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    require_columns(raw, ("department", "article", "productProperties"))
    if clash := {_BAD, _PARSED}.intersection(raw.columns):
        raise ValueError(f"reserved column names: {', '.join(sorted(clash))}")
    text = F.col("productProperties")
    if on_bad == "fail":
        raised = F.raise_error(_problem(raw)).cast("boolean")
        bad = F.when(_problem(raw).isNotNull(), raised).otherwise(F.lit(False))
    else:
        bad = _problem(raw).isNotNull()
    judged = raw.withColumn(_BAD, bad).withColumn(_PARSED, F.when(~F.col(_BAD), F.try_parse_json(text)))
    good, named = ~F.col(_BAD), drop_columns_matching(raw)
    found = Observation()
    seen = [F.count_if(good).alias("good"), F.count_if(F.col(_BAD)).alias("bad"), *_count_columns(named, good)]
    if key_share is None:
        seen.append(F.schema_of_variant_agg(F.col(_PARSED)).alias("props"))
    # The text of a good row is not stored beside what it was parsed to.
    table = judged.observe(found, *seen).withColumn("productProperties", F.when(F.col(_BAD), text))
    path = work_dir(raw.sparkSession, "upload")
    table.write.partitionBy(_BAD).parquet(path)
    stored = raw.sparkSession.read.schema(table.schema).parquet(path)
    row = found.get
    counts = _counts(named, row)
    rows = stored.filter(good).withColumn("productProperties", F.col(_PARSED))
    panel = _panel_columns(named, counts, rows)
    if key_share is not None:
        panel = flatten_frequent(panel, "productProperties", key_share)
    else:
        panel = flatten_props(panel, "productProperties", "prop_", schema_from_text(row["props"]))
    rejected = stored.filter(F.col(_BAD)).select(*[F.col(f"`{c}`") for c in raw.columns])
    return StagedUpload(fill_unknown(panel), rejected, row["good"], row["bad"])
