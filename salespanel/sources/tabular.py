"""CSV and Parquet tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import DAY_FIRST_FORMATS, PANDAS_NA, na_to_null, parse_number, parse_ts, segment_key

# The report's key columns.
REPORT_KEYS = ("Департамент", "Артикул")
#: Stands for a blank field while CSV is read; no header or value is called so.
BLANK = "\ufdd0blank"


def _same_headers(spark: SparkSession, path, options: dict) -> DataFrame:
    """The files as text, all with the columns of the first one in the same order, or reading
    raises. Spark's own comparison does not know blank headers, which it calls ``_cN``."""
    first = spark.read.csv(path, **options)
    names = first.columns
    blank = [c for c in names if re.fullmatch(r"_c\d+", c)]
    if len(blank) > 1:  # Spark takes no two columns of one name: look at the files one by one
        for file in first.inputFiles():
            if (found := spark.read.csv(file, **options).columns) != names:
                raise ValueError(f"{file} has the columns {found}, other files {names}")
        return first
    # A blank, in a header or a row, is read as BLANK, which is then a missing value.
    schema = T.StructType([T.StructField(BLANK if c in blank else c, T.StringType()) for c in names])
    same = spark.read.schema(schema).csv(path, **options, enforceSchema=False, nullValue=BLANK)
    return same.toDF(*names)


def _text_csv(
    spark: SparkSession, path, sep: str, na_tokens: Sequence[str], multiline: bool
) -> DataFrame:
    options = {
        "sep": sep, "header": True, "quote": '"', "escape": '"', "multiLine": multiline,
        "encoding": "UTF-8",
    }
    raw = _same_headers(spark, path, options)
    # Spark calls a blank header `_cN`; the junk-column rule looks for `Unnamed: N`.
    return raw.select(
        *[
            na_to_null(F.col(f"`{c}`"), na_tokens).alias(re.sub(r"^_c(\d+)$", r"Unnamed: \1", c))
            for c in raw.columns
        ]
    )


def read_upload(
    spark: SparkSession, path, na_tokens: Sequence[str] = PANDAS_NA, multiline: bool = True
) -> DataFrame:
    """``|``-separated upload, every column as text, NA tokens as NULL.

    Line breaks inside quotes belong to the value, so a file is one task. With
    ``multiline=False`` files are split across tasks; give it only where no value has a
    line break. Files of one upload have the same columns in the same order, unnamed ones
    too, or reading raises.
    """
    return _text_csv(spark, path, "|", na_tokens, multiline)


def read_legacy(
    spark: SparkSession,
    path,
    date_formats: Sequence[str] = DAY_FIRST_FORMATS,
    on_bad: str = "fail",
    na_tokens: Sequence[str] = PANDAS_NA,
    multiline: bool = True,
) -> DataFrame:
    """Comma CSV ``Date, Department, Article, Sold, ...`` with day-first dates.

    Gives ``timestamp``, ``target`` (DOUBLE) and ``segment`` beside the other columns.
    A date that fits no pattern stops the job (``on_bad='fail'``) or becomes NULL.
    """
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    raw = _text_csv(spark, path, ",", na_tokens, multiline)
    ts = parse_ts("Date", date_formats)
    sold = parse_number("Sold")
    if on_bad == "fail":
        ts = F.when(
            F.col("Date").isNotNull() & ts.isNull(),
            F.raise_error(F.concat(F.lit("unreadable date: "), F.col("Date"))).cast("timestamp_ntz"),
        ).otherwise(ts)
        sold = F.when(
            F.col("Sold").isNotNull() & sold.isNull(),
            F.raise_error(F.concat(F.lit("unreadable number: "), F.col("Sold"))).cast("double"),
        ).otherwise(sold)
    rest = [F.col(f"`{c}`") for c in raw.columns if c not in ("Date", "Sold")]
    return raw.select(
        ts.alias("timestamp"), *rest, sold.alias("target"),
        segment_key("Department", "Article").alias("segment"),
    )


def read_panel(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    """Prepared long panel: ``segment, timestamp, target`` typed, other columns as stored."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        df = _text_csv(spark, path, ",", PANDAS_NA, True)
    else:
        raise ValueError(f"fmt must be 'parquet' or 'csv', not {fmt!r}")
    casts = {"segment": "string", "timestamp": "timestamp_ntz", "target": "double"}
    return df.select(
        *[
            F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def write_panel(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write to a new path. With ``partition_by`` AQE first gathers each partition's
    rows (and splits the large ones), so a folder gets few files of even size."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"fmt must be 'parquet' or 'csv', not {fmt!r}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report as CSV with a header in every part file. No byte-order mark is written."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).csv(path, header=True, escape='"', **keep)


def read_report(spark: SparkSession, path) -> DataFrame:
    """What :func:`write_report` stored: keys as text, which a report never lacks, so an empty
    one is an empty text; figures as whole numbers. A figure that is none stops the job."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
    columns = spark.read.csv(path, **options).columns
    fields = [f"`{c}` {'string' if c in REPORT_KEYS else 'bigint'}" for c in columns]
    stored = spark.read.schema(", ".join(fields)).csv(
        path, **options, enforceSchema=False, mode="FAILFAST"
    )
    return stored.fillna("", [c for c in columns if c in REPORT_KEYS])


def write_invalid(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rejected rows as CSV."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
