"""Column functions. Every one is a built-in Spark expression, so it stays inside
whole-stage codegen and never starts a Python worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts pandas reads as missing by default.
PANDAS_NA = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Day-first patterns first, ISO last: 02.01.2024 is 2 January.
DAY_FIRST_FORMATS = ("d.M.yyyy", "d/M/yyyy", "d-M-yyyy", "yyyy-M-d")

# A plain decimal number. Spark's own cast also takes '5d' and 'Infinity'.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """DOUBLE with NaN as NULL, so that sums and means skip it."""
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))


def clip0_fill(c: Column | str) -> Column:
    """Lower bound 0; NULL and NaN become 0."""
    x = _col(c).cast("double")
    return F.greatest(F.lit(0.0), F.nanvl(F.coalesce(x, F.lit(0.0)), F.lit(0.0)))


def clip0_keep(c: Column | str) -> Column:
    """Lower bound 0; NULL and NaN become (stay) missing."""
    x = _col(c).cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(0.0), x)
    )


def round_half_even(c: Column | str) -> Column:
    """Round to a whole double, halves to the even neighbour; no clipping."""
    return F.bround(_col(c).cast("double"), 0)


def process_number(c: Column | str) -> Column:
    """Half-even round, lower bound 0, as BIGINT. Missing counts as 0."""
    return clip0_fill(round_half_even(c)).cast("bigint")


def segment_key(department: Column | str, article: Column | str) -> Column:
    """``department|article``; NULL when either part is NULL."""
    return F.concat(_col(department), F.lit("|"), _col(article))


def split_segment(c: Column | str) -> tuple[Column, Column]:
    """(first part, second part); the second is NULL when there is no pipe."""
    parts = F.split(_col(c), "[|]")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def split_segment_last(c: Column | str, default: str = "Unknown") -> tuple[Column, Column]:
    """(first part or ``default`` when there is no pipe, last part)."""
    c = _col(c)
    department = F.when(c.contains("|"), F.substring_index(c, "|", 1)).when(
        c.isNotNull(), F.lit(default)
    )
    return department, F.substring_index(c, "|", -1)


def month_index(ts: Column | str) -> Column:
    """Months since year 0 as INT: a compact key for month arithmetic."""
    ts = _col(ts)
    return F.year(ts) * 12 + F.month(ts) - 1


def month_start(index: Column) -> Column:
    """Inverse of :func:`month_index`: the first of the month as TIMESTAMP_NTZ."""
    return F.make_date(
        F.floor(index / 12).cast("int"), index % 12 + 1, F.lit(1)
    ).cast("timestamp_ntz")


def month_label(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def day_label(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def parse_ts(c: Column | str, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """Date text, with or without a time of day, as TIMESTAMP_NTZ. The first date pattern
    that fits counts; NULL when none does. The session's time zone plays no part."""
    parts = F.split(F.trim(_col(c)), "[ T]+", 2)
    date = F.coalesce(*[F.try_to_date(parts[0], f) for f in formats])
    clock = F.coalesce(F.get(parts, F.lit(1)), F.lit("00:00:00"))
    return F.concat(date.cast("string"), F.lit(" "), clock).try_cast("timestamp_ntz")


def na_to_null(c: Column | str, tokens: Sequence[str] = PANDAS_NA) -> Column:
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


def _stripped(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def parse_number(c: Column | str) -> Column:
    """Text to DOUBLE; NULL when the text is not a plain decimal number."""
    s = _stripped(c)
    return F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))


def is_valid_target(c: Column | str) -> Column:
    """True when the text is a present, finite, whole, non-negative number.

    Never NULL. ``1_0`` is rejected, though Python's ``float`` takes it.
    """
    x = parse_number(c)
    return F.coalesce((x >= 0) & (x % 1 == 0), F.lit(False))
