"""Hit-rate of a forecast total against an actual total, in percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import _col

# The note texts of the accuracy detail, by language.
ACCURACY_NOTES = {
    "ru": ("0-0 (исключен)", "0 vs не-0", "расчет"),
    "en": ("0-0 excluded", "0 vs non-0", "computed"),
}


def accuracy(
    actual: Column | str, forecast: Column | str, zero_zero: str = "null"
) -> Column:
    """``clamp((1 - |a-f| / max(a,f)) * 100, 0, 100)``; 0 when just one side is 0.

    Both sides 0 gives NULL (``zero_zero='null'``) or 100 (``'hundred'``). A missing
    side gives NULL: reports are filled before this point, so it means bad input.
    """
    if zero_zero not in ("null", "hundred"):
        raise ValueError(f"zero_zero must be 'null' or 'hundred', not {zero_zero!r}")
    a, f = _col(actual).cast("double"), _col(forecast).cast("double")
    both_zero = F.lit(None if zero_zero == "null" else 100.0).cast("double")
    ratio = (F.lit(1.0) - F.abs(a - f) / F.greatest(a, f)) * 100
    return (
        F.when(a.isNull() | f.isNull() | F.isnan(a) | F.isnan(f), F.lit(None).cast("double"))
        .when((a == 0) & (f == 0), both_zero)
        .when((a == 0) | (f == 0), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), ratio)))
    )


def accuracy_note(
    actual: Column | str, forecast: Column | str, percent: Column | str, language: str = "ru"
) -> Column:
    excluded, one_zero, computed = ACCURACY_NOTES[language]
    a, f, p = _col(actual), _col(forecast), _col(percent)
    return (
        F.when(p.isNull(), F.lit(excluded))
        .when((p == 0) & ((a == 0) | (f == 0)), F.lit(one_zero))
        .otherwise(F.lit(computed))
    )
