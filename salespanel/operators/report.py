"""Month-by-month report of history and forecast, one row per article (and department).

History and forecast become one long table of (keys, column label, value): a month's sales
count under that month and, if recent, under the trailing total; a forecast point counts
under its three measures. One pivot of that table replaces a pivot and an outer join per
measure. The pivot sums per (keys, label) first, so no key has more rows afterwards than
the report has columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_label, present, process_number, split_segment_last
from ..params import cut_lineage
from .summary import MEASURES

# The report's column names.
DEPARTMENT, ARTICLE = "Департамент", "Артикул"
TOTAL_COLUMNS = {
    "department": (
        "last_123_days_sum", "forecast_123_days_mean", "forecast_123_days_lower",
        "forecast_123_days_upper",
    ),
    "article": (
        "last_3_month_sum", "forecast_3_month_mean", "forecast_3_month_lower",
        "forecast_3_month_upper",
    ),
}
TRAILING_DAYS = 123
SUFFIXES = ("mean", "lower", "upper")
HAS_FORECAST, HAS_MONTH = "_has_forecast", "_has_month"


def trailing_days(df: DataFrame, ts: str = "timestamp", days: int = TRAILING_DAYS) -> DataFrame:
    """Rows from ``days`` days before the latest timestamp on, both ends included.

    The cutoff is a scalar subquery over that one column, a plain value by the time the main
    scan starts. It prunes row groups of a DATE or TIMESTAMP column; Spark does not push
    conditions on TIMESTAMP_NTZ to Parquet.
    """
    return df.filter(F.col(ts) >= _cutoff(df, ts, days))


def _cutoff(df: DataFrame, ts: str, days: int):
    return df.agg(F.max(ts) - F.expr(f"INTERVAL '{int(days)}' DAY")).scalar()


def monthly_sum(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``keys, month, values``: sums per key and ``yyyy-MM`` month, 0 when all values are
    missing. Rows with a missing key or time are left out."""
    rows = df.filter(F.col("timestamp").isNotNull())
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    sums = rows.groupBy(*keys, F.trunc("timestamp", "month").alias("month")).agg(
        *[F.coalesce(F.sum(present(v)), F.lit(0.0)).alias(v) for v in values]
    )
    # Text is made per sum, not per row.
    return sums.withColumn("month", month_label("month"))


def trailing_total(
    df: DataFrame, keys: Sequence[str], days: int = TRAILING_DAYS, name: str = "last_123_days_sum"
) -> DataFrame:
    """Rounded non-negative sum of the trailing days per key."""
    rows = trailing_days(df, days=days)
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(process_number(F.sum(present("target"))).alias(name))


def month_list(df: DataFrame) -> list[str]:
    """Sorted distinct months: as many rows as the calendar has, not the data."""
    months = df.select(F.trunc("timestamp", "month").alias("m")).filter("m IS NOT NULL").distinct()
    return [r.m for r in months.select(month_label("m").alias("m")).orderBy("m").collect()]


def pivot_months(
    long: DataFrame, keys: Sequence[str], values: Sequence[str] = ("target",),
    months: Sequence[str] | None = None,
) -> DataFrame:
    """Months to columns, missing cells 0. Columns are the months, or ``{month}_{value}``
    with several values. A row whose month is not among given ``months`` raises."""
    if months is None:
        months = sorted(r.month for r in long.select("month").distinct().collect())
    else:
        known = F.col("month").isNull() | F.col("month").isin(list(months))
        unknown = F.raise_error(F.concat(F.lit("month not among the columns: "), F.col("month")))
        long = long.withColumn("month", F.when(known, F.col("month")).otherwise(unknown.cast("string")))
    sums = [F.sum(v).alias(v) for v in values]
    return long.groupBy(*keys).pivot("month", list(months)).agg(*sums).fillna(0)


def with_report_keys(df: DataFrame, grain: str) -> DataFrame:
    """Report keys of a history or forecast table. The article is the last part of the
    segment. History has its own department column; a forecast takes the first part of
    the segment, or ``Unknown``."""
    department, article = split_segment_last("segment")
    df = df.withColumn(ARTICLE, article)
    if grain == "department":
        own = F.col("department") if "department" in df.columns else department
        df = df.withColumn(DEPARTMENT, own)
    return df


def combined_report(
    hist: DataFrame, fc: DataFrame, grain: str = "department", days: int = TRAILING_DAYS,
    forecast_totals: str = "per_segment", ordered: bool = True,
    months: tuple[Sequence[str], Sequence[str]] | None = None,
) -> DataFrame:
    """``hist(segment, department, timestamp, target)`` and ``fc(segment, timestamp,
    target, target_lower, target_upper)`` to one wide table of whole numbers.

    Columns: keys, history months, forecast months, then the trailing total and three
    forecast totals. With ``forecast_totals='per_segment'`` the forecast totals are those
    of single segments, so an article of k segments has k rows; ``'per_key'`` sums them
    to one row per key.

    Which months there are is read from the summed cells, so these are stored first and
    the history is summed once. With ``months``, as (history months, forecast months),
    nothing runs before the result is used.
    """
    if grain not in TOTAL_COLUMNS:
        raise ValueError(f"grain must be 'department' or 'article', not {grain!r}")
    if forecast_totals not in ("per_segment", "per_key"):
        raise ValueError(
            f"forecast_totals must be 'per_segment' or 'per_key', not {forecast_totals!r}"
        )
    keys = [DEPARTMENT, ARTICLE] if grain == "department" else [ARTICLE]
    trailing, *totals = TOTAL_COLUMNS[grain]

    # Raw rows are summed under the columns they come with. Keys and labels are made of
    # the sums: a month's total under that month, its recent part under the trailing total.
    given = ["segment", "department"] if grain == "department" else ["segment"]
    value = present("target")
    recent = F.when(F.col("timestamp") >= _cutoff(hist, "timestamp", days), value)
    sums = hist.groupBy(*given, F.trunc("timestamp", "month").alias("month")).agg(
        F.sum(value).alias("total"), F.sum(recent).alias("recent")
    )
    sales = with_report_keys(sums, grain).select(
        *keys,
        F.inline(F.array(
            F.struct(month_label("month").alias("label"), F.col("total").alias("value")),
            F.struct(F.lit(trailing).alias("label"), F.col("recent").alias("value")),
        )),
    )
    keyed_fc = with_report_keys(fc.select("segment", "timestamp", *MEASURES), grain)
    measures = [
        F.struct(
            F.concat(month_label("timestamp"), F.lit(f"-forecast_{s}")).alias("label"),
            present(c).alias("value"),
        )
        for s, c in zip(SUFFIXES, MEASURES)
    ]
    per_key = [
        F.struct(F.lit(t).alias("label"), present(c).alias("value"))
        for t, c in zip(totals, MEASURES)
    ]
    # A segment without points still counts as one forecast of its article, with value 0.
    is_point = F.col("timestamp").isNotNull().cast("double")
    mark = F.struct(F.lit(HAS_FORECAST).alias("label"), is_point.alias("value"))
    points = keyed_fc.select(*keys, F.inline(F.array(*measures, *per_key, mark)))

    long = sales.unionByName(points).filter(F.col("label").isNotNull())
    for k in keys:
        long = long.filter(F.col(k).isNotNull())
    cells = long.groupBy(*keys, "label").agg(process_number(F.sum("value")).alias("value"))
    not_months = (trailing, *totals, HAS_FORECAST)
    if months is None:
        cells = cut_lineage(cells, "report-cells")
        found = [r.label for r in cells.select("label").distinct().collect()]
        month_columns = [c for c in found if c not in not_months]
    else:
        month_columns = [
            *months[0], *[f"{m}-forecast_{s}" for m in months[1] for s in SUFFIXES]
        ]

    # Only keys with a value in some month get a row. One marker column says so: a
    # condition over all month columns would make the planner rewrite it per column.
    is_month = ~F.col("label").isin(*not_months)
    marked = cells.select(
        *keys, F.explode(F.array("label", F.when(is_month, F.lit(HAS_MONTH)))).alias("label"),
        "value",
    ).filter(F.col("label").isNotNull())
    labels = [*month_columns, *not_months, HAS_MONTH]
    wide = marked.groupBy(*keys).pivot("label", labels).agg(F.sum("value"))
    wide = wide.filter(F.col(HAS_MONTH).isNotNull()).drop(HAS_MONTH)
    if forecast_totals == "per_segment":
        wide = _per_segment_totals(wide, keyed_fc, keys, totals)
    columns = order_report_columns(month_columns, keys, [trailing, *totals])
    out = wide.select(*[F.col(f"`{c}`") for c in columns]).fillna(0)
    return out.orderBy(*keys) if ordered else out


def _per_segment_totals(wide, keyed_fc, keys, totals):
    """The totals of single segments in place of those of the key: a left join on the
    report keys, as an inner join for keys that have a forecast and the rows as they are
    for those that have none. Spark can split a hot key on either side of an inner join;
    on the right of a left join it can not."""
    sums = keyed_fc.groupBy("segment", *keys).agg(
        *[process_number(F.sum(present(c))).alias(t) for c, t in zip(MEASURES, totals)]
    )
    with_forecast = wide.filter(F.col(HAS_FORECAST).isNotNull()).drop(*totals).join(
        sums.drop("segment"), keys, "inner"
    )
    without = wide.filter(F.col(HAS_FORECAST).isNull())
    return with_forecast.unionByName(without)


def order_report_columns(
    columns: Sequence[str], keys: Sequence[str], totals: Sequence[str]
) -> list[str]:
    """Keys, sorted history months, sorted forecast columns, totals."""
    middle = [c for c in columns if c not in (*keys, *totals)]
    history = sorted(c for c in middle if "forecast" not in c)
    ahead = sorted(c for c in middle if "forecast" in c)
    return [*keys, *history, *ahead, *totals]


def report_stats(report: DataFrame, fc: DataFrame | None = None) -> DataFrame:
    """One row: distinct departments (department grain) and articles, months of history
    and forecast; with ``fc`` also its rows and distinct articles."""
    totals = {c for names in TOTAL_COLUMNS.values() for c in names}
    middle = [c for c in report.columns if c not in (DEPARTMENT, ARTICLE) and c not in totals]
    ahead = sum("forecast" in c for c in middle)
    keys = [(DEPARTMENT, "departments"), (ARTICLE, "articles")]
    out = report.agg(
        *[F.count_distinct(f"`{c}`").alias(n) for c, n in keys if c in report.columns]
    ).withColumns(
        {"history_months": F.lit(len(middle) - ahead), "forecast_months": F.lit(ahead // 3)}
    )
    if fc is not None:
        _, article = split_segment_last("segment")
        points = fc.filter(F.col("timestamp").isNotNull()).agg(
            F.struct(F.count(F.lit(1)).alias("n"), F.count_distinct(article).alias("a"))
        ).scalar()
        out = out.withColumn("_fc", points).withColumns(
            {"forecast_rows": F.col("_fc.n"), "forecast_articles": F.col("_fc.a")}
        ).drop("_fc")
    return out


def preview(report: DataFrame, n: int = 5, edge: int = 4) -> DataFrame:
    """First and last four columns of the first ``n`` rows by key."""
    keys = [c for c in (DEPARTMENT, ARTICLE) if c in report.columns]
    names = [*report.columns[:edge], *report.columns[-edge:]]
    order = keys + [c for c in report.columns[-edge:] if c not in keys]
    return (
        report.orderBy(*[F.col(f"`{c}`") for c in order])
        .limit(n)
        .select(*[F.col(f"`{c}`") for c in names])
    )
