"""Sums, joins, pivots, combined reports and accuracy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.accuracy import accuracy_detail, accuracy_summary, with_accuracy
from ..operators.report import (
    ARTICLE,
    DEPARTMENT,
    combined_report,
    monthly_sum,
    month_list,
    pivot_months,
    preview,
    report_stats,
    trailing_total,
)
from ..operators.summary import (
    attach_meta,
    forecast_summary,
    horizon_totals,
    latest_attributes,
    quantile_totals,
    segment_series,
    segment_sums,
)
from ..params import cut_lineage
from .registry import Registry
from .tables import LINES, SIMPLE_FORECAST, sales_lines, simple_forecast, table

query = Registry()


def whole(expr: str) -> str:
    return f"CAST(greatest(round_even(coalesce({expr}, 0), 0), 0) AS BIGINT)"


def _history(spark, sf_dir):
    return sales_lines(spark, sf_dir).select("segment", "department", "timestamp", "target")


# A forecast with quantile columns that has negatives and missing bounds.
def _quantile_forecast(spark, sf_dir):
    fc = simple_forecast(spark, sf_dir)
    return fc.select(
        "segment", "timestamp", "target", (F.col("target_lower") - 50).alias("target_0.025"),
        F.when(F.col("target_upper") > 100, F.col("target_upper")).alias("target_0.975"),
    )


QUANTILE_FC = f"""{SIMPLE_FORECAST},
qfc AS (
  SELECT segment, string_split(segment, '|')[1] AS department,
         string_split(segment, '|')[2] AS article, ts, target,
         CASE WHEN target_lower IS NOT NULL THEN greatest(target_lower - 50, 0) END AS lo,
         CASE WHEN target_upper > 100 THEN target_upper END AS hi
  FROM fc)"""


@query(f"""WITH {LINES}
SELECT department, article, strftime(ts, '%Y-%m') AS month, {whole("sum(target)")} AS total
FROM lines GROUP BY ALL""")
def monthly_by_department_article(spark, sf_dir):
    sums = monthly_sum(sales_lines(spark, sf_dir), ["department", "article"], ["target"])
    return sums.select("department", "article", "month", F.col("target").cast("bigint").alias("total"))


@query(f"""WITH {LINES}
SELECT article, strftime(ts, '%Y-%m') AS month, sum(target) AS target
FROM lines GROUP BY ALL""")
def monthly_by_article(spark, sf_dir):
    return monthly_sum(sales_lines(spark, sf_dir), ["article"], ["target"])


@query(f"""WITH {SIMPLE_FORECAST}
SELECT string_split(segment, '|')[-1] AS article, strftime(ts, '%Y-%m') AS month,
       round(coalesce(sum(target), 0), 6) AS target,
       round(coalesce(sum(target_lower), 0), 6) AS target_lower,
       round(coalesce(sum(target_upper), 0), 6) AS target_upper
FROM fc GROUP BY ALL""")
def monthly_forecast_measures(spark, sf_dir):
    measures = ["target", "target_lower", "target_upper"]
    fc = simple_forecast(spark, sf_dir).withColumn("article", F.substring_index("segment", "|", -1))
    sums = monthly_sum(fc, ["article"], measures)
    return sums.withColumns({m: F.round(m, 6) for m in measures})


@query(f"""WITH {LINES}
SELECT department, article, {whole("sum(target)")} AS last_123_days_sum FROM lines
WHERE ts >= (SELECT max(ts) FROM lines) - INTERVAL 123 DAY GROUP BY ALL""")
def trailing_totals(spark, sf_dir):
    return trailing_total(sales_lines(spark, sf_dir), ["department", "article"])


@query(f"""WITH {SIMPLE_FORECAST}
SELECT segment, {whole("sum(target)")} AS forecast_mean,
       {whole("sum(target_lower)")} AS forecast_lower,
       {whole("sum(target_upper)")} AS forecast_upper FROM fc GROUP BY segment""")
def forecast_horizon_totals(spark, sf_dir):
    return horizon_totals(simple_forecast(spark, sf_dir))


@query(f"""WITH {QUANTILE_FC}
SELECT department, article, round(coalesce(sum(target), 0), 4) AS target,
       round_even(coalesce(sum(lo), 0), 0) AS "target_0.025",
       round_even(coalesce(sum(hi), 0), 0) AS "target_0.975"
FROM qfc GROUP BY ALL ORDER BY department, article""")
def forecast_by_department_article(spark, sf_dir):
    return forecast_summary(_quantile_forecast(spark, sf_dir)).withColumn(
        "target", F.round("target", 4)
    )


@query(f"""WITH {QUANTILE_FC}
SELECT round(sum(lo), 6) AS "sum_target_0.025", round(sum(hi), 6) AS "sum_target_0.975"
FROM qfc""")
def forecast_quantile_totals(spark, sf_dir):
    totals = quantile_totals(_quantile_forecast(spark, sf_dir))
    return totals.select(*[F.round(f"`{c}`", 6).alias(c) for c in totals.columns])


@query(f"""WITH {SIMPLE_FORECAST}
SELECT CASE WHEN grouping(segment) = 1 THEN 'ИТОГО' ELSE segment END AS segment,
       round(coalesce(sum(target), 0), 4) AS total, CAST(grouping(segment) AS INTEGER) AS is_total
FROM fc GROUP BY ROLLUP (segment)""")
def forecast_segment_sums(spark, sf_dir):
    return segment_sums(simple_forecast(spark, sf_dir)).withColumn("total", F.round("total", 4))


META_SQL = """meta AS (
  SELECT segment, arg_max(p, (ts, p)) FILTER (p IS NOT NULL) AS article
  FROM (SELECT segment, ts, CASE WHEN product_size < 25 THEN product_name END AS p FROM lines)
  WHERE segment NOT LIKE '%3' GROUP BY segment)"""


@query(f"""WITH {SIMPLE_FORECAST}, {META_SQL}
SELECT f.segment, f.ts AS "timestamp", f.target,
       CASE WHEN m.segment IS NULL THEN 'UNKNOWN' ELSE string_split(m.segment, '|')[1] END
         AS department,
       coalesce(m.article, f.segment) AS article, f.segment AS article_code
FROM fc f LEFT JOIN meta m ON f.segment = m.segment""")
def forecast_with_metadata(spark, sf_dir):
    lines = sales_lines(spark, sf_dir)
    name = F.when(F.col("product_size") < 25, F.col("product_name"))
    rows = lines.select("segment", "timestamp", name.alias("article"))
    described = rows.filter("segment NOT LIKE '%3'")
    meta = latest_attributes(described, cols=["article"]).withColumn(
        "department", F.substring_index("segment", "|", 1)
    )
    fc = simple_forecast(spark, sf_dir).select("segment", "timestamp", "target")
    return attach_meta(fc, meta)


@query(f"""WITH {LINES}
SELECT article, {", ".join(
    f"coalesce(sum(target) FILTER (strftime(ts, '%Y-%m') = '{y}-{m:02d}'), 0) AS \"{y}-{m:02d}\""
    for y in range(1995, 2002) for m in range(1, 13) if (y, m) <= (2001, 11))}
FROM lines GROUP BY article""")
def months_as_columns(spark, sf_dir):
    lines = sales_lines(spark, sf_dir)
    sums = monthly_sum(lines, ["article"], ["target"])
    return pivot_months(sums, ["article"], months=month_list(lines))


# --- combined report -------------------------------------------------------------------

HISTORY_MONTHS = [
    f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13) if (y, m) <= (2001, 11)
]
FORECAST_MONTHS = ["2001-12", "2002-01", "2002-02"]
MEASURES = (("mean", "target"), ("lower", "target_lower"), ("upper", "target_upper"))


def report_sql(grain: str, forecast_totals: str = "per_segment") -> str:
    """The report as separate history, forecast and total tables joined on the keys."""
    both = grain == "department"
    keys = "department, article" if both else "article"
    names = (f'department AS "{DEPARTMENT}", ' if both else "") + f'article AS "{ARTICLE}"'
    trailing, prefix = (
        ("last_123_days_sum", "forecast_123_days") if both
        else ("last_3_month_sum", "forecast_3_month")
    )
    history = ", ".join(
        f"{whole(f'''sum(target) FILTER (month = '{m}')''')} AS \"{m}\"" for m in HISTORY_MONTHS
    )
    ahead = ", ".join(
        f"{whole(f'''sum({c}) FILTER (month = '{m}')''')} AS \"{m}-forecast_{s}\""
        for m in FORECAST_MONTHS for s, c in MEASURES
    )
    sums = ", ".join(f"{whole(f'sum({c})')} AS {prefix}_{s}" for s, c in MEASURES)
    months = [
        *HISTORY_MONTHS,
        *[f"{m}-forecast_{s}" for m in FORECAST_MONTHS for s in ("lower", "mean", "upper")],
    ]
    group = f"segment, {keys}" if forecast_totals == "per_segment" else keys
    shown = ", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in [
        *months, trailing, *[f"{prefix}_{s}" for s, _ in MEASURES]
    ])
    return f"""{SIMPLE_FORECAST},
hist AS (SELECT *, strftime(ts, '%Y-%m') AS month FROM lines),
fck AS (
  SELECT segment, string_split(segment, '|')[1] AS department,
         string_split(segment, '|')[-1] AS article, strftime(ts, '%Y-%m') AS month,
         target, target_lower, target_upper FROM fc),
h AS (SELECT {keys}, {history} FROM hist GROUP BY {keys}),
f AS (SELECT {keys}, {ahead} FROM fck GROUP BY {keys}),
recent AS (
  SELECT {keys}, {whole("sum(target)")} AS {trailing} FROM hist
  WHERE ts >= (SELECT max(ts) FROM hist) - INTERVAL 123 DAY GROUP BY {keys}),
totals AS (SELECT {keys}, {sums} FROM fck GROUP BY {group}),
report AS (
  SELECT {names}, {shown}
  FROM h FULL JOIN f USING ({keys}) LEFT JOIN recent USING ({keys})
  LEFT JOIN totals USING ({keys}))"""


def _report(spark, sf_dir, grain, forecast_totals="per_segment"):
    # The forecast is read three times; a report starts from a stored one.
    fc = cut_lineage(simple_forecast(spark, sf_dir))
    return combined_report(
        _history(spark, sf_dir), fc, grain, forecast_totals=forecast_totals
    )


@query(f"WITH {report_sql('department')} SELECT * FROM report")
def report_by_department(spark, sf_dir):
    return _report(spark, sf_dir, "department")


@query(f"WITH {report_sql('article')} SELECT * FROM report")
def report_by_article(spark, sf_dir):
    return _report(spark, sf_dir, "article")


@query(f"WITH {report_sql('article', 'per_key')} SELECT * FROM report")
def report_by_article_one_row(spark, sf_dir):
    return _report(spark, sf_dir, "article", "per_key")


@query(f"""WITH {report_sql('department')}
SELECT count(DISTINCT "{DEPARTMENT}") AS departments, count(DISTINCT "{ARTICLE}") AS articles,
       {len(HISTORY_MONTHS)} AS history_months, {len(FORECAST_MONTHS)} AS forecast_months,
       (SELECT count(*) FROM fc) AS forecast_rows,
       (SELECT count(DISTINCT string_split(segment, '|')[-1]) FROM fc) AS forecast_articles
FROM report""")
def report_statistics(spark, sf_dir):
    return report_stats(_report(spark, sf_dir, "department"), simple_forecast(spark, sf_dir))


@query(f"""WITH {report_sql('department')}
SELECT "{DEPARTMENT}", "{ARTICLE}", "1995-01", "1995-02", last_123_days_sum,
       forecast_123_days_mean, forecast_123_days_lower, forecast_123_days_upper
FROM report ORDER BY "{DEPARTMENT}", "{ARTICLE}" LIMIT 5""")
def report_preview(spark, sf_dir):
    return preview(_report(spark, sf_dir, "department"))


@query(f"""WITH {SIMPLE_FORECAST}
SELECT string_split(segment, '|')[1] AS department, string_split(segment, '|')[2] AS article,
       ts AS "timestamp", target FROM fc ORDER BY ALL""")
def chart_series(spark, sf_dir):
    return segment_series(simple_forecast(spark, sf_dir))


@query(f"""WITH {LINES}, totals AS (
  SELECT department, article, sum(target) AS total FROM lines GROUP BY ALL)
SELECT * FROM totals ORDER BY total DESC, department, article LIMIT 20""")
def largest_segments(spark, sf_dir):
    totals = sales_lines(spark, sf_dir).groupBy("department", "article").agg(
        F.sum("target").alias("total")
    )
    return totals.orderBy(F.desc("total"), "department", "article").limit(20)


@query(f"""WITH {LINES},
h AS (SELECT article, sum(target) AS history FROM lines WHERE department = 'PROMO' GROUP BY ALL),
f AS (SELECT article, count(*) AS recent FROM lines
      WHERE department = 'SMALL' AND target > 49 AND ts >= TIMESTAMP '2001-06-01' GROUP BY ALL)
SELECT coalesce(h.article, f.article) AS article, coalesce(history, 0) AS history,
       coalesce(recent, 0) AS recent
FROM h FULL JOIN f ON h.article = f.article""")
def outer_join_filled(spark, sf_dir):
    lines = sales_lines(spark, sf_dir)
    history = lines.filter("department = 'PROMO'").groupBy("article").agg(
        F.sum("target").alias("history")
    )
    recent = (
        lines.filter(
            (F.col("department") == "SMALL") & (F.col("target") > 49)
            & (F.col("timestamp") >= F.lit("2001-06-01").cast("timestamp_ntz"))
        )
        .groupBy("article")
        .agg(F.count(F.lit(1)).alias("recent"))
    )
    return history.join(recent, "article", "full").fillna(0)


# --- accuracy --------------------------------------------------------------------------

# Actual and forecast figures per part, with 0-0, 0-x and x-0 cases.
FIGURES = """figures AS (
  SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 0 ELSE p_size * 10 END AS a,
         CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 0
              ELSE CAST(floor(p_retailprice / 4) AS INTEGER) END AS f
  FROM part),
rated AS (
  SELECT *, CASE WHEN a = 0 OR f = 0 THEN 0.0::DOUBLE
                 ELSE greatest(0.0, least(100.0, (1.0::DOUBLE - abs(a - f) / greatest(a, f)) * 100))
            END AS p
  FROM figures)"""


def _figures(spark, sf_dir):
    kind = F.col("p_type")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(ARTICLE),
        F.when(kind.isin("PROMO", "SMALL"), 0).otherwise(F.col("p_size") * 10)
        .alias("last_123_days_sum"),
        F.when(kind.isin("PROMO", "LARGE"), 0)
        .otherwise(F.floor(F.col("p_retailprice") / 4).cast("int")).alias("forecast_123_days_mean"),
    )


@query(f"""WITH {FIGURES}
SELECT p_partkey, round(CASE WHEN a <> 0 OR f <> 0 THEN p END, 4) AS accuracy_percent FROM rated""")
def accuracy_excluding_zero_zero(spark, sf_dir):
    rows = with_accuracy(_figures(spark, sf_dir), 1)
    return rows.select(
        F.col(ARTICLE).alias("p_partkey"), F.round("accuracy_percent", 4).alias("accuracy_percent")
    )


@query(f"""WITH {FIGURES}
SELECT p_partkey, round(CASE WHEN a = 0 AND f = 0 THEN 100 ELSE p END, 4) AS accuracy_percent
FROM rated""")
def accuracy_counting_zero_zero(spark, sf_dir):
    rows = with_accuracy(_figures(spark, sf_dir), 2)
    return rows.select(
        F.col(ARTICLE).alias("p_partkey"), F.round("accuracy_percent", 4).alias("accuracy_percent")
    )


@query(f"""WITH {FIGURES}, v AS (SELECT *, CASE WHEN a <> 0 OR f <> 0 THEN p END AS q FROM rated)
SELECT count(*) AS total_items, count(*) FILTER (a = 0 AND f = 0) AS zero_zero_items,
       count(*) FILTER (f <> 0) AS non_zero_forecast_items, count(q) AS valid_items,
       round(coalesce(avg(q), 0), 4) AS avg_accuracy,
       round(avg(q) FILTER (f <> 0), 4) AS avg_accuracy_non_zero_forecast FROM v""")
def accuracy_summary_excluding(spark, sf_dir):
    return _round_averages(accuracy_summary(_figures(spark, sf_dir), 1))


@query(f"""WITH {FIGURES},
v AS (SELECT *, CASE WHEN a = 0 AND f = 0 THEN 100 ELSE p END AS q FROM rated)
SELECT count(*) AS total_items, count(*) FILTER (a = 0 AND f = 0) AS zero_zero_items,
       count(*) FILTER (f <> 0) AS non_zero_forecast_items,
       count(*) FILTER (a <> 0 OR f <> 0) AS other_items, round(avg(q), 4) AS avg_accuracy,
       round(avg(q) FILTER (a <> 0 OR f <> 0), 4) AS avg_accuracy_without_zero_zero,
       round(avg(q) FILTER (f <> 0), 4) AS avg_accuracy_non_zero_forecast FROM v""")
def accuracy_summary_counting(spark, sf_dir):
    return _round_averages(accuracy_summary(_figures(spark, sf_dir), 2))


def _round_averages(df):
    return df.withColumns({c: F.round(c, 4) for c in df.columns if c.startswith("avg_")})


@query(f"""WITH {FIGURES}
SELECT p_partkey AS "{ARTICLE}", a AS actual, f AS forecast,
       round(CASE WHEN a <> 0 OR f <> 0 THEN p END, 4) AS accuracy_percent,
       CASE WHEN a = 0 AND f = 0 THEN '0-0 (исключен)'
            WHEN p = 0 AND (a = 0 OR f = 0) THEN '0 vs не-0' ELSE 'расчет' END AS note
FROM rated""")
def accuracy_detail_rows(spark, sf_dir):
    rows = accuracy_detail(_figures(spark, sf_dir))
    return rows.withColumn("accuracy_percent", F.round("accuracy_percent", 4))


@query(f"""WITH {report_sql('department')}
SELECT "{ARTICLE}", "{DEPARTMENT}", last_123_days_sum, forecast_123_days_mean,
       round(CASE WHEN last_123_days_sum = 0 AND forecast_123_days_mean = 0 THEN NULL
            WHEN last_123_days_sum = 0 OR forecast_123_days_mean = 0 THEN 0
            ELSE (1.0::DOUBLE - abs(last_123_days_sum - forecast_123_days_mean)
                  / greatest(last_123_days_sum, forecast_123_days_mean)) * 100 END, 4)
         AS accuracy_percent
FROM report""")
def report_accuracy(spark, sf_dir):
    rows = with_accuracy(_report(spark, sf_dir, "department"))
    return rows.select(
        ARTICLE, DEPARTMENT, "last_123_days_sum", "forecast_123_days_mean",
        F.round("accuracy_percent", 4).alias("accuracy_percent"),
    )
