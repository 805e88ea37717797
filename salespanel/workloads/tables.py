"""The engine's inputs, derived from the star-schema tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import segment_key
from ..operators.panel import regularise
from ..operators.recurrence import linear_forecast
from ..operators.specs import Naive

HORIZON = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rows at day grain: department = part type, article = brand, target = quantity.
    ``part`` is joined by size: Spark broadcasts it only while it is small."""
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return lineitem.join(part, lineitem.l_partkey == part.p_partkey).select(
        F.col("p_type").alias("department"),
        F.col("p_brand").alias("article"),
        segment_key("p_type", "p_brand").alias("segment"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("target"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").alias("product_size"),
    )


def sales_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regularise(sales_lines(spark, sf_dir), drop_zero=True)


def simple_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value 12 months back, with bounds of three and five quarters of it."""
    ahead = linear_forecast(sales_panel(spark, sf_dir), [Naive(12)], HORIZON)
    value = F.round("yhat", 4)
    return ahead.select(
        "segment", "timestamp", value.alias("target"), (value * 0.75).alias("target_lower"),
        (value * 1.25).alias("target_upper"),
    )


def acct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account balances with negatives, and missing for one market segment."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("x"),
    )


# Texts a `target` column might hold, by part type.
def target_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    text = (
        F.when(F.col("p_type") == "ECONOMY", F.lit(None).cast("string"))
        .when(F.col("p_type") == "SMALL", F.lit(""))
        .when(F.col("p_type") == "STANDARD", F.concat(size, F.lit("d")))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("-"), size))
        .when(F.col("p_type") == "LARGE", F.concat(size, F.lit(".5")))
        .when(F.col("p_size") < 10, F.concat(size, F.lit("e2")))
        .when(F.col("p_size") < 20, F.concat(size, F.lit(".0")))
        .otherwise(F.concat(F.lit("  "), size, F.lit(" ")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.col("p_type").alias("department"),
        F.col("p_name").alias("productName"),
        F.col("p_brand").alias("timestamp"),
        text.alias("target"),
    )


def raw_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the column layout of a raw upload, everything as text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("row_id"),
        F.col("event_type").alias("department"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("article"),
        F.col("props").alias("productProperties"),
        F.date_format("ts", "yyyy-MM-dd").alias("timestamp"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("target"),
    )


def part_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with nested JSON properties; one key appears only for some part types."""
    props = F.to_json(
        F.struct(
            F.col("p_name").alias("name"),
            F.when(F.col("p_type") == "PROMO", F.col("p_size")).alias("promo size"),
            F.struct(
                F.col("p_size").alias("value"), F.lit("cm").alias("unit")
            ).alias("size"),
            F.col("p_retailprice").alias("price"),
        )
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("segment"), props.alias("props")
    )


# ---------------------------------------------------------------------------------------
# The same in SQL.

LINES = """lines AS (
  SELECT p_type AS department, p_brand AS article, p_type || '|' || p_brand AS segment,
         l_shipdate AS ts, l_quantity AS target, p_name AS product_name,
         p_size AS product_size
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

PANEL = LINES + """,
monthly AS (
  SELECT segment, CAST(year(ts) * 12 + month(ts) - 1 AS INTEGER) AS m, sum(target) AS y
  FROM lines GROUP BY ALL),
bounds AS (SELECT min(m) AS lo, max(m) AS hi FROM monthly),
grid AS (
  SELECT s.segment, g.m, b.lo, b.hi
  FROM (SELECT DISTINCT segment FROM monthly) s
  CROSS JOIN bounds b
  CROSS JOIN (SELECT unnest(generate_series(lo, hi)) AS m FROM bounds) g),
panel AS (
  SELECT segment, CAST(m - lo AS INTEGER) AS t_idx, CAST(hi - m AS INTEGER) AS from_end,
         make_timestamp(m // 12, m % 12 + 1, 1, 0, 0, 0) AS ts, y AS target
  FROM grid LEFT JOIN monthly USING (segment, m))"""

# Log scale, then the mean of all earlier observed values for missing ones.
IMPUTED = PANEL + """,
logged AS (SELECT *, log10(target + 1) AS ylog FROM panel),
imputed AS (
  SELECT *, coalesce(ylog, avg(ylog) OVER (
    PARTITION BY segment ORDER BY t_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS y
  FROM logged)"""

# Forecasts by looking values up. `train_end` is the distance of the last training month
# from the end of the panel. For one-value averages the value looked up lies
# s * ceil(h / s) months back; for two values and h <= 3 both lie in the training range.
MODELS = """models(model, candidate_no, w, s) AS (VALUES
  ('naive_1', 0, 1, 1), ('naive_3', 1, 1, 3), ('naive_6', 2, 1, 6), ('naive_12', 3, 1, 12),
  ('seasonal_1_3', 4, 1, 3), ('seasonal_1_6', 5, 1, 6),
  ('seasonal_2_3', 6, 2, 3), ('seasonal_2_6', 7, 2, 6)),
steps AS (SELECT unnest([1, 2, 3]) AS h),
terms AS (
  SELECT model, candidate_no, h, w,
         CASE WHEN w = 1 THEN s * CAST(ceil(h / s) AS INTEGER) - h ELSE j * s - h END AS back
  FROM models CROSS JOIN steps CROSS JOIN (SELECT unnest([1, 2]) AS j)
  WHERE j <= w)"""


def forecast_sql(folds: str, source: str = "imputed", fold_key: bool = False) -> str:
    """CTEs up to ``points(model, candidate_no, fold, segment, h, ts, actual, yhat)`` for a
    ``folds(fold, train_end)`` list given as SQL VALUES rows."""
    on_fold = "AND v.fold_no = f.fold" if fold_key else ""
    return f"""{MODELS},
folds(fold, train_end) AS (VALUES {folds}),
sums AS (
  SELECT t.model, t.candidate_no, f.fold, f.train_end, v.segment, t.h, t.w,
         count(v.y) AS found, sum(v.y / t.w) AS total
  FROM terms t CROSS JOIN folds f
  JOIN {source} v ON v.from_end = f.train_end + t.back {on_fold}
  GROUP BY ALL),
points AS (
  SELECT s.model, s.candidate_no, s.fold, s.segment, s.h, p.ts, p.target AS actual,
         CASE WHEN s.found = s.w THEN power(10, s.total) - 1 END AS yhat
  FROM sums s JOIN panel p ON p.segment = s.segment AND p.from_end = s.train_end - s.h)"""


AHEAD = """ahead AS (
  SELECT t.model, t.candidate_no, v.segment, t.h, max(e.ts) + to_months(t.h) AS ts,
         CASE WHEN count(v.y) = any_value(t.w) THEN power(10, sum(v.y / t.w)) - 1 END AS yhat
  FROM terms t
  JOIN imputed v ON v.from_end = t.back
  JOIN panel e ON e.segment = v.segment AND e.from_end = 0
  GROUP BY t.model, t.candidate_no, v.segment, t.h)"""

EXPAND_FOLDS = "(0, 9), (1, 6), (2, 3)"

METRICS = """metrics AS (
  SELECT model, candidate_no, fold, segment,
         avg(abs(actual - yhat)) AS mae,
         avg((actual - yhat) * (actual - yhat)) AS mse,
         sqrt(avg((actual - yhat) * (actual - yhat))) AS rmse,
         100 * avg(2 * abs(actual - yhat) / greatest(abs(actual) + abs(yhat), 1e-15)) AS smape,
         100 * avg(abs(actual - yhat) / greatest(abs(actual), 1e-15)) AS mape
  FROM points WHERE actual IS NOT NULL AND yhat IS NOT NULL
  GROUP BY ALL)"""

ROLLED = """per_segment AS (
  SELECT model, candidate_no, segment, avg(mae) AS mae, avg(mse) AS mse, avg(rmse) AS rmse,
         avg(smape) AS smape, avg(mape) AS mape
  FROM metrics GROUP BY ALL),
rolled AS (
  SELECT model, candidate_no, avg(mae) AS mae, avg(mse) AS mse, avg(rmse) AS rmse,
         avg(smape) AS smape, avg(mape) AS mape
  FROM per_segment GROUP BY ALL),
scored AS (SELECT *, 0.4 * mae + 0.3 * rmse + 0.2 * smape + 0.1 * mape AS score FROM rolled)"""

WEIGHTS = """top5 AS (
  SELECT * FROM scored ORDER BY round(score, 9), candidate_no LIMIT 5),
weights AS (
  SELECT model, candidate_no, (1 / score) / sum(1 / score) OVER () AS weight FROM top5)"""

BACKTEST = f"{IMPUTED}, {forecast_sql(EXPAND_FOLDS)}"
SELECTION = f"{BACKTEST}, {METRICS}, {ROLLED}, {WEIGHTS}"

ENSEMBLE_POINTS = """voted_bt AS (
  SELECT segment, fold, h, ts, max(actual) AS actual,
         sum(weight * yhat) / sum(CASE WHEN yhat IS NOT NULL THEN weight END) AS yhat
  FROM points JOIN weights USING (model) GROUP BY ALL)"""

ENSEMBLE_AHEAD = """voted AS (
  SELECT segment, h, ts,
         sum(weight * yhat) / sum(CASE WHEN yhat IS NOT NULL THEN weight END) AS yhat
  FROM ahead JOIN weights USING (model) GROUP BY ALL),
spread AS (SELECT segment, stddev_pop(actual - yhat) AS sigma FROM voted_bt GROUP BY segment),
bounded AS (
  SELECT segment, ts, yhat AS target,
         yhat - 1.9599639845400545 * sigma AS lower_bound,
         yhat + 1.9599639845400545 * sigma AS upper_bound
  FROM voted LEFT JOIN spread USING (segment))"""

ENSEMBLE = f"{SELECTION}, {ENSEMBLE_POINTS}, {AHEAD}, {ENSEMBLE_AHEAD}"

# A simple forecast for the report queries: the value 12 months back, and bounds of three
# and five quarters of it. Four decimals, then factors that are exact in binary, keep
# halves exact, so half-even rounding sees the same value in both engines.
SIMPLE_FORECAST = f"""{IMPUTED}, {MODELS}, {AHEAD},
fc AS (
  SELECT segment, ts, round(yhat, 4) AS target, round(yhat, 4) * 0.75 AS target_lower,
         round(yhat, 4) * 1.25 AS target_upper
  FROM ahead WHERE model = 'naive_12')"""
