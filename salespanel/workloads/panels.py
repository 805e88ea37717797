"""Panel building and feature steps."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators.attributes import (
    attributes_as_of,
    category_sums,
    merged_sums,
    ordered_means,
    with_means,
)
from ..operators.features import (
    add_date_flags,
    add_holiday,
    add_lags,
    decompose,
    encode_segment,
    impute_seasonal,
    label_encode,
    log_target,
    one_hot,
    unlog,
)
from ..operators.panel import drop_zero_segments
from .registry import Registry
from .tables import IMPUTED, LINES, PANEL, sales_lines, sales_panel, table

query = Registry()


@query(f"""WITH {LINES},
thinned AS (
  SELECT segment, ts, CASE WHEN article IN ('Brand#7', 'Brand#8') THEN 0
                           WHEN article = 'Brand#9' THEN NULL ELSE target END AS target
  FROM lines)
SELECT segment, ts AS "timestamp", target FROM thinned
WHERE segment IN (SELECT segment FROM thinned WHERE target <> 0 OR target IS NULL)""")
def zero_segments_dropped(spark, sf_dir):
    article = F.col("article")
    target = F.when(article.isin("Brand#7", "Brand#8"), F.lit(0.0)).when(
        article != "Brand#9", F.col("target")
    )
    lines = sales_lines(spark, sf_dir).select("segment", "timestamp", target.alias("target"))
    return drop_zero_segments(lines)


@query(f"""WITH {PANEL}
SELECT segment, t_idx, from_end, ts AS "timestamp", target FROM panel""")
def regular_panel(spark, sf_dir):
    return sales_panel(spark, sf_dir)


@query(f"""WITH {PANEL}
SELECT segment, t_idx, round(log10(target + 1), 6) AS logged,
       round(power(10, log10(target + 1)) - 1, 6) + 0.0 AS restored FROM panel""")
def log_and_back(spark, sf_dir):
    logged = log_target(sales_panel(spark, sf_dir), out_col="logged")
    return logged.select(
        "segment", "t_idx", F.round("logged", 6).alias("logged"),
        F.round(unlog("logged"), 6).alias("restored"),
    )


# The holiday calendar: days with an urgent order above 400 000.
HOLIDAYS = """holidays AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)"""


def _holidays(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    big = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000)
    return orders.filter(big).select(
        F.lit("RUS").alias("iso_code"), F.col("o_orderdate").cast("date").alias("date")
    )


@query(f"""WITH {PANEL}, {HOLIDAYS}
SELECT segment, t_idx,
       CASE WHEN CAST(ts AS DATE) IN (SELECT day FROM holidays) THEN 1 ELSE 0 END AS holiday
FROM panel""")
def holiday_flag(spark, sf_dir):
    flagged = add_holiday(sales_panel(spark, sf_dir), _holidays(spark, sf_dir))
    return flagged.select("segment", "t_idx", "holiday")


@query(f"""WITH {PANEL}
SELECT segment, t_idx, month(ts)::INTEGER AS flag_month_number_in_year,
       ((month(ts) % 12) // 3 + 1)::INTEGER AS flag_season_number,
       year(ts)::INTEGER AS flag_year_number
FROM panel""")
def date_flags(spark, sf_dir):
    flagged = add_date_flags(sales_panel(spark, sf_dir))
    return flagged.drop("from_end", "timestamp", "target")


@query("""SELECT o_orderkey, (isodow(o_orderdate) - 1)::INTEGER AS flag_day_number_in_week,
       day(o_orderdate)::INTEGER AS flag_day_number_in_month,
       dayofyear(o_orderdate)::INTEGER AS flag_day_number_in_year,
       ((day(o_orderdate) - 1 + isodow(date_trunc('month', o_orderdate)) - 1) // 7 + 1)::INTEGER
         AS flag_week_number_in_month,
       weekofyear(o_orderdate)::INTEGER AS flag_week_number_in_year,
       CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS flag_is_weekend
FROM orders""")
def daily_date_flags(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("timestamp"))
    flags = (
        "day_number_in_week", "day_number_in_month", "day_number_in_year",
        "week_number_in_month", "week_number_in_year", "is_weekend",
    )
    return add_date_flags(days, flags).drop("timestamp")


@query(f"""WITH {IMPUTED} SELECT segment, t_idx, round(y, 6) AS y FROM imputed""")
def seasonal_imputation(spark, sf_dir):
    filled = impute_seasonal(log_target(sales_panel(spark, sf_dir)))
    return filled.select("segment", "t_idx", F.round("target", 6).alias("y"))


@query(f"""WITH {PANEL}
SELECT segment, t_idx, round(coalesce(target, avg(target) OVER (
    PARTITION BY segment, t_idx % 12 ORDER BY t_idx
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 6) AS y FROM panel""")
def seasonal_imputation_by_phase(spark, sf_dir):
    filled = impute_seasonal(sales_panel(spark, sf_dir), seasonality=12)
    return filled.select("segment", "t_idx", F.round("target", 6).alias("y"))


@query(f"""WITH {PANEL}
SELECT segment, t_idx, CAST(dense_rank() OVER (ORDER BY segment) - 1 AS BIGINT) AS segment_code
FROM panel""")
def segment_codes(spark, sf_dir):
    return encode_segment(sales_panel(spark, sf_dir)).select("segment", "t_idx", "segment_code")


@query(f"""WITH {PANEL}
SELECT segment, t_idx,
       lag(target, 1) OVER w AS target_lag_1, lag(target, 3) OVER w AS target_lag_3,
       lag(target, 12) OVER w AS target_lag_12
FROM panel WINDOW w AS (PARTITION BY segment ORDER BY t_idx)""")
def lag_columns(spark, sf_dir):
    lagged = add_lags(sales_panel(spark, sf_dir), [1, 3, 12])
    return lagged.drop("from_end", "timestamp", "target")


@query(f"""WITH {PANEL}
SELECT segment, t_idx, target, round(log10(target + 1), 6) AS target_log FROM panel""")
def log_column(spark, sf_dir):
    logged = log_target(sales_panel(spark, sf_dir), out_col="target_log")
    return logged.select("segment", "t_idx", "target", F.round("target_log", 6).alias("target_log"))


@query("""SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type_label,
       CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand_label
FROM part""")
def attribute_labels(spark, sf_dir):
    coded = label_encode(table(spark, sf_dir, "part"), ["p_type", "p_brand"])
    return coded.select("p_partkey", "p_type_label", "p_brand_label")


@query("""SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS hot_slot,
       1.0::DOUBLE AS hot_value, (SELECT count(DISTINCT p_type) + 1 FROM part)::INTEGER AS slots
FROM part""")
def one_hot_attributes(spark, sf_dir):
    coded = one_hot(table(spark, sf_dir, "part").select("p_partkey", "p_type"), ["p_type"])
    slots = coded.select("p_partkey", vector_to_array("p_type_onehot").alias("v"))
    return slots.select(
        "p_partkey", F.posexplode("v").alias("hot_slot", "hot_value"), F.size("v").alias("slots")
    ).filter("hot_value <> 0")


@query(f"""WITH {PANEL},
w AS (
  SELECT *, count(target) OVER c AS n, sum(target) OVER c AS s,
         lag(target, 6) OVER o AS first, lead(target, 6) OVER o AS last
  FROM panel WINDOW
    c AS (PARTITION BY segment ORDER BY t_idx ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING),
    o AS (PARTITION BY segment ORDER BY t_idx)),
trended AS (SELECT *, CASE WHEN n = 11 THEN (s + (first + last) / 2) / 12 END AS trend FROM w),
phases AS (
  SELECT segment, t_idx % 12 AS phase, avg(target - trend) AS m FROM trended GROUP BY ALL),
centres AS (SELECT segment, avg(m) AS centre FROM phases GROUP BY segment)
SELECT segment, t_idx, target, round(trend, 7) + 0.0 AS trend,
       round(m - centre, 7) + 0.0 AS seasonal,
       round(target - trend - (m - centre), 7) + 0.0 AS resid
FROM trended JOIN phases USING (segment) JOIN centres USING (segment)
WHERE phase = t_idx % 12""")
def seasonal_decomposition(spark, sf_dir):
    parts = decompose(sales_panel(spark, sf_dir), 12)
    return parts.select(
        "segment", "t_idx", "target",
        *[F.round(c, 7).alias(c) for c in ("trend", "seasonal", "resid")],
    )


# Two attributes of a segment that change, one of them missing at times.
CHANGES = """sizes AS (
  SELECT segment, ts, max(product_size) AS product_size FROM lines
  WHERE product_size % 5 <> 0 GROUP BY ALL),
names AS (SELECT segment, ts, max(product_name) AS product_name FROM lines GROUP BY ALL)"""


def _changes(spark, sf_dir):
    size = F.col("product_size")
    return sales_lines(spark, sf_dir).select(
        "segment", "timestamp", F.when(size % 5 != 0, size).alias("product_size"), "product_name"
    )


@query(f"""WITH {PANEL}, {CHANGES}
SELECT p.segment, p.ts AS "timestamp", s.product_size, n.product_name
FROM panel p
ASOF LEFT JOIN sizes s ON p.segment = s.segment AND p.ts >= s.ts
ASOF LEFT JOIN names n ON p.segment = n.segment AND p.ts >= n.ts""")
def attributes_at_month_start(spark, sf_dir):
    """What was known of each segment when a month began."""
    rows = sales_panel(spark, sf_dir).select("segment", "timestamp")
    return attributes_as_of(rows, _changes(spark, sf_dir), ("product_size", "product_name"))


BY_PRODUCT = LINES + """,
rows_ AS (
  SELECT segment, product_name, date_trunc('month', ts)::TIMESTAMP AS ts, sum(target)::DOUBLE AS y
  FROM lines GROUP BY ALL)"""


def _by_product(spark, sf_dir):
    month = F.trunc("timestamp", "month").cast("timestamp_ntz")
    return sales_lines(spark, sf_dir).groupBy("segment", "product_name", month.alias("timestamp")).agg(
        F.sum("target").cast("double").alias("y")
    )


@query(f"""WITH {BY_PRODUCT},
by_product AS (SELECT product_name, ts, count(y) AS n, sum(y) AS total FROM rows_ GROUP BY ALL),
by_month AS (SELECT ts, count(y) AS n, sum(y) AS total FROM rows_ GROUP BY ALL),
prior AS (
  SELECT ts, coalesce(sum(total) OVER w / nullif(sum(n) OVER w, 0), 0) AS prior FROM by_month
  WINDOW w AS (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
earlier AS (
  SELECT product_name, ts, coalesce(sum(total) OVER w, 0) AS total, coalesce(sum(n) OVER w, 0) AS n
  FROM by_product WINDOW w AS (
    PARTITION BY product_name ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT segment, product_name, ts AS "timestamp", round((total + 10 * prior) / (n + 10), 6) AS mean_product
FROM rows_ JOIN earlier USING (product_name, ts) JOIN prior USING (ts)""")
def ordered_target_means(spark, sf_dir):
    """Mean sales of a product's earlier months, for each month of it."""
    found = ordered_means(_by_product(spark, sf_dir), "product_name", "mean_product")
    return found.select("segment", "product_name", "timestamp", F.round("mean_product", 6).alias("mean_product"))


@query(f"""WITH {BY_PRODUCT},
total AS (SELECT sum(y) / count(y) AS prior FROM rows_ WHERE ts < '2001-06-01'),
sums AS (SELECT product_name, count(y) AS n, sum(y) AS total FROM rows_ WHERE ts < '2001-06-01' GROUP BY ALL)
SELECT r.segment, r.product_name, r.ts AS "timestamp",
       round((coalesce(s.total, 0) + 10 * t.prior) / (coalesce(s.n, 0) + 10), 6) AS mean_product
FROM rows_ r CROSS JOIN total t LEFT JOIN sums s USING (product_name) WHERE r.ts >= '2001-06-01'""")
def later_target_means(spark, sf_dir):
    """The same for later months, from sums of two periods that are merged."""
    rows = _by_product(spark, sf_dir)
    first, second = rows.filter("timestamp < '2000-01-01'"), rows.filter("timestamp >= '2000-01-01' AND timestamp < '2001-06-01'")
    sums = merged_sums(category_sums(first, ["product_name"]), category_sums(second, ["product_name"]))
    found = with_means(rows.filter("timestamp >= '2001-06-01'"), sums, "product_name", "mean_product")
    return found.select("segment", "product_name", "timestamp", F.round("mean_product", 6).alias("mean_product"))
