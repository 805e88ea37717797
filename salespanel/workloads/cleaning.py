"""Scalars, upload cleaning, properties and target checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    clip0_fill,
    clip0_keep,
    day_label,
    is_valid_target,
    month_label,
    parse_ts,
    process_number,
    round_half_even,
    segment_key,
    split_segment,
    split_segment_last,
)
from ..operators.cleaning import (
    clean_upload,
    drop_columns_matching,
    drop_empty_columns,
    fill_from,
    fill_unknown,
    fill_zero,
    rename_suffix,
)
from ..operators.properties import explode_props, flatten_frequent, flatten_props, parse_props
from ..operators.quality import (
    invalid_preview,
    invalid_targets,
    invalid_value_counts,
    target_profile,
)
from ..operators.report import order_report_columns, trailing_days
from ..operators.summary import latest_attributes
from .registry import Registry
from .tables import (
    LINES,
    acct_values,
    part_props,
    raw_uploads,
    sales_lines,
    table,
    target_texts,
)

query = Registry()

ACCT = """acct AS (
  SELECT c_custkey, c_mktsegment,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS x
  FROM customer)"""

TEXTS = """texts AS (
  SELECT p_partkey AS row_id, p_type AS department, p_name AS "productName",
         p_brand AS "timestamp",
         CASE WHEN p_type = 'ECONOMY' THEN NULL
              WHEN p_type = 'SMALL' THEN ''
              WHEN p_type = 'STANDARD' THEN p_size || 'd'
              WHEN p_type = 'PROMO' THEN '-' || p_size
              WHEN p_type = 'LARGE' THEN p_size || '.5'
              WHEN p_size < 10 THEN p_size || 'e2'
              WHEN p_size < 20 THEN p_size || '.0'
              ELSE '  ' || p_size || ' ' END AS target
  FROM part),
checked AS (
  SELECT *, coalesce(
    regexp_full_match(trim(target), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
      AND try_cast(trim(target) AS DOUBLE) >= 0
      AND try_cast(trim(target) AS DOUBLE) % 1 = 0, false) AS ok
  FROM texts)"""

PROPS = """props AS (
  SELECT p_partkey AS segment, p_name, p_type, p_size, p_retailprice FROM part)"""


@query(f"""WITH {ACCT}
SELECT c_custkey, greatest(coalesce(x, 0), 0) AS clipped FROM acct""")
def nonnegative_fill(spark, sf_dir):
    return acct_values(spark, sf_dir).select("c_custkey", clip0_fill("x").alias("clipped"))


@query(f"""WITH {ACCT}
SELECT c_custkey, CASE WHEN x IS NOT NULL THEN greatest(x, 0) END AS clipped FROM acct""")
def nonnegative_keep(spark, sf_dir):
    return acct_values(spark, sf_dir).select("c_custkey", clip0_keep("x").alias("clipped"))


@query(f"""WITH {ACCT}
SELECT c_custkey,
       CAST(greatest(round_even(coalesce(floor(x) / 2, 0), 0), 0) AS BIGINT) AS n
FROM acct""")
def whole_number(spark, sf_dir):
    half = F.floor("x").cast("double") / 2
    return acct_values(spark, sf_dir).select("c_custkey", process_number(half).alias("n"))


@query("""SELECT c_mktsegment, c_nationkey,
       round_even(sum(floor(c_acctbal)) / 2, 0) + 0.0 AS half_sum
FROM customer GROUP BY ALL""")
def half_even_sums(spark, sf_dir):
    sums = table(spark, sf_dir, "customer").groupBy("c_mktsegment", "c_nationkey").agg(
        F.sum(F.floor("c_acctbal").cast("double")).alias("s")
    )
    return sums.select(
        "c_mktsegment", "c_nationkey", (round_half_even(F.col("s") / 2) + 0.0).alias("half_sum")
    )


@query(f"""WITH {LINES}
SELECT segment, count(*) AS n FROM lines GROUP BY segment""")
def segment_keys(spark, sf_dir):
    lines = sales_lines(spark, sf_dir)
    return lines.groupBy(segment_key("department", "article").alias("segment")).agg(
        F.count(F.lit(1)).alias("n")
    )


SPLIT_INPUT = """keys AS (
  SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN p_brand
                         WHEN p_type = 'LARGE' THEN p_type || '|' || p_brand || '|' || p_size
                         ELSE p_type || '|' || p_brand END AS segment
  FROM part)"""


def _split_input(spark, sf_dir):
    two = segment_key("p_type", "p_brand")
    key = (
        F.when(F.col("p_type") == "PROMO", F.col("p_brand"))
        .when(F.col("p_type") == "LARGE", F.concat(two, F.lit("|"), F.col("p_size").cast("string")))
        .otherwise(two)
    )
    return table(spark, sf_dir, "part").select("p_partkey", key.alias("segment"))


@query(f"""WITH {SPLIT_INPUT}
SELECT p_partkey, string_split(segment, '|')[1] AS department,
       string_split(segment, '|')[2] AS article FROM keys""")
def split_second_part(spark, sf_dir):
    department, article = split_segment("segment")
    return _split_input(spark, sf_dir).select(
        "p_partkey", department.alias("department"), article.alias("article")
    )


@query(f"""WITH {SPLIT_INPUT}
SELECT p_partkey,
       CASE WHEN contains(segment, '|') THEN string_split(segment, '|')[1]
            ELSE 'Unknown' END AS department,
       string_split(segment, '|')[-1] AS article FROM keys""")
def split_last_part(spark, sf_dir):
    department, article = split_segment_last("segment")
    return _split_input(spark, sf_dir).select(
        "p_partkey", department.alias("department"), article.alias("article")
    )


@query("""SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS "timestamp",
       strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day
FROM orders""")
def parse_day_first(spark, sf_dir):
    text = F.when(
        F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd.MM.yyyy")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    parsed = table(spark, sf_dir, "orders").select(
        "o_orderkey", parse_ts(text).alias("timestamp")
    )
    return parsed.select(
        "o_orderkey", "timestamp", month_label("timestamp").alias("month"),
        day_label("timestamp").alias("day"),
    )


@query(f"""WITH {LINES}
SELECT segment, ts AS "timestamp", target FROM lines
WHERE ts >= (SELECT max(ts) FROM lines) - INTERVAL 123 DAY""")
def trailing_window(spark, sf_dir):
    lines = sales_lines(spark, sf_dir).select("segment", "timestamp", "target")
    return trailing_days(lines)


@query("""SELECT p_partkey, p_type FROM part""")
def empty_columns_dropped(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type",
        F.when(F.col("p_size") < 0, F.col("p_name")).alias("never_filled"),
        F.lit(None).cast("string").alias("always_missing"),
    )
    return drop_empty_columns(parts)


@query("""SELECT n_nationkey, n_name FROM nation""")
def junk_columns_dropped(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name", F.col("n_regionkey").alias("Unnamed: 2")
    )
    return drop_columns_matching(nation)


@query("""SELECT event_id, event_type || '|U' || user_id AS segment FROM events""")
def named_columns_dropped(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.concat(F.lit("U"), F.col("user_id")).alias("article"), "props"
    )
    keyed = events.withColumn("segment", segment_key("event_type", "article"))
    return keyed.drop("article", "props", "event_type")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_parsed(spark, sf_dir):
    parsed = parse_props(table(spark, sf_dir, "events"), "props")
    return parsed.select("event_id", F.variant_get("props", "$.k", "bigint").alias("k"))


@query(f"""WITH {PROPS}
SELECT segment, p_name AS "prop_name", p_retailprice AS "prop_price",
       CASE WHEN p_type = 'PROMO' THEN CAST(p_size AS BIGINT) END AS "prop_promo size",
       'cm' AS "prop_size.unit", CAST(p_size AS BIGINT) AS "prop_size.value"
FROM props""")
def json_flattened(spark, sf_dir):
    parsed = parse_props(part_props(spark, sf_dir), "props")
    return flatten_props(parsed, "props")


@query(f"""WITH {PROPS}
SELECT segment, p_name AS "prop_name", p_retailprice AS "prop_price",
       'cm' AS "prop_size.unit", CAST(p_size AS BIGINT) AS "prop_size.value",
       'part ' || segment AS rare_key, CAST(p_size * 2 AS VARCHAR) AS rare_value
FROM props""")
def json_frequent_keys(spark, sf_dir):
    """Every part has a key of its own beside the common ones."""
    own = F.concat(F.lit(', "part '), F.col("segment").cast("string"), F.lit('": '))
    twice = (F.get_json_object("props", "$.size.value").cast("int") * 2).cast("string")
    texts = part_props(spark, sf_dir).withColumn(
        "props", F.concat(F.regexp_replace("props", r"\}$", ""), own, twice, F.lit("}"))
    )
    flat = flatten_frequent(parse_props(texts, "props"), "props", share=0.9)
    rare = F.map_filter("prop_rest", lambda k, _: k.startswith("part "))
    return flat.withColumns(
        {"rare_key": F.element_at(F.map_keys(rare), 1), "rare_value": F.element_at(F.map_values(rare), 1)}
    ).drop("prop_rest")


@query(f"""WITH {PROPS}
SELECT segment, 'name' AS key, p_name AS value FROM props
UNION ALL SELECT segment, 'price', CAST(p_retailprice AS VARCHAR) FROM props
UNION ALL SELECT segment, 'promo size', CAST(p_size AS VARCHAR) FROM props
  WHERE p_type = 'PROMO'
UNION ALL SELECT segment, 'size', '{{"unit":"cm","value":' || p_size || '}}' FROM props""")
def json_unfolded(spark, sf_dir):
    parsed = parse_props(part_props(spark, sf_dir), "props")
    rows = explode_props(parsed, "props")
    price = F.col("value").try_cast("double").cast("string")
    return rows.withColumn(
        "value", F.when(F.col("key") == "price", price).otherwise(F.col("value"))
    )


@query("""SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'unknown' ELSE c_mktsegment END AS name,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'unknown' ELSE c_mktsegment END AS kind,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 0 ELSE c_acctbal END AS balance,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 0 ELSE c_nationkey END AS nation
FROM customer""")
def typed_fill(spark, sf_dir):
    segment = F.col("c_mktsegment")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", F.lit("")).otherwise(segment).alias("name"),
        F.when(segment != "FURNITURE", segment).alias("kind"),
        F.when(segment == "HOUSEHOLD", F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
        .alias("balance"),
        F.when(segment != "HOUSEHOLD", F.col("c_nationkey")).alias("nation"),
    )
    return fill_unknown(rows)


@query("""SELECT n_nationkey, coalesce(sum(c_acctbal::DECIMAL(18,2)), 0)::DOUBLE AS customers,
       coalesce((SELECT sum(s_acctbal::DECIMAL(18,2)) FROM supplier
                 WHERE s_nationkey = n_nationkey AND s_acctbal > 5000), 0)::DOUBLE AS suppliers
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING'
  AND c_acctbal > 9000
GROUP BY n_nationkey""")
def frame_fill_zero(spark, sf_dir):
    money = "decimal(18,2)"
    customers = (
        table(spark, sf_dir, "customer")
        .filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9000))
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.sum(F.col("c_acctbal").cast(money)).cast("double").alias("customers"))
    )
    suppliers = (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") > 5000)
        .groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.sum(F.col("s_acctbal").cast(money)).cast("double").alias("suppliers"))
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    joined = nation.join(customers, "n_nationkey", "left").join(suppliers, "n_nationkey", "left")
    return fill_zero(joined)


@query("""SELECT p_partkey,
       CASE WHEN p_type = 'PROMO' THEN 'UNKNOWN' ELSE p_type END AS department,
       CASE WHEN p_type = 'SMALL' THEN p_name ELSE p_brand END AS article,
       p_name AS segment
FROM part""")
def fill_from_other(spark, sf_dir):
    kind = F.col("p_type")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(kind != "PROMO", kind).alias("department"),
        F.when(kind != "SMALL", F.col("p_brand")).alias("article"), F.col("p_name").alias("segment"),
    )
    return fill_from(fill_from(rows, "department", "UNKNOWN"), "article", F.col("segment"))


@query("""SELECT p_brand AS article, CAST(sum(CASE WHEN p_type = 'PROMO' THEN p_size ELSE 0 END) AS BIGINT)
         AS "PROMO-forecast_mean",
       CAST(sum(CASE WHEN p_type = 'LARGE' THEN p_size ELSE 0 END) AS BIGINT) AS "LARGE-forecast_mean"
FROM part GROUP BY p_brand""")
def suffix_renamed(spark, sf_dir):
    sizes = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("article"))
        .pivot("p_type", ["PROMO", "LARGE"])
        .agg(F.sum("p_size"))
    )
    return rename_suffix(fill_zero(sizes), ["article"], "-forecast_mean")


@query("""SELECT c_mktsegment, c_nationkey AS "2024-01", c_custkey AS "2024-02",
       c_nationkey + 1 AS "2024-03-forecast_mean", c_acctbal AS total
FROM customer""")
def report_column_order(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("total"), (F.col("c_nationkey") + 1).alias("2024-03-forecast_mean"),
        F.col("c_custkey").alias("2024-02"), F.col("c_nationkey").alias("2024-01"), "c_mktsegment",
    )
    names = order_report_columns(rows.columns, ["c_mktsegment"], ["total"])
    return rows.select(*names)


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "prop_k", value
FROM events""")
def aligned_concat(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value", "props")
    return flatten_props(parse_props(events, "props"), "props")


@query("""SELECT CAST(event_id AS DOUBLE) AS row_id, event_type AS department,
       strftime(ts, '%Y-%m-%d') AS "timestamp", value AS target,
       event_type || '|U' || user_id AS segment,
       CAST(json_extract(props, '$.k') AS BIGINT) AS "prop_k"
FROM events""")
def upload_cleaned(spark, sf_dir):
    return clean_upload(raw_uploads(spark, sf_dir))


@query(f"""WITH {TEXTS} SELECT row_id, ok FROM checked""")
def target_validity(spark, sf_dir):
    return target_texts(spark, sf_dir).select("row_id", is_valid_target("target").alias("ok"))


@query(f"""WITH {TEXTS}
SELECT row_id, department, "productName", "timestamp", target FROM checked WHERE NOT ok""")
def invalid_target_rows(spark, sf_dir):
    return invalid_targets(target_texts(spark, sf_dir))


@query(f"""WITH {TEXTS}
SELECT department, "productName", "timestamp", target FROM checked WHERE NOT ok
ORDER BY department NULLS FIRST, "productName" NULLS FIRST, "timestamp" NULLS FIRST,
         target NULLS FIRST LIMIT 20""")
def invalid_target_preview(spark, sf_dir):
    return invalid_preview(target_texts(spark, sf_dir))


@query(f"""WITH {TEXTS},
sample AS (
  SELECT coalesce(target, 'NULL') AS t FROM (SELECT DISTINCT target FROM checked)
  ORDER BY target NULLS FIRST LIMIT 20)
SELECT count(*) AS total, count(*) FILTER (target IS NULL) AS missing,
       count(*) FILTER (target = '') AS empty, count(*) FILTER (NOT ok) AS invalid,
       (SELECT string_agg(t, ',' ORDER BY t) FROM sample) AS sample
FROM checked""")
def target_profile_row(spark, sf_dir):
    return target_profile(target_texts(spark, sf_dir)).withColumn(
        "sample", F.array_join("sample", ",")
    )


@query(f"""WITH {TEXTS}
SELECT target, count(*) AS n FROM checked WHERE NOT ok AND target IS NOT NULL
GROUP BY target ORDER BY n DESC, target""")
def invalid_target_frequencies(spark, sf_dir):
    return invalid_value_counts(target_texts(spark, sf_dir))


@query(f"""WITH {LINES},
named AS (
  SELECT segment, ts, CASE WHEN product_size < 25 THEN product_name END AS product_name,
         CASE WHEN product_size < 40 THEN product_size END AS product_size FROM lines)
SELECT segment,
       (SELECT n.product_name FROM named n WHERE n.segment = s.segment
        AND n.product_name IS NOT NULL
        ORDER BY n.ts DESC, n.product_name DESC LIMIT 1) AS product_name,
       (SELECT n.product_size FROM named n WHERE n.segment = s.segment
        AND n.product_size IS NOT NULL
        ORDER BY n.ts DESC, n.product_size DESC LIMIT 1) AS product_size
FROM (SELECT DISTINCT segment FROM named) s""")
def latest_known_attributes(spark, sf_dir):
    size = F.col("product_size")
    lines = sales_lines(spark, sf_dir).select(
        "segment", "timestamp", F.when(size < 25, F.col("product_name")).alias("product_name"),
        F.when(size < 40, size).alias("product_size"),
    )
    return latest_attributes(lines, cols=["product_name", "product_size"])
