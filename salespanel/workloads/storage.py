"""Files written and read back, streams run to their end, and whole jobs. Every run
writes to a fresh folder under the session's checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.accuracy import with_accuracy
from ..operators.cleaning import rejected_rows, require_columns
from ..operators.quality import invalid_targets
from ..operators.report import ARTICLE, DEPARTMENT
from ..operators.specs import CLASSICAL
from ..operators.learned import fit, predict, segment_codes
from ..operators.panel import future_grid
from ..operators.specs import Linear
from ..params import cut_lineage, work_dir
from ..plans import accuracy_job, forecast_job, refresh_job, report_job, upload_job
from ..sources import (
    load_model,
    read_forecast,
    read_legacy,
    read_panel,
    read_report,
    read_trailing,
    read_upload,
    save_model,
    write_by_time,
    write_forecast,
    write_invalid,
    write_panel,
    write_report,
)
from ..streaming import (
    latest_revisions,
    run_monthly_corrected,
    stream_monthly,
    stream_uploads,
    stream_uploads_once,
)
from .registry import Registry
from .reports import report_sql
from .tables import (
    ENSEMBLE,
    HORIZON,
    LINES,
    SIMPLE_FORECAST,
    raw_uploads,
    sales_lines,
    sales_panel,
    simple_forecast,
    table,
    target_texts,
)

query = Registry()

UPLOADED = """SELECT CAST(event_id AS DOUBLE) AS row_id, event_type AS department,
       strftime(ts, '%Y-%m-%d') AS "timestamp", value AS target,
       event_type || '|U' || user_id AS segment,
       CAST(json_extract(props, '$.k') AS BIGINT) AS "prop_k"
FROM events"""


def _write_upload(df, path):
    """A `|`-separated file as an uploader would send it, JSON quotes doubled."""
    df.write.option("sep", "|").option("header", True).option("escape", '"').csv(path)


@query("""SELECT CAST(event_id AS VARCHAR) AS row_id, event_type AS department,
       'U' || user_id AS article, props AS "productProperties",
       strftime(ts, '%Y-%m-%d') AS "timestamp", CAST(value AS DECIMAL(18,2))::VARCHAR AS target
FROM events""")
def upload_read(spark, sf_dir):
    path = work_dir(spark, "upload")
    _write_upload(raw_uploads(spark, sf_dir), path)
    return read_upload(spark, path)


@query("SELECT event_type AS department, count(*) AS n FROM events GROUP BY 1")
def columns_required(spark, sf_dir):
    rows = raw_uploads(spark, sf_dir)
    require_columns(rows, ("department", "article", "productProperties"))
    return rows.groupBy("department").agg(F.count("*").alias("n"))


@query(UPLOADED)
def upload_to_panel(spark, sf_dir):
    path = work_dir(spark, "upload")
    _write_upload(raw_uploads(spark, sf_dir), f"{path}/in")
    upload_job(spark, f"{path}/in", f"{path}/out")
    return spark.read.parquet(f"{path}/out")


@query(f"""WITH {LINES}
SELECT segment, ts AS "timestamp", target FROM lines
WHERE ts >= (SELECT max(ts) FROM lines) - INTERVAL 123 DAY""")
def trailing_window_by_files(spark, sf_dir):
    """The trailing days from the few files of a table that hold any."""
    path = work_dir(spark, "by-time")
    write_by_time(sales_lines(spark, sf_dir).select("segment", "timestamp", "target"), path)
    return read_trailing(spark, path)


def _broken_uploads(spark, sf_dir):
    """Uploads with broken JSON in one department and targets with a letter in another."""
    kind = F.col("department")
    return raw_uploads(spark, sf_dir).withColumns(
        {
            "productProperties": F.when(
                kind == "error", F.regexp_replace("productProperties", r"\}", "")
            ).otherwise(F.col("productProperties")),
            "target": F.when(kind == "view", F.concat("target", F.lit("x"))).otherwise(
                F.col("target")
            ),
        }
    )


@query("""SELECT CAST(event_id AS VARCHAR) AS row_id FROM events
WHERE event_type IN ('error', 'view')""")
def upload_rejects(spark, sf_dir):
    return rejected_rows(_broken_uploads(spark, sf_dir)).select("row_id")


@query("""SELECT event_id AS row_id, event_type AS department, event_type NOT IN ('error', 'view') AS kept,
       CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS prop_k,
       CASE WHEN event_type = 'error' THEN replace(props, '}', '') WHEN event_type = 'view' THEN props END AS text,
       CASE WHEN event_type = 'view' THEN CAST(value AS DECIMAL(18,2))::VARCHAR || 'x'
            ELSE CAST(value AS DECIMAL(18,2))::VARCHAR END::VARCHAR AS target,
       (SELECT count(*) FROM events WHERE event_type IN ('error', 'view')) AS n_rejected
FROM events""")
def upload_quarantined(spark, sf_dir):
    """Both outputs of the upload job, bad rows put aside."""
    path = work_dir(spark, "upload")
    _write_upload(_broken_uploads(spark, sf_dir), f"{path}/in")
    n = upload_job(spark, f"{path}/in", f"{path}/out", "quarantine", f"{path}/bad")
    kept = read_panel(spark, f"{path}/out").select(
        F.col("row_id").cast("bigint").alias("row_id"), "department", F.lit(True).alias("kept"), "prop_k",
        F.lit(None).cast("string").alias("text"),
        F.col("target").cast("decimal(18,2)").cast("string").alias("target"),
    )
    bad = spark.read.csv(f"{path}/bad", header=True, escape='"').select(
        F.col("row_id").cast("bigint"), "department", F.lit(False), F.lit(None).cast("bigint"),
        "productProperties", "target",
    )
    return kept.union(bad).withColumn("n_rejected", F.lit(n["rejected"]).cast("bigint"))


@query("""SELECT CAST(o_orderdate AS TIMESTAMP) AS "timestamp", o_orderstatus AS "Department",
       'P' || o_orderkey AS "Article", o_totalprice AS target,
       o_orderstatus || '|P' || o_orderkey AS segment FROM orders""")
def legacy_read(spark, sf_dir):
    path = work_dir(spark, "legacy")
    text = F.when(
        F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd.MM.yyyy")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    table(spark, sf_dir, "orders").select(
        text.alias("Date"), F.col("o_orderstatus").alias("Department"),
        F.concat(F.lit("P"), F.col("o_orderkey")).alias("Article"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("Sold"),
    ).write.option("header", True).csv(path)
    return read_legacy(spark, path)


PANEL_ROWS = f"""WITH {LINES}
SELECT segment, ts AS "timestamp", target, CAST(year(ts) AS INTEGER) AS year FROM lines"""


@query(PANEL_ROWS)
def panel_parquet(spark, sf_dir):
    path = work_dir(spark, "panel")
    lines = sales_lines(spark, sf_dir).select("segment", "timestamp", "target")
    write_panel(lines.withColumn("year", F.year("timestamp")), path, partition_by=["year"])
    return read_panel(spark, path)


@query(f"""WITH {LINES} SELECT segment, ts AS "timestamp", target FROM lines""")
def panel_csv(spark, sf_dir):
    path = work_dir(spark, "panel")
    write_panel(sales_lines(spark, sf_dir).select("segment", "timestamp", "target"), path, "csv")
    return read_panel(spark, path, "csv")


FORECAST_ROWS = f"""WITH {SIMPLE_FORECAST}
SELECT segment, ts AS "timestamp", round(target, 6) AS target,
       round(target_lower, 6) AS target_lower, round(target_upper, 6) AS target_upper FROM fc"""


def _forecast_layout(spark, sf_dir, layout):
    path = work_dir(spark, "forecast")
    write_forecast(simple_forecast(spark, sf_dir), path, layout)
    back = read_forecast(spark, path, layout)
    return back.withColumns(
        {c: F.round(c, 6) for c in ("target", "target_lower", "target_upper")}
    )


@query(FORECAST_ROWS)
def forecast_long_table(spark, sf_dir):
    return _forecast_layout(spark, sf_dir, "long")


@query(FORECAST_ROWS)
def forecast_json_rows(spark, sf_dir):
    return _forecast_layout(spark, sf_dir, "rows")


@query(FORECAST_ROWS)
def forecast_json_object(spark, sf_dir):
    return _forecast_layout(spark, sf_dir, "object")


@query("""SELECT p_partkey AS row_id, p_type AS department FROM part
WHERE p_type NOT IN ('MEDIUM') """)
def invalid_rows_file(spark, sf_dir):
    path = work_dir(spark, "invalid")
    write_invalid(invalid_targets(target_texts(spark, sf_dir)), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("row_id").cast("bigint").alias("row_id"), "department")


@query("""SELECT c_mktsegment AS "Артикул", count(*) AS "2024-01" FROM customer
GROUP BY c_mktsegment""")
def report_file(spark, sf_dir):
    path = work_dir(spark, "report")
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("Артикул")).agg(
        F.count(F.lit(1)).alias("2024-01")
    )
    write_report(counts, path)
    back = spark.read.option("header", True).csv(path)
    return back.withColumn("2024-01", F.col("2024-01").cast("bigint"))


@query()
def stored_model_forecast(spark, sf_dir):
    """A fitted model after a round trip through storage."""
    panel = cut_lineage(sales_panel(spark, sf_dir))
    path = work_dir(spark, "model")
    save_model(fit(panel, Linear(reg_param=0.01)), path)
    return predict(load_model(spark, path), future_grid(panel, HORIZON), segment_codes(panel))


CLOSED_MONTHS = f"""WITH {LINES},
closes AS (
  SELECT segment, date_trunc('month', ts) + INTERVAL 1 MONTH AS c, target FROM lines)
SELECT segment, CAST(c - INTERVAL 1 MONTH AS TIMESTAMP) AS "timestamp", sum(target) AS target
FROM closes GROUP BY segment, c
HAVING c <= (SELECT max(c) FROM closes) - INTERVAL 1 DAY"""


@query(CLOSED_MONTHS)
def streamed_months(spark, sf_dir):
    """Sales lines as a stream of files, summed per month; open months are not put out."""
    path = work_dir(spark, "stream")
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    stream = (
        spark.readStream.schema(lineitem.schema).option("pathGlobFilter", "lineitem.parquet")
        .parquet(sf_dir)
    )
    rows = stream.join(part, stream.l_partkey == part.p_partkey).select(
        F.concat("p_type", F.lit("|"), "p_brand").alias("segment"),
        F.col("l_shipdate").alias("timestamp"), F.col("l_quantity").alias("target"),
    )
    run = (
        stream_monthly(rows).writeStream.format("parquet").option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint").outputMode("append")
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    schema = "segment string, timestamp timestamp_ntz, target double"
    return spark.read.schema(schema).parquet(f"{path}/out")


@query(CLOSED_MONTHS)
def streamed_months_corrected(spark, sf_dir):
    """Sales lines as a stream of two runs; the second has lines of all months, most of them
    closed by then. After the corrections the sums are those of all lines."""
    path = work_dir(spark, "stream")
    lines = sales_lines(spark, sf_dir).select("segment", "timestamp", "target")
    late = F.pmod(F.xxhash64("segment", "timestamp", "target"), F.lit(7)) == 0
    for some in (lines.filter(~late), lines.filter(late)):
        some.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(lines.schema).parquet(f"{path}/in")
        run = run_monthly_corrected(stream, f"{path}/out", f"{path}/checkpoint", keep=4000)
        run.awaitTermination()
    schema = "segment string, timestamp timestamp_ntz, target double, revision int"
    return latest_revisions(spark.read.schema(schema).parquet(f"{path}/out"))


@query(UPLOADED)
def streamed_uploads_once(spark, sf_dir):
    """An upload that is dropped twice, under other names, counts once."""
    path = work_dir(spark, "stream")
    uploads = raw_uploads(spark, sf_dir)
    for _ in range(2):
        uploads.write.mode("append").option("sep", "|").option("header", True).option("escape", '"').csv(f"{path}/in")
    run = stream_uploads_once(
        spark, f"{path}/in", uploads.columns, T.StructType([T.StructField("k", T.LongType())]),
        f"{path}/out", f"{path}/checkpoint", numeric=("row_id",),
    )
    run.awaitTermination()
    return spark.read.parquet(f"{path}/out").drop("batch")


@query(UPLOADED)
def streamed_uploads(spark, sf_dir):
    path = work_dir(spark, "stream")
    uploads = raw_uploads(spark, sf_dir)
    _write_upload(uploads, f"{path}/in")
    run = stream_uploads(
        spark, f"{path}/in", uploads.columns, T.StructType([T.StructField("k", T.LongType())]),
        f"{path}/out", f"{path}/checkpoint", numeric=("row_id",),
    )
    run.awaitTermination()
    return spark.read.parquet(f"{path}/out")


FORECAST_RESULT = f"""WITH {ENSEMBLE}
SELECT segment, ts AS "timestamp", round(greatest(target, 0), 4) + 0.0 AS target,
       CASE WHEN lower_bound IS NOT NULL THEN round(greatest(lower_bound, 0), 4) + 0.0 END AS target_lower,
       CASE WHEN upper_bound IS NOT NULL THEN round(greatest(upper_bound, 0), 4) + 0.0 END AS target_upper
FROM bounded"""


def _stored_lines(spark, sf_dir, path):
    lines = sales_lines(spark, sf_dir).select("segment", "department", "timestamp", "target")
    write_panel(lines, f"{path}/lines")
    return f"{path}/lines"


def _rounded(fc):
    return fc.withColumns({c: F.round(c, 4) for c in ("target", "target_lower", "target_upper")})


@query(FORECAST_RESULT)
def refresh_run(spark, sf_dir):
    path = work_dir(spark, "run")
    refresh_job(spark, _stored_lines(spark, sf_dir, path), f"{path}/out", HORIZON, CLASSICAL)
    return _rounded(read_forecast(spark, f"{path}/out/forecast"))


def _appended(spark, sf_dir):
    """A refresh before the last three months and some late rows came, and one from there on.
    Returns the folder of the second."""
    path = work_dir(spark, "run")
    lines = sales_lines(spark, sf_dir).select("segment", "department", "timestamp", "target")
    last = lines.agg(F.max(F.trunc("timestamp", "month"))).scalar()
    late = (F.trunc("timestamp", "month") > F.add_months(last, -HORIZON)) | (
        (F.col("department") == "PROMO") & (F.col("target") == 50)
    )
    write_panel(lines.filter(~late), f"{path}/lines")
    refresh_job(spark, f"{path}/lines", f"{path}/first", HORIZON, CLASSICAL, keep_casts=True)
    write_panel(lines.filter(late), f"{path}/lines", mode="append")
    refresh_job(spark, f"{path}/lines", f"{path}/second", HORIZON, CLASSICAL, since=f"{path}/first")
    return f"{path}/second"


@query(FORECAST_RESULT)
def refresh_appended(spark, sf_dir):
    """A refresh that takes over what rests on unchanged months, against a whole one."""
    return _rounded(read_forecast(spark, f"{_appended(spark, sf_dir)}/forecast"))


@query(f"""WITH {LINES},
numbered AS (SELECT *, CAST(year(ts) * 12 + month(ts) - 1 AS INTEGER) AS m FROM lines),
known AS (
  SELECT *, m > max(m) OVER () - {HORIZON} OR (department = 'PROMO' AND target = 50) AS late
  FROM numbered),
origins AS (
  SELECT max(m) - back AS origin, back FROM known CROSS JOIN (SELECT unnest([9, 6, 3, 0]) AS back)
  GROUP BY back),
judged AS (
  SELECT segment, origin,
         bool_or(back = 0 OR (late AND m <= origin)) OR bool_and(late) AS recast
  FROM known CROSS JOIN origins GROUP BY segment, origin)
SELECT origin, count(*) AS segments, count(*) FILTER (recast) AS recast FROM judged GROUP BY origin""")
def refresh_recast(spark, sf_dir):
    """How many segments that refresh cast again, per origin."""
    digests = spark.read.parquet(f"{_appended(spark, sf_dir)}/digests")
    return digests.groupBy("origin").agg(
        F.count(F.lit(1)).alias("segments"), F.count_if("recast").alias("recast")
    )


@query(f"""WITH {ENSEMBLE},
named AS (
  SELECT segment, department, arg_max(product_name, (ts, product_name)) AS article
  FROM lines WHERE product_size < 25 GROUP BY ALL),
described AS (
  SELECT coalesce(n.department, 'UNKNOWN') AS department, coalesce(n.article, b.segment) AS article,
         b.target, b.lower_bound, b.upper_bound
  FROM bounded b LEFT JOIN named n USING (segment))
SELECT department, article, round(coalesce(sum(target), 0), 4) + 0.0 AS target,
       round_even(coalesce(sum(greatest(lower_bound, 0)), 0), 0) + 0.0 AS "target_0.025",
       round_even(coalesce(sum(greatest(upper_bound, 0)), 0), 0) + 0.0 AS "target_0.975"
FROM described GROUP BY ALL""")
def refresh_summary(spark, sf_dir):
    """The refresh job with metadata: sums per department and product name."""
    path = work_dir(spark, "run")
    small = F.col("product_size") < 25
    write_panel(
        sales_lines(spark, sf_dir).select(
            "segment", "timestamp", "target", F.when(small, F.col("department")).alias("kind"),
            F.when(small, F.col("product_name")).alias("name"),
        ), f"{path}/lines",
    )
    refresh_job(
        spark, f"{path}/lines", f"{path}/out", HORIZON, CLASSICAL, metadata=("kind", "name")
    )
    return spark.read.parquet(f"{path}/out/summary").withColumn("target", F.round("target", 4))


@query(FORECAST_RESULT)
def forecast_run(spark, sf_dir):
    path = work_dir(spark, "run")
    lines = _stored_lines(spark, sf_dir, path)
    refresh_job(spark, lines, f"{path}/first", HORIZON, CLASSICAL)
    return _rounded(forecast_job(spark, f"{path}/first/model", lines, f"{path}/second"))


@query(f"WITH {report_sql('department')} SELECT * FROM report")
def report_run(spark, sf_dir):
    path = work_dir(spark, "run")
    lines = _stored_lines(spark, sf_dir, path)
    write_forecast(simple_forecast(spark, sf_dir), f"{path}/forecast")
    return report_job(spark, lines, f"{path}/forecast", f"{path}/report")


def _stored_report(spark, sf_dir, path):
    lines = _stored_lines(spark, sf_dir, path)
    write_forecast(simple_forecast(spark, sf_dir), f"{path}/forecast")
    report_job(spark, lines, f"{path}/forecast", f"{path}/report")
    return f"{path}/report"


A, B = "last_123_days_sum", "forecast_123_days_mean"
RATED = f"""WITH {report_sql('department')}, rated AS (
  SELECT *, CASE WHEN {A} = 0 AND {B} = 0 THEN NULL WHEN {A} = 0 OR {B} = 0 THEN 0
    ELSE (1.0::DOUBLE - abs({A} - {B}) / greatest({A}, {B})) * 100 END AS p FROM report)"""


@query(f"""{RATED}
SELECT "{ARTICLE}", "{DEPARTMENT}", {A}, {B}, round(p, 4) AS accuracy_percent FROM rated""")
def stored_report_rows(spark, sf_dir):
    report = read_report(spark, _stored_report(spark, sf_dir, work_dir(spark, "run")))
    return with_accuracy(report).select(
        ARTICLE, DEPARTMENT, A, B, F.round("accuracy_percent", 4).alias("accuracy_percent")
    )


@query(f"""{RATED}
SELECT count(*) AS total_items, count(*) FILTER ({A} = 0 AND {B} = 0) AS zero_zero_items,
       count(*) FILTER ({B} <> 0) AS non_zero_forecast_items, count(p) AS valid_items,
       round(coalesce(avg(p), 0), 4) AS avg_accuracy,
       round(avg(p) FILTER ({B} <> 0), 4) AS avg_accuracy_non_zero_forecast FROM rated""")
def stored_report_accuracy(spark, sf_dir):
    path = work_dir(spark, "run")
    rows = accuracy_job(spark, _stored_report(spark, sf_dir, path), f"{path}/accuracy")
    return rows.withColumns({c: F.round(c, 4) for c in rows.columns if c.startswith("avg_")})


@query(f"""WITH {SIMPLE_FORECAST}
SELECT segment, ts AS "timestamp", round(target, 6) AS target,
       CAST(NULL AS DOUBLE) AS target_lower, CAST(NULL AS DOUBLE) AS target_upper FROM fc""")
def forecast_without_bounds(spark, sf_dir):
    path = work_dir(spark, "forecast")
    write_forecast(simple_forecast(spark, sf_dir).select("segment", "timestamp", "target"), path, "object")
    return read_forecast(spark, path, "object").withColumn("target", F.round("target", 6))
