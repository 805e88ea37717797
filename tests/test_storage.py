import glob
import json

import os

import pytest
from pyspark.sql import types as T

from salespanel.operators.learned import fit, predict, segment_codes
from salespanel.operators.panel import future_grid, regularise
from salespanel.operators.specs import CLASSICAL, Boosted, Linear, Naive, SeasonalMA
from salespanel.plans import forecast_job, refresh_job, report_job, tune_job, upload_job
from salespanel.sources import (
    file_bounds,
    read_trailing,
    write_by_time,
    read_report,
    read_upload,
    load_model,
    load_specs,
    read_forecast,
    save_model,
    save_specs,
    write_forecast,
    write_report,
)
from salespanel.streaming import (
    latest_revisions,
    run_monthly_corrected,
    stream_monthly,
    stream_monthly_corrected,
    stream_uploads,
    stream_uploads_once,
)

FORECAST = {
    f'D{i}|A] "{i}" ю': [
        {"timestamp": f"2025-{m:02d}-01", "target": i + m / 2, "target_lower": None, "target_upper": 1e10 * m}
        for m in range(1, 1 + i % 4)
    ]
    for i in range(300)
}


def as_rows(nested):
    rows = []
    for segment, points in nested.items():
        rows += [(segment, p["timestamp"], p["target"], p["target_lower"], p["target_upper"]) for p in points]
        if not points:
            rows.append((segment, None, None, None, None))
    return sorted(rows, key=str)


def long_rows(df):
    return sorted(
        (
            (r.segment, r.timestamp and r.timestamp.strftime("%Y-%m-%d"), r.target, r.target_lower, r.target_upper)
            for r in df.collect()
        ),
        key=str,
    )


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_indented_json_is_read_in_splits(spark, tmp_path, small_splits):
    path = tmp_path / "forecast.json"
    path.write_text(json.dumps(FORECAST, ensure_ascii=False, indent=2), encoding="utf-8")
    df = read_forecast(spark, str(path), "object")
    assert df.rdd.getNumPartitions() > 5
    assert long_rows(df) == as_rows(FORECAST)


@pytest.mark.parametrize("last", [[], FORECAST['D3|A] "3" ю']])
def test_last_entry_may_be_empty(spark, tmp_path, last):
    nested = {"a": FORECAST['D2|A] "2" ю'], "z": last}
    path = tmp_path / "forecast.json"
    path.write_text(json.dumps(nested, indent=2))
    assert long_rows(read_forecast(spark, str(path), "object")) == as_rows(nested)


def test_other_json_is_refused(spark, tmp_path):
    path = tmp_path / "forecast.json"
    path.write_text("[1, 2]")
    with pytest.raises(Exception, match="not two-space-indented JSON"):
        read_forecast(spark, str(path), "object").collect()


@pytest.mark.parametrize("layout", ["long", "rows", "object"])
def test_forecast_round_trip(spark, tmp_path, layout):
    source = tmp_path / "in.json"
    source.write_text(json.dumps(FORECAST, ensure_ascii=False, indent=2), encoding="utf-8")
    out = str(tmp_path / "out")
    write_forecast(read_forecast(spark, str(source), "object").repartition(7), out, layout)
    assert long_rows(read_forecast(spark, out, layout)) == as_rows(FORECAST)
    if layout == "object":
        text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{out}/part-*")))
        assert json.loads(text) == FORECAST and list(json.loads(text)) == sorted(FORECAST)


def test_empty_object_is_an_object(spark, tmp_path):
    none = spark.createDataFrame([], "segment string, timestamp timestamp_ntz, target double")
    write_forecast(none, str(tmp_path / "out"), "object")
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{tmp_path}/out/part-*")))
    assert json.loads(text) == {}
    assert read_forecast(spark, str(tmp_path / "out"), "object").count() == 0


@pytest.mark.parametrize("layout", ["long", "rows", "object"])
def test_forecast_without_bounds(spark, tmp_path, layout):
    points = spark.sql("SELECT 'D|a' AS segment, TIMESTAMP_NTZ '2025-07-01' AS timestamp, 2.5D AS target")
    write_forecast(points, str(tmp_path / "out"), layout)
    back = read_forecast(spark, str(tmp_path / "out"), layout).collect()
    assert [tuple(r)[2:] for r in back] == [(2.5, None, None)]


def test_report_round_trip(spark, tmp_path):
    rows = [(" a", 'x "1"', 3, 0), ("b\nc", "", 0, 12), ("07", "y,z", 1, 1)]
    names = "`Департамент` string, `Артикул` string, `2024-01` bigint, `last_123_days_sum` bigint"
    write_report(spark.createDataFrame(rows, names).repartition(2), str(tmp_path / "out"))
    back = read_report(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert [t for _, t in back.dtypes] == ["string", "string", "bigint", "bigint"]


def test_specs_round_trip(spark, tmp_path):
    specs = [SeasonalMA(2, 6), Boosted(max_iter=3, name="b"), Naive(12)]
    weights = {"seasonal_2_6": 0.5, "b": 0.3, "naive_12": 0.2}
    save_specs(spark, specs, weights, {"horizon": 3}, str(tmp_path / "s"))
    assert load_specs(spark, str(tmp_path / "s")) == (specs, weights, {"horizon": 3})


def test_model_round_trip_and_missing_model(spark, tmp_path, sales):
    panel = regularise(sales({f"D|{s}": {t: float(s + t) for t in range(12)} for s in range(4)}))
    model, codes = fit(panel, Linear(0.01)), segment_codes(panel)
    save_model(model, str(tmp_path / "m"))
    rows = future_grid(panel, 2)
    both = [
        sorted(map(tuple, predict(m, rows, codes).collect()))
        for m in (model, load_model(spark, str(tmp_path / "m")))
    ]
    assert both[0] == both[1] and len(both[0]) == 8
    with pytest.raises(Exception):
        load_model(spark, str(tmp_path / "nothing"))


def upload_text(rows):
    return "department|article|productProperties|target|timestamp\n" + "\n".join(rows) + "\n"


def test_each_dropped_file_counts_once(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    schema = T.StructType([T.StructField("k", T.LongType())])
    columns = ["department", "article", "productProperties", "target", "timestamp"]

    def run():
        stream_uploads(
            spark, str(drop), columns, schema, str(tmp_path / "out"), str(tmp_path / "cp")
        ).awaitTermination()
        return sorted((r.segment, r.target, r.prop_k) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    (drop / "1.csv").write_text(upload_text(['D|A|"{""k"": 1}"|-2|2024-01-01', "D|bad|{|5|2024-01-01"]))
    assert run() == [("D|A", 0.0, 1)]
    (drop / "2.csv").write_text(upload_text(['D|B|"{}"|3|2024-01-01']))
    assert run() == [("D|A", 0.0, 1), ("D|B", 3.0, 0)]
    assert len(run()) == 2


def test_months_are_put_out_when_closed(spark, tmp_path):
    drop, schema = tmp_path / "rows", "segment string, timestamp timestamp_ntz, target double"

    def feed(rows):
        spark.createDataFrame(rows, "segment string, timestamp string, target double").selectExpr(
            "segment", "cast(timestamp as timestamp_ntz) timestamp", "target"
        ).coalesce(1).write.mode("append").parquet(str(drop))
        run = (
            stream_monthly(spark.readStream.schema(schema).parquet(str(drop))).writeStream.format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
            .outputMode("append").trigger(availableNow=True).start()
        )
        run.awaitTermination()
        got = spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()
        return sorted((r.segment, r.timestamp.strftime("%Y-%m"), r.target) for r in got)

    assert feed([("a", "2024-01-03", 1.0), ("a", "2024-01-31", 2.0), ("a", "2024-02-01", 4.0)]) == [("a", "2024-01", 3.0)]
    got = feed([("a", "2024-01-15", 100.0), ("a", "2024-02-20", 5.0), ("b", "2024-03-01", 7.0)])
    assert got == [("a", "2024-01", 3.0), ("a", "2024-02", 9.0)]


def test_late_rows_correct_closed_months(spark, tmp_path):
    drop, schema = tmp_path / "rows", "segment string, timestamp timestamp_ntz, target double"

    def feed(rows, keep=60):
        spark.createDataFrame(rows, "segment string, timestamp string, target double").selectExpr(
            "segment", "cast(timestamp as timestamp_ntz) timestamp", "target"
        ).coalesce(1).write.mode("append").parquet(str(drop))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(drop))
        run_monthly_corrected(stream, str(tmp_path / "out"), str(tmp_path / "cp"), keep=keep).awaitTermination()
        got = spark.read.schema(schema + ", revision int").parquet(str(tmp_path / "out"))
        return (
            sorted((r.segment, r.timestamp.strftime("%m"), r.target, r.revision) for r in got.collect()),
            sorted((r.segment, r.timestamp.strftime("%m"), r.target) for r in latest_revisions(got).collect()),
        )

    first = [("a", "2024-01-03", 1.0), ("a", "2024-01-31", None), ("a", "2024-02-01", 4.0), (None, "2024-01-01", 9.0), ("a", None, 9.0)]
    assert feed(first) == ([("a", "01", 1.0, 1)], [("a", "01", 1.0)])
    every, latest = feed([("a", "2024-01-15", 100.0), ("b", "2024-01-20", 5.0), ("a", "2024-03-01", 7.0)])
    assert every == [("a", "01", 1.0, 1), ("a", "01", 101.0, 2), ("a", "02", 4.0, 1), ("b", "01", 5.0, 1)]
    assert latest == [("a", "01", 101.0), ("a", "02", 4.0), ("b", "01", 5.0)]
    feed([("a", "2024-06-15", 1.0)])  # January is forgotten 60 days after its end
    every, latest = feed([("a", "2024-01-15", 1000.0), ("a", "2024-05-02", 3.0)])
    assert ("a", "01", 101.0) in latest and ("a", "05", 3.0) in latest
    with pytest.raises(ValueError):
        stream_monthly_corrected(spark.readStream.schema(schema).parquet(str(drop)), late=5, keep=5)


def test_a_file_under_two_names_counts_once(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    columns = ["department", "article", "productProperties", "target", "timestamp"]
    schema = T.StructType([T.StructField("k", T.LongType())])

    def run():
        stream_uploads_once(
            spark, str(drop), columns, schema, str(tmp_path / "out"), str(tmp_path / "cp"), files_per_batch=2
        ).awaitTermination()
        return sorted((r.segment, r.target) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    twice = upload_text(['D|A|"{""k"": 1}"|2|2024-01-01'] * 2)  # equal rows of one file both count
    for name in ("1.csv", "2 copy.csv", "3.csv"):
        (drop / name).write_text(twice)
    assert run() == [("D|A", 2.0)] * 2
    (drop / "4.csv").write_text(twice)
    (drop / "5.csv").write_text(upload_text(['D|A|"{""k"": 1}"|2|2024-01-01', 'D|B|"{}"|3|2024-01-01']))
    assert run() == [("D|A", 2.0)] * 3 + [("D|B", 3.0)]
    (drop / "6.csv").write_text("article|department|productProperties|target|timestamp\nA|D|{}|1|2024-01-01\n")
    with pytest.raises(Exception, match="columns"):
        run()


@pytest.mark.parametrize("blanks", [1, 2])
def test_headers_with_blanks_are_compared(spark, tmp_path, blanks):
    lead = "|" * blanks
    (tmp_path / "1.csv").write_text(f"{lead}department|article\n{'0|' * blanks}D|A\n")
    (tmp_path / "2.csv").write_text(f"{lead}department|article\n{'|' * blanks}E|\n")
    got = read_upload(spark, str(tmp_path))
    assert got.columns == [f"Unnamed: {i}" for i in range(blanks)] + ["department", "article"]
    assert sorted((r[0], r.department, r.article) for r in got.collect() if r[0]) == [("0", "D", "A")]
    assert [tuple(r) for r in got.filter("department = 'E'").collect()] == [(None,) * blanks + ("E", None)]
    (tmp_path / "3.csv").write_text(f"{lead}article|department\n{'1|' * blanks}A|D\n")
    with pytest.raises(Exception):
        read_upload(spark, str(tmp_path)).collect()


def test_trailing_rows_come_from_the_last_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).selectExpr(
        "id", "timestamp_ntz '2020-01-01' + make_dt_interval(cast(id % 1000 as int)) timestamp"
    )
    write_by_time(rows.repartition(5), path, files=10)
    every = spark.read.parquet(path)
    found = read_trailing(spark, path, days=30)
    assert found.schema == every.schema and found.count() == 31 * 20
    assert 0 < len(found.inputFiles()) < len(every.inputFiles()) / 2
    assert file_bounds(spark, path).agg({"n": "sum"}).first()[0] == 20_000
    # files without bounds are looked at, those that are gone are not missed
    late = spark.range(3).selectExpr("id", "timestamp_ntz '2022-11-01' timestamp")
    late.coalesce(1).write.mode("append").parquet(path)
    assert read_trailing(spark, path, days=60).count() == 3 + 20 * 25
    for f in read_trailing(spark, path, days=1).inputFiles():
        os.remove(f.removeprefix("file://"))
    assert read_trailing(spark, path, days=30).count() == 31 * 20
    write_by_time(rows.limit(0), str(tmp_path / "none"))
    assert read_trailing(spark, str(tmp_path / "none")).collect() == []


@pytest.fixture
def stored_rows(spark, tmp_path, sales):
    series = {
        f"D{s % 2}|A{s}": {t: float(10 * s + (t * 7 + s) % 12) for t in range(30) if (t + s) % 9}
        for s in range(5)
    }
    path = str(tmp_path / "rows")
    sales(series).selectExpr("*", "split(segment, '[|]')[0] department").write.parquet(path)
    return path


def test_refresh_then_forecast_give_the_same(spark, tmp_path, stored_rows):
    out = str(tmp_path / "run")
    specs = (*CLASSICAL, Boosted(max_iter=2, max_depth=2, name="trees"), Linear(0.01))
    weights = refresh_job(spark, stored_rows, out, horizon=2, specs=specs, layout="object")
    assert len(weights) == 5 and sum(weights.values()) == pytest.approx(1)
    first = long_rows(read_forecast(spark, f"{out}/forecast", "object"))
    assert len(first) == 10 and all(r[2] >= 0 and r[3] <= r[2] <= r[4] for r in first)
    again = long_rows(forecast_job(spark, f"{out}/model", stored_rows, str(tmp_path / "second")))
    for a, b in zip(first, again):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])
    report = report_job(spark, stored_rows, f"{out}/forecast", str(tmp_path / "report"), layout="object")
    assert report.count() == 5 and len([c for c in report.columns if c.endswith("_mean")]) == 3


def test_tuned_model_forecasts(spark, tmp_path, stored_rows):
    space = {"max_iter": ("int", 1, 2), "max_depth": ("int", 1, 2)}
    out = str(tmp_path / "tuned")
    best = tune_job(spark, stored_rows, out, horizon=2, n_trials=2, n_folds=2, space=space)
    assert best.name in ("trial_0", "trial_1")
    got = forecast_job(spark, f"{out}/model", stored_rows, str(tmp_path / "fc"))
    assert got.count() == 10


def test_upload_job_keeps_rejects(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(upload_text(['D|A|"{""k"": 1}"|2|2024-01-01', "D|bad|{|5|2024-01-01"]))
    upload_job(spark, str(path), str(tmp_path / "out"), "quarantine", str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "bad")).first().article == "bad"


def test_stored_codes_serve_a_changed_panel(spark, tmp_path, sales):
    """A segment that is new, or gone, moves no code of the others."""
    def rows(names, path):
        months = {n: {t: 10.0 * (ord(n) - 64) for t in range(30)} for n in names}
        panel = sales({f"{n}|x": v for n, v in months.items()})
        panel.selectExpr("*", "split(segment, '[|]')[0] department").write.parquet(path)
        return path

    space = {"max_iter": ("int", 3, 3), "max_depth": ("int", 4, 4)}
    first = rows("BCDEFG", str(tmp_path / "first"))
    tune_job(spark, first, str(tmp_path / "m"), horizon=1, n_trials=1, n_folds=1, space=space)

    def targets(path, out):
        fc = forecast_job(spark, f"{tmp_path}/m/model", path, str(tmp_path / out))
        return {r[0]: r[2] for r in long_rows(fc)}

    same = targets(first, "o1")
    more = targets(rows("ABCDEFG", str(tmp_path / "more")), "o2")
    fewer = targets(rows("BDG", str(tmp_path / "fewer")), "o3")
    assert all(more[s] == pytest.approx(same[s]) for s in same)
    assert all(fewer[s] == pytest.approx(same[s]) for s in fewer) and len(fewer) == 3


def test_upload_headers_and_line_breaks(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/1.csv").write_text('department|article|productProperties\nD|A|"{""k"": ""x\ny""}"\nD|B|"{}"\n')
    got = read_upload(spark, str(tmp_path / "a"))
    assert sorted(r.article for r in got.collect()) == ["A", "B"]
    (tmp_path / "a/2.csv").write_text('article|department|productProperties\nE|D|"{}"\n')
    with pytest.raises(Exception, match="(?i)header"):
        read_upload(spark, str(tmp_path / "a")).collect()
