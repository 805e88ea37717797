import pandas as pd
import pytest

from salespanel.operators.accuracy import accuracy_detail, accuracy_summary
from salespanel.operators.report import (
    ARTICLE,
    DEPARTMENT,
    combined_report,
    preview,
    report_stats,
    trailing_days,
)
from salespanel.operators.summary import (
    attach_meta,
    forecast_summary,
    horizon_totals,
    latest_attributes,
    quantile_totals,
    segment_sums,
)

FC = "segment string, timestamp string, target double, target_lower double, target_upper double"

HISTORY = [
    ("D1|A", "D1", "2025-01-01", 10.0), ("D1|A", "D1", "2025-01-15", 2.5), ("D1|A", "D1", "2025-06-01", -4.0),
    ("D2|A", "D2", "2025-05-01", 3.5), ("D2|B", "D2", "2025-02-27", 7.0), ("D2|B", "D2", "2025-02-28", 1.0),
    ("D3|X|C", "D3", "2025-06-30", 4.0), (None, "D9", "2025-06-30", 99.0), ("D1|N", "D1", "2025-06-01", None),
    ("D1|E", "D1", "2025-06-01", 1.0), ("D4|E", "D4", "2025-06-01", 1.0), ("D8|Z", None, "2025-07-01", 5.0),
]
FORECAST = [
    ("D1|A", "2025-07-01", 10.5, 8.0, 13.0), ("D1|A", "2025-08-01", 2.0, None, 3.0), ("D2|A", "2025-07-01", 1.0, 0.5, 1.5),
    ("D5|F", "2025-07-01", 4.0, 3.0, 5.0), ("solo", "2025-07-01", 6.0, 5.0, 7.0), ("D1|E", None, None, None, None),
    ("D4|E", None, None, None, None), ("D7|only empty", None, None, None, None), ("D3|X|C", "2025-07-01", -3.0, -4.0, 2.5),
    ("D3|Y|C", "2025-08-01", 1.0, 1.0, 1.0),
]


@pytest.fixture
def history(spark):
    return spark.createDataFrame(
        HISTORY, "segment string, department string, timestamp string, target double"
    ).selectExpr("segment", "department", "cast(timestamp as timestamp_ntz) timestamp", "target")


@pytest.fixture
def fc(spark):
    return spark.createDataFrame(FORECAST, FC).selectExpr(
        "segment", "cast(timestamp as timestamp_ntz) timestamp", "target", "target_lower", "target_upper"
    )


def whole(x):
    return 0 if pd.isna(x) else max(0, round(x))


def brute_report(grain):
    """The report by pandas: pivots, outer joins, then left joins of the totals."""
    keys = ["d", "a"] if grain == "department" else ["a"]
    h = pd.DataFrame(HISTORY, columns=["s", "d", "ts", "y"])
    h["a"] = h.s.str.split("|").str[-1]
    h["ts"] = pd.to_datetime(h.ts)
    h["m"] = h.ts.dt.strftime("%Y-%m")
    f = pd.DataFrame(FORECAST, columns=["s", "ts", "mean", "lower", "upper"])
    f["a"] = f.s.str.split("|").str[-1]
    f["d"] = [s.split("|")[0] if "|" in s else "Unknown" for s in f.s]
    f["m"] = pd.to_datetime(f.ts).dt.strftime("%Y-%m")
    out = h.groupby(keys + ["m"]).y.sum().map(whole).unstack(fill_value=0)
    for c in ("mean", "lower", "upper"):
        side = f.groupby(keys + ["m"])[c].sum().map(whole).unstack(fill_value=0)
        side.columns = [f"{m}-forecast_{c}" for m in side.columns]
        out = out.join(side, how="outer")
    out = out.reset_index()
    recent = h[h.ts >= h.ts.max() - pd.Timedelta(days=123)].groupby(keys).y.sum().map(whole)
    name, prefix = (
        ("last_123_days_sum", "forecast_123_days") if grain == "department"
        else ("last_3_month_sum", "forecast_3_month")
    )
    out = out.merge(recent.rename(name).reset_index(), on=keys, how="left")
    totals = f.groupby(["s", *keys])[["mean", "lower", "upper"]].sum().map(whole).reset_index()
    totals = totals.drop(columns="s").rename(columns={c: f"{prefix}_{c}" for c in ("mean", "lower", "upper")})
    out = out.merge(totals, on=keys, how="left").fillna(0)
    middle = [c for c in out.columns if c not in keys and "_123_" not in c and "_3_" not in c]
    last = [name, *[f"{prefix}_{c}" for c in ("mean", "lower", "upper")]]
    order = keys + sorted(c for c in middle if "forecast" not in c) + sorted(c for c in middle if "forecast" in c) + last
    return out[order].rename(columns={"d": DEPARTMENT, "a": ARTICLE})


@pytest.mark.parametrize("grain", ["department", "article"])
def test_report_equals_brute_force(spark, history, fc, grain):
    got, expected = combined_report(history, fc, grain), brute_report(grain)
    assert got.columns == list(expected.columns)
    rows = [tuple(r) for r in got.collect()]
    plain = [tuple(v if isinstance(v, str) else int(v) for v in r) for r in expected.itertuples(index=False)]
    assert sorted(rows) == sorted(plain)
    keys = 2 if grain == "department" else 1
    assert [r[:keys] for r in rows] == sorted(r[:keys] for r in rows)


def test_article_in_two_departments_has_two_rows_or_one(spark, history, fc):
    per_segment = combined_report(history, fc, "article")
    assert per_segment.filter(f"`{ARTICLE}` = 'A'").count() == 2
    one = combined_report(history, fc, "article", forecast_totals="per_key")
    row = one.filter(f"`{ARTICLE}` = 'A'").collect()
    assert len(row) == 1 and row[0].forecast_3_month_mean == 14  # 13.5 to the even 14


def test_given_months_run_nothing_early(spark, history, fc):
    months = (["2025-05", "2025-06"], ["2025-07"])
    report = combined_report(history, fc, months=months)
    assert report.columns[2:7] == [
        "2025-05", "2025-06", "2025-07-forecast_lower", "2025-07-forecast_mean", "2025-07-forecast_upper",
    ]
    assert report.count() == 10  # nine keys, one of them with two segments


def test_totals_equal_the_source(spark, history, fc):
    report = combined_report(history.filter("target >= 0"), fc)
    months = [c for c in report.columns[2:] if len(c) == 7]
    total = sum(sum(r[c] for c in months) for r in report.select(*months).collect())
    assert abs(total - sum(y for s, d, _, y in HISTORY if s and d and y and y > 0)) <= len(HISTORY) / 2


def test_trailing_days_include_both_ends(spark):
    days = spark.createDataFrame([(d.to_pydatetime(),) for d in pd.date_range("2025-01-01", "2025-06-30")], "timestamp timestamp")
    assert trailing_days(days).count() == 124


def test_stats_and_preview(spark, history, fc):
    report = combined_report(history, fc)
    row = report_stats(report, fc).first()
    assert (row.departments, row.articles, row.history_months, row.forecast_months) == (6, 7, 4, 2)
    assert (row.forecast_rows, row.forecast_articles) == (7, 4)
    assert len(preview(report, 3).columns) == 8 and preview(report, 3).count() == 3


def test_summary_clips_quantiles_but_not_the_target(spark):
    rows = [("D|A", "x", -5.0, -1.0, 2.5), ("D|A", "y", 1.0, 2.5, float("nan")), ("solo", "x", 9.0, 9.0, 9.0), ("D|B", "x", 1.0, None, None)]
    fc = spark.createDataFrame(rows, "segment string, timestamp string, target double, `target_0.1` double, `target_0.95` double")
    assert [tuple(r) for r in forecast_summary(fc).collect()] == [("D", "A", -4.0, 2.0, 2.0), ("D", "B", 1.0, 0.0, 0.0)]
    assert tuple(quantile_totals(fc).first()) == (11.5, 11.5)


def test_segment_sums_and_totals(spark, fc):
    sums = {r.segment: (r.total, r.is_total) for r in segment_sums(fc).collect()}
    assert sums["D1|A"] == (12.5, 0) and sums["D1|E"] == (0.0, 0)
    assert sums["ИТОГО"] == (21.5, 1) and len(sums) == 10
    totals = {r.segment: tuple(r)[1:] for r in horizon_totals(fc).collect()}
    assert totals["D1|A"] == (12, 8, 16) and totals["D3|X|C"] == (0, 0, 2)


def test_latest_attribute_skips_missing_per_column(spark):
    rows = [("s", 1, "a", "p"), ("s", 2, "b", None), ("s", 3, None, None), ("s", 2, "c", None), ("t", 1, None, None)]
    df = spark.createDataFrame(rows, "segment string, timestamp int, x string, y string")
    got = {r.segment: (r.x, r.y) for r in latest_attributes(df, cols=["x", "y"]).collect()}
    assert got == {"s": ("c", "p"), "t": (None, None)}


def test_metadata_defaults(spark):
    meta = spark.createDataFrame([("a", "D", "n"), ("b", None, None)], "segment string, department string, article string")
    fc = spark.createDataFrame([("a",), ("b",), ("c",)], "segment string")
    got = {r.segment: (r.department, r.article, r.article_code) for r in attach_meta(fc, meta).collect()}
    assert got == {"a": ("D", "n", "a"), "b": ("UNKNOWN", "b", "b"), "c": ("UNKNOWN", "c", "c")}


def test_accuracy_of_a_report(spark):
    df = spark.createDataFrame(
        [("a", 0, 0), ("b", 0, 5), ("c", 5, 0), ("d", 80, 100)],
        f"`{ARTICLE}` string, last_123_days_sum int, forecast_123_days_mean int",
    )
    one, two = accuracy_summary(df, 1).first(), accuracy_summary(df, 2).first()
    assert (one.total_items, one.zero_zero_items, one.valid_items, one.non_zero_forecast_items) == (4, 1, 3, 2)
    assert one.avg_accuracy == pytest.approx(80 / 3) and one.avg_accuracy_non_zero_forecast == pytest.approx(40)
    assert two.avg_accuracy == pytest.approx(45) and two.other_items == 3
    assert two.avg_accuracy_without_zero_zero == pytest.approx(80 / 3)
    notes = [r.note for r in accuracy_detail(df).orderBy(f"`{ARTICLE}`").collect()]
    assert notes == ["0-0 (исключен)", "0 vs не-0", "0 vs не-0", "расчет"]
    empty = accuracy_summary(df.filter("last_123_days_sum = 0 and forecast_123_days_mean = 0"), 1).first()
    assert empty.avg_accuracy == 0 and empty.avg_accuracy_non_zero_forecast is None
    with pytest.raises(ValueError, match="last_123_days_sum"):
        accuracy_summary(df.drop("last_123_days_sum"))
