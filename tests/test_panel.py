import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from salespanel.operators.features import (
    add_date_flags,
    add_holiday,
    decompose,
    dense_codes,
    impute_seasonal,
    label_encode,
    log_target,
    one_hot,
    unlog,
)
from salespanel.operators.panel import drop_zero_segments, future_grid, regularise

SERIES = {
    "D|zero": {0: 0.0, 1: 0.0},
    "D|missing": {0: None, 2: None},
    "D|zero and missing": {0: 0.0, 1: None},
    "D|gap": {0: 1.0, 3: 4.0},
    "D|late": {2: 5.0, 3: 6.0},
    "A|B|C": {1: 7.0},
    "solo": {0: 8.0},
    None: {0: 9.0},
}


def grid(df):
    out = {}
    for r in df.orderBy("segment", "t_idx").collect():
        out.setdefault(r.segment, []).append(r.target)
    return out


def test_every_segment_gets_every_month(spark, sales):
    got = grid(regularise(sales(SERIES)))
    assert got["D|gap"] == [1, None, None, 4] and got["D|late"] == [None, None, 5, 6]
    assert got["A|B|C"] == [None, 7, None, None] and got["D|missing"] == [None] * 4
    assert None not in got and len(got) == 7


def test_bounds_come_from_the_kept_segments_only(spark, sales):
    series = {"dead": {0: 0.0, 9: 0.0}, "live": {3: 1.0, 5: 0.0}}
    panel = regularise(sales(series), drop_zero=True)
    rows = panel.orderBy("t_idx").collect()
    assert [(r.t_idx, r.from_end, r.target) for r in rows] == [(0, 2, 1.0), (1, 1, None), (2, 0, 0.0)]
    assert str(rows[0].timestamp) == "2020-04-01 00:00:00"


def test_zero_segments(spark, sales):
    kept = {r.segment for r in drop_zero_segments(sales(SERIES)).collect()}
    assert kept == {"D|missing", "D|zero and missing", "D|gap", "D|late", "A|B|C", "solo"}
    strict = {r.segment for r in drop_zero_segments(sales(SERIES), null_is_nonzero=False).collect()}
    assert strict == {"D|gap", "D|late", "A|B|C", "solo"}


def test_rows_of_a_hot_segment_are_all_kept(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") < 12000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("segment"),
        F.lit(1.0).alias("target"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = drop_zero_segments(rows)
        assert kept.filter("segment = 'hot'").count() == 12000 and kept.count() == 20000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicates_are_summed_or_refused(spark, sales):
    twice = sales({"a": {0: 1.0}}).unionAll(sales({"a": {0: 2.0, 1: 3.0}}))
    assert grid(regularise(twice)) == {"a": [3, 3]}
    with pytest.raises(Exception, match="two rows for one segment and month"):
        regularise(twice, duplicates="error").collect()


def test_result_does_not_depend_on_partitioning(spark, sales):
    base = sales(SERIES)
    expected = grid(regularise(base))
    for n in (1, 3, 13):
        assert grid(regularise(base.repartition(n).orderBy(F.rand(n)))) == expected


def test_imputation_uses_earlier_values_only(spark, sales):
    panel = regularise(sales({"a": {1: 2.0, 2: 4.0, 5: 9.0}, "b": {0: 1.0, 6: 1.0}}))
    got = grid(impute_seasonal(panel))
    assert got["a"] == [None, 2, 4, 3, 3, 9, 5]
    phased = grid(impute_seasonal(panel, seasonality=2))
    assert phased["a"] == [None, 2, 4, 2, 4, 9, 4]


def test_log_is_inverted_and_refuses_negatives(spark, sales):
    values = {i: v for i, v in enumerate([0.0, 1.0, 12345.678, 1e-9])}
    back = log_target(sales({"a": values})).select(unlog("target").alias("y")).collect()
    assert all(math.isclose(r.y, v, abs_tol=1e-9, rel_tol=1e-12) for r, v in zip(back, values.values()))
    with pytest.raises(Exception, match="log of a negative target"):
        log_target(sales({"a": {0: -1.0}})).collect()


def test_holidays_match_by_country_and_day(spark, sales):
    days = spark.createDataFrame(
        [("RUS", "2020-02-01", "x"), ("RUS", "2020-02-01", "twice"), ("RUS", "2020-03-08", "y"), ("KAZ", "2020-03-01", "z")],
        "iso_code string, date string, name string",
    )
    rows = add_holiday(sales({"a": {0: 1.0, 1: 1.0, 2: 1.0}}), days).orderBy("timestamp").collect()
    assert [r.holiday for r in rows] == [0, 1, 0]


def test_date_flags(spark, sales):
    rows = add_date_flags(sales({"a": {11: 1.0, 14: 1.0}})).orderBy("timestamp").collect()
    assert [(r.flag_month_number_in_year, r.flag_season_number, r.flag_year_number) for r in rows] == [
        (12, 1, 2020), (3, 2, 2021),
    ]
    with pytest.raises(ValueError, match="unknown date flag"):
        add_date_flags(sales({"a": {0: 1.0}}), ["moon"])


@pytest.mark.parametrize("cuts", [1, 7, 256])
def test_codes_are_dense_and_sorted(spark, cuts):
    keys = [f"k{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys + keys[:100]] + [(None,)], "k string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(cuts))
    try:
        got = {r.k: r.code for r in dense_codes(df, "k", "code").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {k: i for i, k in enumerate(keys)}


def test_label_encode_leaves_missing_uncoded(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    assert {r.c: r.c_label for r in label_encode(df, ["c"]).collect()} == {"a": 0, "b": 1, None: None}


def test_one_hot_has_a_slot_for_missing(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), (None, "x")], "c string, d string")
    got = {r.c: (list(r.c_onehot), list(r.d_onehot)) for r in one_hot(df, ["c", "d"]).collect()}
    assert got == {"a": ([1, 0, 0], [0, 1]), "b": ([0, 1, 0], [1, 0]), None: ([0, 0, 1], [1, 0])}


@pytest.mark.parametrize("period", [3, 4])
def test_decomposition_recovers_trend_and_season(spark, sales, period):
    season = [5.0, -2.0, -3.0, 0.0][:period]
    season = [s - sum(season) / period for s in season]
    values = {t: 100 + 2.0 * t + season[t % period] for t in range(24)}
    rows = decompose(regularise(sales({"a": values})), period).orderBy("t_idx").collect()
    inside = [r for r in rows if r.trend is not None]
    assert len(inside) == 24 - 2 * (period // 2)
    for r in inside:
        assert r.trend == pytest.approx(100 + 2.0 * r.t_idx)
        assert r.seasonal == pytest.approx(season[r.t_idx % period]) and r.resid == pytest.approx(0, abs=1e-9)


def test_future_months(spark, sales):
    rows = future_grid(regularise(sales({"a": {0: 1.0, 10: 1.0}})), 3).orderBy("h").collect()
    assert [(r.h, r.t_idx, pd.Timestamp(r.timestamp).strftime("%Y-%m")) for r in rows] == [
        (1, 11, "2020-12"), (2, 12, "2021-01"), (3, 13, "2021-02"),
    ]


def test_panel_reads_the_rows_once(spark, tmp_path, sales):
    """The bounds and the panel share the exchange of the monthly sums."""
    path = str(tmp_path / "rows")
    sales({"a": {0: 1.0, 3: 2.0}, "b": {1: 0.0}}).write.parquet(path)
    panel = regularise(spark.read.parquet(path), drop_zero=True)
    panel.collect()
    final = panel._jdf.queryExecution().executedPlan().toString().split("Initial Plan")
    assert "ReusedExchange" in "".join(final)


@pytest.mark.parametrize("cuts", [1, 2, 7, 8, 9, 200])
def test_codes_with_any_number_of_ranges(spark, cuts):
    keys = [None, "", "a", "aa", "b", "ж", *(f"k{i:03d}" for i in range(0, 150, 3))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", cuts)
    try:
        codes = dense_codes(spark.createDataFrame([(k,) for k in keys + keys], "key string"), "key", "code")
        got = {r.key: r.code for r in codes.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {k: i for i, k in enumerate(sorted(keys[1:]))}
