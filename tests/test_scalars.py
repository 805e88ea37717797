import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salespanel.functions import (
    accuracy,
    accuracy_note,
    clip0_fill,
    clip0_keep,
    is_valid_target,
    na_to_null,
    parse_ts,
    process_number,
    round_half_even,
    segment_key,
    split_segment,
    split_segment_last,
)

NAN = float("nan")


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("y")).collect()]


def test_clip_fill_and_keep(spark):
    values = [-1.5, 0.0, 2.5, None, NAN, -0.0]
    assert column(spark, values, "double", clip0_fill("x")) == [0, 0, 2.5, 0, 0, 0]
    assert column(spark, values, "double", clip0_keep("x")) == [0, 0, 2.5, None, None, 0]


def test_process_number_rounds_half_to_even_and_clips(spark):
    values = [2.5, 3.5, -0.4, -7.0, 0.5, 1.49, None, NAN]
    assert column(spark, values, "double", process_number("x")) == [2, 4, 0, 0, 0, 1, 0, 0]
    assert column(spark, values[:6], "double", round_half_even("x")) == [2, 4, 0, -7, 0, 1]


def test_segment_key_and_splits(spark):
    df = spark.createDataFrame([("A", "1"), (None, "1"), ("A", None)], "d string, a string")
    assert [r[0] for r in df.select(segment_key("d", "a")).collect()] == ["A|1", None, None]
    keys = ["A|1", "A|B|C", "solo", None, "A|"]
    first, second = split_segment("x")
    assert column(spark, keys, "string", first) == ["A", "A", "solo", None, "A"]
    assert column(spark, keys, "string", second) == ["1", "B", None, None, ""]
    first, last = split_segment_last("x")
    assert column(spark, keys, "string", first) == ["A", "A", "Unknown", None, "A"]
    assert column(spark, keys, "string", last) == ["1", "C", "solo", None, ""]


@pytest.mark.parametrize(
    "text,valid",
    [
        ("5", True), (" 7 ", True), ("1e3", True), ("-0", True), ("5.0", True), ("\t8\n", True),
        ("1.5", False), ("-1", False), ("5d", False), ("inf", False), ("1e400", False),
        ("nan", False), ("", False), ("NA", False), (None, False), ("1_0", False), (".", False),
    ],
)
def test_target_validity(spark, text, valid):
    assert column(spark, [text], "string", is_valid_target("x")) == [valid]


def test_na_tokens(spark):
    assert column(spark, ["NA", "", "None", "x", "na"], "string", na_to_null("x")) == [
        None, None, None, "x", "na",
    ]


def test_dates_are_day_first(spark):
    got = column(
        spark, ["02.01.2024", "2024-01-02", "31.02.2024", "2/1/2024", None, "x", "02.01.2024 9:05:07"],
        "string", parse_ts("x").cast("string"),
    )
    day = "2024-01-02 00:00:00"
    assert got == [day, day, None, day, None, None, "2024-01-02 09:05:07"]


def test_dates_do_not_depend_on_the_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:  # midnight did not exist there on this day
        assert column(spark, ["15.10.1995"], "string", parse_ts("x").cast("string")) == [
            "1995-10-15 00:00:00"
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


ACCURACY_CASES = [
    (0, 0, None, 100), (0, 5, 0, 0), (5, 0, 0, 0), (80, 100, 80, 80), (100, 80, 80, 80), (7, 7, 100, 100),
]


def test_accuracy_variants_and_notes(spark):
    df = spark.createDataFrame([(a, f) for a, f, _, _ in ACCURACY_CASES], "a int, f int").coalesce(1)
    p = accuracy("a", "f")
    rows = df.select(
        p.alias("one"), accuracy("a", "f", "hundred").alias("two"),
        accuracy_note("a", "f", p, "en").alias("note"),
    ).collect()
    for row, (_, _, one, two) in zip(rows, ACCURACY_CASES):
        assert row.one == (None if one is None else pytest.approx(one))
        assert row.two == pytest.approx(two)
    assert [r.note for r in rows] == [
        "0-0 excluded", "0 vs non-0", "0 vs non-0", "computed", "computed", "computed",
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.floats(-1e6, 1e6, allow_nan=False), st.floats(-1e6, 1e6, allow_nan=False)
), min_size=1, max_size=20))
def test_accuracy_is_a_percentage_or_missing(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, f double")
    for (got,) in df.select(accuracy("a", "f")).collect():
        assert got is None or 0 <= got <= 100


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False), min_size=1, max_size=30))
def test_process_number_equals_python_round(spark, values):
    got = column(spark, values, "double", process_number("x"))
    assert got == [max(0, round(v)) for v in values]
    assert all(not math.isnan(g) for g in got)
