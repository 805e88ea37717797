import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salespanel.operators.cleaning import (
    clean_upload,
    drop_empty_columns,
    fill_unknown,
    rejected_rows,
    require_columns,
)
from salespanel.operators.properties import explode_props, flatten_props, parse_props
from salespanel.operators.quality import invalid_value_counts, target_profile
from salespanel.sources import read_legacy, read_upload, write_panel, write_report

UPLOAD = '''department|article|productProperties|target|timestamp|note|price||empty
D1|A1|"{""Вкус"": ""лимон"", ""size"": {""w h"": 2}}"|5|2024-01-01|NA|1.5||
D1|A2|"{""size"": {""w h"": 3.5}, ""n"": null, ""it's"": ""q""}"|-3|2024-01-01|x|||
|A3|"{""Вкус"": """"}"||2024-01-01|y|2||
'''


@pytest.fixture
def upload(tmp_path):
    def write(text):
        path = tmp_path / "upload.csv"
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def test_upload_is_cleaned(spark, upload):
    got = clean_upload(read_upload(spark, upload(UPLOAD)))
    assert "Unnamed: 7" not in got.columns and "empty" not in got.columns
    rows = {r["price"]: r.asDict() for r in got.collect()}
    first, second, third = rows[1.5], rows[0.0], rows[2.0]
    assert first["segment"] == "D1|A1" and third["segment"] == "unknown"
    assert (first["target"], second["target"], third["target"]) == (5.0, 0.0, 0.0)
    assert first["note"] == "unknown" and second["note"] == "x"
    assert first["prop_Вкус"] == "лимон" and third["prop_Вкус"] == "unknown"
    assert (first["prop_size.w h"], second["prop_size.w h"], third["prop_size.w h"]) == (2.0, 3.5, 0.0)
    assert second["prop_it's"] == "q" and first["prop_n"] == "unknown"
    assert third["department"] == "unknown"


def test_bad_rows_stop_or_go_aside(spark, upload):
    text = UPLOAD + "D2|A4|{broken|5|2024-01-01|z|3||\nD2|A5|{}|5x|2024-01-01|z|3||\nD2|A6|[1]|5|2024-01-01|z|3||\n"
    raw = read_upload(spark, upload(text))
    with pytest.raises(Exception, match="not a JSON object|not a number"):
        clean_upload(raw).collect()
    assert clean_upload(raw, on_bad="quarantine").count() == 3
    assert sorted(r.article for r in rejected_rows(raw).collect()) == ["A4", "A5", "A6"]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="missing columns: b"):
        require_columns(spark.range(1).toDF("a"), ["a", "b"])


def test_fill_depends_on_type(spark):
    df = spark.createDataFrame(
        [("", None, float("nan"), None), ("x", 3, 1.0, True)], "s string, n int, d double, b boolean"
    )
    assert [tuple(r) for r in fill_unknown(df).collect()] == [
        ("unknown", 0, 0.0, "unknown"), ("x", 3, 1.0, "True"),
    ]


def test_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "k int, gone string, `kept one` string")
    assert drop_empty_columns(df).columns == ["k", "kept one"]


def test_properties_with_odd_keys_and_clashing_types(spark):
    rows = [
        (1, '{"a.b": 1, "q\\"x": 2, "c": {"d": [1, 2], "b\\"o\'th": 5}, "mix": 1}'),
        (2, '{"mix": "two", "back`tick": true, "c": {}}'),
    ]
    df = parse_props(spark.createDataFrame(rows, "segment int, props string"), "props")
    got = {r.segment: r.asDict() for r in flatten_props(df, "props").collect()}
    assert got[1]["prop_a.b"] == 1 and got[1]['prop_q"x'] == 2
    assert got[1]["prop_c.b\"o'th"] == 5
    assert got[1]["prop_c.d"] == "[1,2]" and got[2]["prop_c.d"] is None
    assert got[1]["prop_mix"] == "1" and got[2]["prop_mix"] == "two"
    assert got[2]["prop_back`tick"] is True
    keys = {(r.segment, r.key) for r in explode_props(df, "props").collect()}
    assert keys == {(1, "a.b"), (1, 'q"x'), (1, "c"), (1, "mix"), (2, "mix"), (2, "back`tick"), (2, "c")}


def test_declared_schema_needs_no_pass_over_the_data(spark):
    df = parse_props(spark.createDataFrame([(1, '{"k": 1}')], "segment int, props string"), "props")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("z", T.StringType())])
    assert flatten_props(df, "props", schema=schema).first().asDict() == {
        "segment": 1, "prop_k": 1, "prop_z": None,
    }


def test_legacy_dates(spark, tmp_path):
    path = tmp_path / "legacy.csv"
    path.write_text("Date,Department,Article,Sold\n02.01.2024,D,A,3\n2024-01-02,D,,4\n")
    rows = read_legacy(spark, str(path)).select(
        F.date_format("timestamp", "yyyy-MM-dd").alias("day"), "segment", "target"
    ).collect()
    assert [tuple(r) for r in rows] == [("2024-01-02", "D|A", 3.0), ("2024-01-02", None, 4.0)]
    path.write_text("Date,Department,Article,Sold\n32.01.2024,D,A,3\n")
    with pytest.raises(Exception, match="unreadable date"):
        read_legacy(spark, str(path)).collect()
    assert read_legacy(spark, str(path), on_bad="null").first().timestamp is None


def test_profile_and_frequencies(spark):
    df = spark.createDataFrame([("5",), ("x",), ("x",), ("",), (None,), ("1.5",)], "target string")
    row = target_profile(df).first()
    assert (row.total, row.missing, row.empty, row.invalid) == (6, 1, 1, 5)
    assert sorted(row["sample"]) == ["", "1.5", "5", "NULL", "x"]
    assert target_profile(df, na_tokens=("",)).first().empty == 0
    assert [tuple(r) for r in invalid_value_counts(df).collect()] == [("x", 2), ("", 1), ("1.5", 1)]


def test_writers_refuse_to_overwrite_and_quote_text(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c', 1)], "`Артикул` string, `2024-01` int")
    write_report(df, str(tmp_path / "r"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "r"))
    assert [tuple(r) for r in back.collect()] == [('a "b", c', "1")]
    with pytest.raises(Exception, match="already exists"):
        write_panel(df, str(tmp_path / "r"))


def test_rare_keys_go_to_a_map_and_nothing_is_lost(spark):
    import json

    from salespanel.operators.properties import flatten_frequent, frequent_keys, parse_props

    rows = [{"name": f"n{i}", "size": {"unit": "cm", "v": i}, f"only {i}": [i], **({"often": i} if i % 2 else {})} for i in range(400)]
    table = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)] + [(-1, "{}")], "segment long, props string")
    parsed = parse_props(table, "props").union(spark.sql("select -2L, cast(null as variant)"))
    assert frequent_keys(parsed, "props", 0.9) == ["name", "size"]
    assert frequent_keys(parsed, "props", 0.3) == ["name", "often", "size"]
    flat = flatten_frequent(parsed, "props", 0.3)
    assert flat.columns == ["segment", "prop_name", "prop_often", "prop_size.unit", "prop_size.v", "prop_rest"]
    got = {r.segment: r for r in flat.collect()}
    assert len(got) == 402 and got[-1].prop_rest == {} and got[-2].prop_rest is None
    for i in range(400):
        assert got[i].prop_name == f"n{i}" and got[i]["prop_size.v"] == i and got[i].prop_rest == {f"only {i}": f"[{i}]"}
        assert got[i].prop_often == (i if i % 2 else None)
    with pytest.raises(ValueError):
        frequent_keys(parsed, "props", 0)


def test_upload_with_keys_without_number(spark):
    from salespanel.operators.cleaning import clean_upload

    n = 20_000
    raw = spark.range(n).selectExpr(
        "'D' department", "concat('A', id) article", "'1' target",
        "concat('{\"colour\": \"red\", \"key ', id, '\": 1, \"other ', id, '\": 2}') productProperties",
    )
    clean = clean_upload(raw, key_share=0.5)
    assert clean.columns == ["department", "target", "segment", "prop_colour", "prop_rest"]
    sums = clean.selectExpr("sum(size(prop_rest)) rest", "count_if(prop_colour = 'red') red").first()
    assert (sums.rest, sums.red) == (2 * n, n)
