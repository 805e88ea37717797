import pytest
from pyspark.sql import functions as F

from salespanel.operators.cleaning import clean_upload, rejected_rows, stage_upload
from salespanel.plans import jobs

COLUMNS = "row_id string, department string, article string, productProperties string, target string, `Unnamed: 5` string, note string"
GOOD = [
    ("1", "D", "a", '{"k": 1, "size": {"v": 2.5}}', "5", "x", None),
    ("2", "D", "b", '{"k": 2, "only here": "t"}', None, None, None),
    ("3", None, "c", "{}", " 7 ", None, None),
    ("3", None, "c", "{}", " 7 ", None, None),
]
BAD = [
    ("4", "D", "d", '{"k": 1', "1", "y", "n"),
    ("5", "D", "e", "[1]", "1", None, None),
    ("six", "D", "f", None, "1", None, None),
    ("7", "D", "g", '{"bad only": 1}', "5d", None, "note"),
]


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows", [GOOD, GOOD + BAD, BAD, []], ids=["good", "both", "bad", "none"])
def test_same_as_apart(spark, rows):
    raw = spark.createDataFrame(rows, COLUMNS).repartition(3)
    staged = stage_upload(raw, "quarantine")
    n_bad = sum(r in BAD for r in rows)
    assert (staged.n_panel, staged.n_rejected) == (len(rows) - n_bad, n_bad)
    apart = clean_upload(raw, "quarantine")
    assert staged.panel.schema == apart.schema
    assert listed(staged.panel) == listed(apart)
    assert staged.rejected.columns == raw.columns
    assert listed(staged.rejected) == listed(rejected_rows(raw)) == sorted((r for r in rows if r in BAD), key=str)


def test_columns_follow_good_rows(spark):
    panel = stage_upload(spark.createDataFrame(GOOD + BAD, COLUMNS), "quarantine").panel
    assert set(panel.columns) == {
        "row_id", "department", "target", "segment", "prop_k", "prop_size.v", "prop_only here",
    }
    assert dict(panel.dtypes)["row_id"] == "double"  # "six" is in a rejected row


@pytest.mark.parametrize("row, message", [
    (BAD[0], "not a JSON object"), (BAD[2], "not a JSON object: NULL"), (BAD[3], "target is not a number: 5d"),
])
def test_a_bad_row_stops(spark, row, message):
    with pytest.raises(Exception, match=message):
        stage_upload(spark.createDataFrame([*GOOD, row], COLUMNS))


def test_without_target_and_with_rare_keys(spark):
    raw = spark.createDataFrame(GOOD + BAD[:3], COLUMNS).drop("target")
    staged = stage_upload(raw, "quarantine", key_share=0.5)
    assert "target" not in staged.panel.columns
    assert listed(staged.panel.withColumn("prop_rest", F.to_json("prop_rest"))) == listed(
        clean_upload(raw, "quarantine", key_share=0.5).withColumn("prop_rest", F.to_json("prop_rest"))
    )


def test_refused(spark):
    raw = spark.createDataFrame(GOOD, COLUMNS)
    with pytest.raises(ValueError, match="on_bad"):
        stage_upload(raw, "drop")
    with pytest.raises(ValueError, match="missing columns: article"):
        stage_upload(raw.drop("article"))
    with pytest.raises(ValueError, match="reserved"):
        stage_upload(raw.withColumn("_parsed_props", F.lit(1)))


def test_an_upload_is_read_once(spark, tmp_path, monkeypatch):
    """Every row passes a counter once, for panel, rejected rows, counts and keys together."""
    passed = spark.sparkContext.accumulator(0)

    def count(text):
        passed.add(1)
        return text

    counted = F.udf(count, "string").asNondeterministic()
    raw = spark.createDataFrame(GOOD + BAD, COLUMNS).withColumn("row_id", counted("row_id"))
    monkeypatch.setattr(jobs, "read_upload", lambda *_: raw)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    assert jobs.upload_job(spark, "", out, "quarantine", bad) == {"panel": 4, "rejected": 4}
    assert passed.value == len(GOOD + BAD)
    assert spark.read.parquet(out).count() == 4
    assert spark.read.csv(bad, header=True, escape='"').count() == 4
