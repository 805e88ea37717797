import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salespanel.operators import learned
from salespanel.operators.attributes import (
    Attributes,
    attributes_as_of,
    category_sums,
    merged_sums,
    ordered_means,
    with_means,
)
from salespanel.operators.forecasting import backtest, forecast
from salespanel.operators.panel import regularise
from salespanel.operators.specs import Boosted
from salespanel.plans import forecast_job, refresh_job


def day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def history():
    draw = random.Random(4)
    keys = ["hot"] * 20 + ["a", "b", None]
    changes = [
        (draw.choice(keys), day(draw.randrange(200)) if draw.random() > 0.03 else None,
         draw.choice([None, "x", "y", "z"]), draw.choice([None, 1, 2]))
        for _ in range(600)
    ]
    rows = [(i, draw.choice(keys + ["new"]), day(draw.randrange(-20, 230)) if draw.random() > 0.05 else None, "old") for i in range(400)]
    return rows + [rows[0]], changes


def test_values_as_of_equal_a_plain_search(spark, history):
    rows, changes = history
    table = spark.createDataFrame(changes, "segment string, timestamp timestamp_ntz, colour string, `a.b` int")
    asked = spark.createDataFrame(rows, "id int, segment string, timestamp timestamp_ntz, colour string")
    found = attributes_as_of(asked, table, ["colour", "a.b"])
    assert found.columns == ["id", "segment", "timestamp", "colour", "a.b"]

    def known(segment, at, i):
        seen = [(c[1], c[i]) for c in changes if c[0] == segment and c[1] and c[i] is not None and at and c[1] <= at]
        return max(seen)[1] if seen and segment else None

    want = sorted([(i, s, t, known(s, t, 2), known(s, t, 3)) for i, s, t, _ in rows], key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_no_row_sees_its_own_or_a_later_target(spark):
    draw = random.Random(5)
    rows = [(i, draw.choice(["x", "y", None]), day(30 * draw.randrange(6)), float(draw.randrange(50))) for i in range(300)]
    make = lambda r: {
        x.id: x.m for x in ordered_means(
            spark.createDataFrame(r, "id int, kind string, timestamp timestamp_ntz, y double"), "kind", "m"
        ).collect()
    }
    before = make(rows)
    cut = day(90)
    after = make([(i, k, t, 1e6 if t >= cut else y) for i, k, t, y in rows])
    assert all(before[i] == after[i] for i, _, t, _ in rows if t <= cut)
    assert any(before[i] != after[i] for i, _, t, _ in rows if t > cut)
    for i, k, t, _ in rows:
        own = [y for _, kk, tt, y in rows if kk == k and tt < t]
        every = [y for _, _, tt, y in rows if tt < t]
        prior = sum(every) / len(every) if every else 0.0
        assert before[i] == pytest.approx((sum(own) + 10 * prior) / (len(own) + 10))


def test_sums_of_parts_give_what_a_later_row_would_see(spark):
    draw = random.Random(6)
    rows = [(draw.choice(["x", "y", None, "z"]), day(draw.randrange(90)), float(draw.randrange(50))) for _ in range(200)]
    schema = "kind string, timestamp timestamp_ntz, y double"
    past = spark.createDataFrame(rows, schema)
    later = spark.createDataFrame([("x", day(100), 1.0), (None, day(100), 1.0), ("unseen", day(100), 1.0)], schema)
    early = past.filter(F.col("timestamp") < day(40))
    sums = merged_sums(category_sums(early, ["kind"]), category_sums(past.filter(F.col("timestamp") >= day(40)), ["kind"]))
    got = {r.kind: r.m for r in with_means(later, sums, "kind", "m").collect()}
    want = {r.kind: r.m for r in ordered_means(past.union(later), "kind", "m").filter(F.col("timestamp") == day(100)).collect()}
    assert got == pytest.approx(want)
    nothing = category_sums(past.limit(0), ["kind"])
    assert {r.m for r in with_means(later, nothing, "kind", "m").collect()} == {0.0}


@pytest.fixture(scope="module")
def coloured(spark):
    """Twelve segments whose sales depend on their colour only; codes say nothing."""
    rows = [
        (f"K|s{i:02d}", day(0) if m == 0 else dt.datetime(2020 + m // 12, m % 12 + 1, 1), 900.0 if i * 7 % 12 < 6 else 10.0, "red" if i * 7 % 12 < 6 else "blue")
        for i in range(12) for m in range(18)
    ]
    return spark.createDataFrame(rows, "segment string, timestamp timestamp_ntz, target double, colour string").persist()


def test_learned_models_use_attributes(spark, coloured):
    panel = regularise(coloured.select("segment", "timestamp", "target"))
    spec = Boosted(max_iter=1, max_depth=1, name="stump")
    known = Attributes(coloured.select("segment", "timestamp", "colour"), ("colour",))
    def error(attributes):
        bt = backtest(panel, [spec], 3, 1, attributes=attributes)
        return bt.agg(F.avg(F.abs(F.log10(F.col("actual") + 1) - F.log10(F.col("yhat") + 1)))).first()[0]
    assert error(known) < 0.2 < error(None) / 2
    ahead = forecast(panel, [spec], 2, attributes=known)
    assert ahead.count() == 24 and ahead.filter("yhat > 100").count() == 12


def test_folds_do_not_see_later_attributes(spark, coloured):
    panel = regularise(coloured.select("segment", "timestamp", "target")).persist()
    last = panel.agg(F.max("timestamp")).first()[0]
    changes = coloured.select("segment", "timestamp", "colour")
    lies = changes.filter(F.col("timestamp") >= F.lit(last)).withColumn("colour", F.lit("green"))
    codes = learned.segment_codes(panel)
    end = (0, 3, 0)
    tables = [
        learned.fold_tables(panel, codes, 3, end, None, Attributes(c, ("colour",))) for c in (changes, changes.union(lies))
    ]
    for one, other in zip(*tables):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_jobs_store_attributes_metadata_and_summaries(spark, coloured, tmp_path):
    rows = coloured.withColumns({"kind": F.lit("K"), "name": F.concat(F.lit("n"), F.col("segment"))})
    rows.write.parquet(f"{tmp_path}/rows")
    specs = [Boosted(max_iter=2, max_depth=2, name="small")]
    refresh_job(
        spark, f"{tmp_path}/rows", f"{tmp_path}/run", 2, specs, n_folds=1, attributes=("colour",), metadata=("kind", "name")
    )
    summary = spark.read.parquet(f"{tmp_path}/run/summary")
    assert {(r.department, r.article) for r in summary.collect()} == {("K", f"nK|s{i:02d}") for i in range(12)}
    sums = spark.read.parquet(f"{tmp_path}/run/model/attribute_sums").collect()
    assert {(r.attribute, r.value, r.n) for r in sums} == {("colour", "red", 108), ("colour", "blue", 108)}
    first = spark.read.parquet(f"{tmp_path}/run/quantile_totals").first()
    again = forecast_job(spark, f"{tmp_path}/run/model", f"{tmp_path}/rows", f"{tmp_path}/again")
    assert again.count() == 24 and first["sum_target_0.025"] >= 0
    assert spark.read.parquet(f"{tmp_path}/again/summary").agg(F.sum("target")).first()[0] == pytest.approx(summary.agg(F.sum("target")).first()[0])
