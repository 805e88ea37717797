import pytest
from pyspark.sql import functions as F

from salespanel.operators.forecasting import backtest, forecast
from salespanel.operators.incremental import cast_ahead, cast_backtest, cast_origins
from salespanel.operators.panel import regularise
from salespanel.operators.recurrence import folds
from salespanel.operators.specs import CLASSICAL, Linear, Naive, SeasonalMA
from salespanel.plans import refresh_job
from salespanel.sources import read_forecast

H = 2
BASE = {
    "a": {m: float(m * m % 17) for m in range(20)},
    "b": {m: float(m % 5 + 1) for m in range(3, 20, 2)},
    "c": {m: 7.0 - m % 3 for m in range(12, 20)},
    "gap": {0: 4.0, 1: 5.0},
}


def with_rows(extra):
    return {k: {**BASE.get(k, {}), **extra.get(k, {})} for k in (*BASE, *(k for k in extra if k not in BASE))}


CASES = {
    "nothing": BASE,
    "a month": with_rows({"a": {20: 3.0}}),
    "a fold": with_rows({"a": {20: 3.0, 21: 2.0}, "c": {21: 9.0}}),
    "late row": with_rows({"b": {4: 30.0}}),
    "late and new months": with_rows({"b": {17: 1.0, 18: 2.5}, "a": {21: 8.0}}),
    "new segment": with_rows({"d": {m: 2.0 * m for m in range(5, 20)}}),
    "gone segment": {k: v for k, v in BASE.items() if k != "a"},
    "value taken back": {**BASE, "b": {m: v for m, v in BASE["b"].items() if m != 15}},
    "earlier start": with_rows({"e": {-4: 1.0, 19: 2.0}}),
    "shorter": {k: {m: v for m, v in s.items() if m < 18} for k, s in BASE.items()},
}


@pytest.fixture
def panel_of(sales, spark, tmp_path):
    def make(series, name):
        shifted = {k: {m + 12: v for m, v in s.items()} for k, s in series.items()}
        regularise(sales(shifted)).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return make


@pytest.fixture(scope="module")
def base_folder(tmp_path_factory):
    return tmp_path_factory.mktemp("base")


@pytest.fixture
def first(panel_of, base_folder):
    """The folder of a run over BASE, made once."""
    folder = base_folder / "run"
    if not folder.exists():
        check(panel_of(BASE, "base"), CLASSICAL, H, str(folder), None)
    return str(folder)


def rows(df):
    return sorted(
        ((*r[:6], None if r.actual is None else round(r.actual, 9), None if r.yhat is None else round(r.yhat, 9))
         for r in df.collect()), key=str,
    )


def check(panel, specs, horizon, folder, since, n=3):
    ends = folds(n, horizon)
    casts = cast_origins(panel, specs, horizon, [*ends, (n, 0, 0)], folder, since)
    assert rows(cast_backtest(casts, panel, specs, ends)) == rows(backtest(panel, specs, horizon, n))
    assert rows(cast_ahead(casts, panel, specs)) == rows(forecast(panel, specs, horizon))
    assert casts.groupBy("window", "season", "segment", "origin", "h").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("case", CASES)
def test_recast_equals_cast(panel_of, tmp_path, first, case):
    check(panel_of(CASES[case], "p"), CLASSICAL, H, str(tmp_path / "second"), first)


def test_only_what_changed_is_cast(spark, panel_of, tmp_path, first):
    second = str(tmp_path / "second")
    changed = with_rows({"b": {16: 50.0}, "a": {21: 1.0}})  # a fold further, and a late row
    check(panel_of(changed, "p"), CLASSICAL, H, second, first)
    digests = spark.read.parquet(f"{second}/digests").filter("recast").collect()
    start = 2020 * 12 + 12  # month 0 of the cases
    assert {(r.segment, r.origin - start) for r in digests} == {
        ("b", 17), ("b", 19), *((s, 21) for s in BASE)
    }


@pytest.mark.parametrize("specs, horizon", [
    ((*CLASSICAL, SeasonalMA(3, 2)), H), (CLASSICAL[:2], H), (CLASSICAL, 1), (CLASSICAL, 3),
    ((Naive(3, name="other"), SeasonalMA(1, 3)), H),
])
def test_other_specs_or_steps(panel_of, tmp_path, first, specs, horizon):
    check(panel_of(BASE, "p"), specs, horizon, str(tmp_path / "second"), first)


def test_a_chain_of_runs(panel_of, tmp_path):
    since = None
    for n in range(4):
        series = with_rows({"a": {20 + i: float(i) for i in range(n)}, "c": {13 + n: 40.0 + n}})
        folder = str(tmp_path / f"run{n}")
        check(panel_of(series, f"p{n}"), CLASSICAL, 1, folder, since)
        since = folder


def test_refresh_from_an_earlier_run(spark, sales, tmp_path):
    """With a learned candidate, which is fitted anew."""
    specs = (*CLASSICAL[:3], Linear(reg_param=0.1), CLASSICAL[6])
    lines, more = str(tmp_path / "lines"), {"a": {20: 3.0, 21: 4.0}, "b": {5: 9.0}}
    sales(BASE).write.parquet(lines)
    refresh_job(spark, lines, str(tmp_path / "first"), H, specs, keep_casts=True)
    sales(more).write.mode("append").parquet(lines)
    since = refresh_job(spark, lines, str(tmp_path / "second"), H, specs, since=str(tmp_path / "first"))
    whole = refresh_job(spark, lines, str(tmp_path / "whole"), H, specs)
    assert since == pytest.approx(whole)
    both = [
        read_forecast(spark, str(tmp_path / n / "forecast")).orderBy("segment", "timestamp").select(
            "segment", "timestamp", *[F.round(c, 6).alias(c) for c in ("target", "target_lower", "target_upper")]
        ).collect()
        for n in ("second", "whole")
    ]
    assert both[0] == both[1]
    with pytest.raises(ValueError, match="overwrite"):
        refresh_job(spark, lines, str(tmp_path / "second"), H, specs, since=str(tmp_path / "second/"))
