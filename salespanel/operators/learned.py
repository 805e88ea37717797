"""Models that learn one function over all segments from calendar features and attributes.

No lag feature is used, so a forecast needs only the date and the segment, and any
number of steps is predicted directly. Training runs on Spark ML, which sums tree
histograms in the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage
from .attributes import Attributes, attributes_as_of, category_sums, ordered_means, with_means
from .features import add_date_flags, add_holiday, dense_codes, impute_seasonal, log_target, unlog
from .panel import future_grid
from .specs import Boosted

FEATURES = (
    "holiday", "flag_month_number_in_year", "flag_season_number", "flag_year_number",
    "segment_code",
)


def mean_columns(attributes: Attributes | None) -> list[str]:
    """The features that attributes become: the mean target of their categories."""
    return [f"mean_{c}" for c in attributes.columns] if attributes else []


def calendar_features(rows: DataFrame, codes: DataFrame, holidays: DataFrame | None) -> DataFrame:
    rows = add_date_flags(rows)
    if holidays is None:
        rows = rows.withColumn("holiday", F.lit(0))
    else:
        rows = add_holiday(rows, holidays)
    return rows.join(codes, "segment", "left")


def segment_codes(panel: DataFrame) -> DataFrame:
    return dense_codes(panel, "segment", "segment_code")


def estimator(spec):
    common = {"featuresCol": "features", "labelCol": "y"}
    if isinstance(spec, Boosted):
        return GBTRegressor(
            **common, maxIter=spec.max_iter, maxDepth=spec.max_depth, stepSize=spec.step_size,
            maxBins=spec.max_bins, subsamplingRate=spec.subsampling_rate, seed=spec.seed,
        )
    return LinearRegression(
        **common, regParam=spec.reg_param, elasticNetParam=spec.elastic_net
    )


def known_rows(panel: DataFrame, attributes: Attributes | None = None) -> DataFrame:
    """The months with an observed or imputed target ``y``, with the attributes as of them.
    Others say nothing about the target."""
    known = impute_seasonal(log_target(panel, out_col="y"), column="y").filter("y IS NOT NULL")
    return attributes_as_of(known, attributes.changes, attributes.columns) if attributes else known


def training_rows(
    panel: DataFrame, codes: DataFrame, holidays: DataFrame | None = None,
    attributes: Attributes | None = None, known: DataFrame | None = None,
) -> DataFrame:
    """``y`` and the features; ``known`` is what :func:`known_rows` gave, if there already."""
    known = known_rows(panel, attributes) if known is None else known
    rows = calendar_features(known, codes, holidays)
    for c, mean in zip(attributes.columns if attributes else (), mean_columns(attributes)):
        rows = ordered_means(rows, c, mean, weight=attributes.weight)
    return rows.select("y", *FEATURES, *mean_columns(attributes))


def attribute_sums(panel: DataFrame, attributes: Attributes | None) -> DataFrame | None:
    """What forecasts after the panel need of its targets, per attribute and category."""
    return category_sums(known_rows(panel, attributes), attributes.columns) if attributes else None


def with_attributes(rows: DataFrame, attributes: Attributes | None, sums: DataFrame | None) -> DataFrame:
    """``rows`` later than those of ``sums``, with the attributes as of them and their means."""
    if not attributes:
        return rows
    rows = attributes_as_of(rows, attributes.changes, attributes.columns)
    for c, mean in zip(attributes.columns, mean_columns(attributes)):
        rows = with_means(rows, sums, c, mean, attributes.weight)
    return rows


def fit_rows(rows: DataFrame, spec) -> PipelineModel:
    inputs = [c for c in rows.columns if c != "y"]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    return Pipeline(stages=[assembler, estimator(spec)]).fit(rows)


def predict_rows(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``features`` rows with ``yhat`` on the original scale, without the features."""
    scored = model.transform(features).withColumn("yhat", unlog("prediction"))
    return scored.drop(*FEATURES, "features", "prediction")


def fit(
    panel: DataFrame, spec, codes: DataFrame | None = None, holidays: DataFrame | None = None,
    attributes: Attributes | None = None,
) -> PipelineModel:
    """Fit one spec on the whole panel."""
    codes = segment_codes(panel) if codes is None else codes
    return fit_rows(training_rows(panel, codes, holidays, attributes), spec)


def predict(
    model: PipelineModel, rows: DataFrame, codes: DataFrame, holidays: DataFrame | None = None,
    attributes: Attributes | None = None, sums: DataFrame | None = None,
) -> DataFrame:
    """``rows`` with ``yhat`` on the original scale, NULL for a segment that has no code.
    ``sums`` are the :func:`attribute_sums` of the panel the model was fitted on."""
    features = with_attributes(calendar_features(rows, codes, holidays), attributes, sums)
    known = predict_rows(model, features.filter("segment_code IS NOT NULL")).select(*rows.columns, "yhat")
    unseen = features.filter("segment_code IS NULL")
    return known.unionByName(unseen.select(*rows.columns, F.lit(None).cast("double").alias("yhat")))


def fold_tables(
    panel: DataFrame, codes: DataFrame, horizon: int, end, holidays: DataFrame | None = None,
    attributes: Attributes | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of one fold with their features, stored once for however
    many models are fitted on them. Attributes are those known when the training ends."""
    _, train_end, train_start = end
    train = panel.filter((F.col("from_end") >= train_end) & (F.col("t_idx") >= train_start))
    test = panel.filter(
        (F.col("from_end") < train_end) & (F.col("from_end") >= train_end - horizon)
    ).select(
        "segment", "timestamp", F.col("target").alias("actual"),
        (F.lit(train_end) - F.col("from_end")).alias("h"),
    )
    known = sums = None
    if attributes:
        attributes = attributes.until(train.agg(F.max("timestamp")).first()[0])
        known = cut_lineage(known_rows(train, attributes), "known")
        sums = cut_lineage(category_sums(known, attributes.columns), "attribute-sums")
    return (
        cut_lineage(training_rows(train, codes, holidays, attributes, known), "train"),
        cut_lineage(with_attributes(calendar_features(test, codes, holidays), attributes, sums), "test"),
    )


def fold_forecast(train: DataFrame, test: DataFrame, spec, number: int, fold: int) -> DataFrame:
    return predict_rows(fit_rows(train, spec), test).select(
        F.lit(spec.name).alias("model"), F.lit(number).alias("candidate_no"),
        F.lit(fold).alias("fold"), "segment", "h", "timestamp", "actual", "yhat",
    )


def learned_forecast(
    panel: DataFrame, models: dict[str, PipelineModel], numbers: dict[str, int], horizon: int,
    holidays: DataFrame | None = None, codes: DataFrame | None = None,
    attributes: Attributes | None = None, sums: DataFrame | None = None,
) -> DataFrame:
    """Forecasts of fitted models for the months after the panel, in the column layout of
    :func:`linear_forecast`. ``codes`` are those the models were fitted with; without them
    the panel must be the one they were fitted on."""
    codes, rows = segment_codes(panel) if codes is None else codes, future_grid(panel, horizon)
    sums = attribute_sums(panel, attributes) if sums is None else sums
    parts = [
        predict(model, rows, codes, holidays, attributes, sums).select(
            F.lit(name).alias("model"), F.lit(numbers[name]).alias("candidate_no"),
            F.lit(0).alias("fold"), "segment", "h", "timestamp",
            F.lit(None).cast("double").alias("actual"), "yhat",
        )
        for name, model in models.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def learned_backtest(
    panel: DataFrame, specs: Sequence, numbers: Sequence[int], horizon: int, ends,
    holidays: DataFrame | None = None, attributes: Attributes | None = None,
) -> DataFrame:
    """Fit each spec once per fold (an action per fit) and forecast its test months."""
    codes, out = cut_lineage(segment_codes(panel), "segment-codes"), None
    for end in ends:
        train, test = fold_tables(panel, codes, horizon, end, holidays, attributes)
        for spec, number in zip(specs, numbers):
            part = fold_forecast(train, test, spec, number, end[0])
            out = part if out is None else out.unionByName(part)
    return out
