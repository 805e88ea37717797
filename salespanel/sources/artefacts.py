"""Fitted models on shared storage. Failures raise; nothing is returned as an error."""

from __future__ import annotations

import dataclasses
import json

from pyspark.ml import PipelineModel
from pyspark.ml.base import Model
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def save_model(model: Model, path: str) -> None:
    """Any Spark ML model; a single stage is stored as a one-stage pipeline."""
    if not isinstance(model, PipelineModel):
        model = PipelineModel(stages=[model])
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.read().session(spark).load(path)


def save_specs(spark: SparkSession, specs, weights: dict[str, float], settings: dict, path: str) -> None:
    """Forecaster specs with their weights, one row each, plus run settings."""
    rows = [
        (
            no,
            type(spec).__name__,
            json.dumps(dataclasses.asdict(spec), sort_keys=True),
            float(weights[spec.name]),
            json.dumps(settings, sort_keys=True),
        )
        for no, spec in enumerate(specs)
    ]
    schema = "candidate_no int, kind string, params string, weight double, settings string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def load_specs(spark: SparkSession, path: str):
    """(specs, weights by name, settings) as :func:`save_specs` stored them."""
    from ..operators import specs as kinds

    rows = spark.read.parquet(path).orderBy(F.col("candidate_no")).collect()
    found = [getattr(kinds, r.kind)(**json.loads(r.params)) for r in rows]
    weights = {spec.name: r.weight for spec, r in zip(found, rows)}
    return found, weights, json.loads(rows[0].settings) if rows else {}
