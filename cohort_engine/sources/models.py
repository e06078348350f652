"""Trained models and the table of runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cohort_engine.operators.dictionary import DictionaryModel


def model_path(root: str, name: str, version: int | str) -> str:
    return f"{root.rstrip('/')}/{name}/v{version}"


def save_model(model: PipelineModel, root: str, name: str, version: int | str = 1) -> str:
    """Store a model; tables of values that it uses are stored beside it."""
    path = model_path(root, name, version)
    for i, stage in enumerate(model.stages):
        if isinstance(stage, DictionaryModel):
            stage.copy_table(SparkSession.active(), f"{path}-values-{i}")
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str, version: int | str = 1) -> PipelineModel:
    return PipelineModel.load(model_path(root, name, version))


def log_run(
    spark: SparkSession,
    path: str,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    model: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Append one row (run_name, params, metrics, model, logged_at) to the run table."""
    log_runs(spark, path, [(run_name, params, metrics, model)], fmt)


def log_runs(
    spark: SparkSession,
    path: str,
    runs: Sequence[tuple[str, Mapping[str, object], Mapping[str, float], str | None]],
    fmt: str = "parquet",
) -> None:
    """Append a row for each (run_name, params, metrics, model), as one file."""
    rows = [
        (
            name,
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items()},
            model,
        )
        for name, params, metrics, model in runs
    ]
    schema = "run_name string, params map<string,string>, metrics map<string,double>, model string"
    (
        spark.createDataFrame(rows, schema)
        .withColumn("logged_at", F.current_timestamp())
        .coalesce(1)
        .write.save(path, format=fmt, mode="append")
    )
