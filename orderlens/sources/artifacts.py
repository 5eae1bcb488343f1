"""Small artifacts beside a model: thresholds, best settings, importances and the run log."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, run_name string, logged_at timestamp_ntz, kind string, name string, value string"


def _write_numbers(spark: SparkSession, values: Mapping[str, float], path: str) -> None:
    if not values:
        raise ValueError("nothing to write")
    row = tuple(float(v) for v in values.values())
    schema = ", ".join(f"`{k}` double" for k in values)
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(path)


def _read_numbers(spark: SparkSession, path: str) -> dict[str, float]:
    # One JSON object; its keys are only known from the file itself.
    row = spark.read.json(path).first()
    return {k: float(v) for k, v in row.asDict().items() if v is not None}


def write_thresholds(spark: SparkSession, thresholds: Mapping[str, float], path: str) -> None:
    """Column name to cap, as one JSON object."""
    _write_numbers(spark, thresholds, path)


def read_thresholds(spark: SparkSession, path: str) -> dict[str, float]:
    return _read_numbers(spark, path)


def write_settings(spark: SparkSession, settings: Mapping[str, float], path: str) -> None:
    """The best tuning settings, as one JSON object."""
    _write_numbers(spark, settings, path)


def read_settings(spark: SparkSession, path: str) -> dict[str, float]:
    return _read_numbers(spark, path)


def write_importances(importances: DataFrame, path: str) -> None:
    """(feature, importance), largest first; one row per feature, so one file."""
    importances.orderBy(F.desc("importance"), "feature").coalesce(1).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def append_run(
    spark: SparkSession, path: str, run_name: str, params: Mapping[str, object], metrics: Mapping[str, float]
) -> DataFrame:
    """Append one run's parameters and metrics to the run table and return the table."""
    run_id = uuid.uuid4().hex
    rows = [(run_id, run_name, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, run_name, "metric", k, str(v)) for k, v in metrics.items()]
    if rows:
        frame = spark.createDataFrame(rows, "run_id string, run_name string, kind string, name string, value string")
        frame.select(
            "run_id", "run_name", F.localtimestamp().alias("logged_at"), "kind", "name", "value"
        ).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(RUN_SCHEMA).parquet(path)
