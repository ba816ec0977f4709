"""Run log and stored models."""

from __future__ import annotations

from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def log_metric(result: DataFrame, path: str, experiment: str, run_id: str, metric: str,
               column: str | None = None) -> None:
    """Append a one-row metric result to the run log; the value never visits the driver."""
    row = result.select(F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"),
                        F.current_timestamp().alias("start_time"), F.lit(metric).alias("metric"),
                        F.col(column or metric).cast("double").alias("value"))
    row.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def latest_runs(runs: DataFrame) -> DataFrame:
    """(experiment, run_id): the most recently started run of each experiment, ties by id."""
    return runs.groupBy("experiment").agg(
        F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id"))


def save_model(model: Any, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind: type = PipelineModel) -> Any:
    return kind.load(path)
