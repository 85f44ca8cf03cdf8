"""Run log: parameters, metrics and errors of model runs as one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import RUN_LOG_SCHEMA


def log_run(
    spark: SparkSession, path: str, experiment: str, run: str,
    params: dict | None = None, metrics: dict | None = None, error: object = None,
) -> None:
    """Append one run; an error text is kept whole."""
    entries = [("param", k, v) for k, v in (params or {}).items()]
    entries += [("metric", k, v) for k, v in (metrics or {}).items()]
    if error is not None:
        entries.append(("param", "error", str(error)))
    rows = [(experiment, run, kind, k, str(v)) for kind, k, v in entries]
    (
        spark.createDataFrame(rows, RUN_LOG_SCHEMA)
        .withColumn("logged_at", F.current_timestamp())
        .coalesce(1).write.mode("append").parquet(path)
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
