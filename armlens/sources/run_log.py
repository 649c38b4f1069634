"""Run history: one JSON object per line, only ever appended to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from armlens.domain import RUN_SCHEMA


def append_run(record: DataFrame, path: str) -> None:
    """Add one or more run records; each call adds files and touches none that exist."""
    record.select(*RUN_SCHEMA.names).write.mode("append").json(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).json(path)
