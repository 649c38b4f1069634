"""Run records and the health of recent runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.domain import RUN_SCHEMA, RUN_STATUSES
from armlens.sources.local import local_frame

# Below this success rate, with at least this many runs looked at, alarm.
HEALTHY_PCT = 70
MIN_RUNS = 5


def run_record(spark: SparkSession, run_id: str, started: datetime, finished: datetime, status: str,
               retries_used: int = 0, summary: dict[str, int] | None = None,
               error: str | None = None) -> DataFrame:
    """One run as a one-row frame."""
    if status not in RUN_STATUSES:
        raise ValueError(f"unknown run status {status!r}")
    row = (
        run_id, started.isoformat(), finished.isoformat(),
        round((finished - started).total_seconds(), 2), status, retries_used, summary, error,
    )
    return local_frame(spark, [row], RUN_SCHEMA)


def recent_runs(runs: DataFrame, last: int = 10) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(last)


def run_health(runs: DataFrame, last: int = 10) -> DataFrame:
    """Success rate and duration over the last runs, the latest outcome, and whether to alarm."""
    succeeded = F.col("status") == "success"
    order = F.struct("started_at", "run_id")
    latest = F.max_by(F.struct("run_id", "status", "error"), order)
    looked_at = recent_runs(runs, last).agg(
        F.count(F.lit(1)).alias("recent_runs"),
        F.count(F.when(succeeded, 1)).alias("successes"),
        F.avg(F.when(succeeded, F.col("duration_seconds"))).alias("mean_duration"),
        latest.alias("latest"),
    ).filter(F.col("recent_runs") > 0)
    rate = F.col("successes") * 100.0 / F.col("recent_runs")
    failed_last = F.col("latest.status") != "success"
    low = (rate < HEALTHY_PCT) & (F.col("recent_runs") >= MIN_RUNS)
    return looked_at.select(
        "recent_runs",
        F.round(rate, 2).alias("success_rate_pct"),
        F.round(F.coalesce("mean_duration", F.lit(0.0)), 2).alias("avg_success_duration"),
        F.col("latest.run_id").alias("latest_run_id"),
        F.col("latest.status").alias("latest_status"),
        F.col("latest.error").alias("latest_error"),
        (failed_last | low).cast("int").alias("unhealthy"),
    )
