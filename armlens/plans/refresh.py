"""A full refresh: raw rows to published marts, policed on the way and recorded at the end.

Every layer is written under the folder of its run, so a lost executor only repeats the tasks of
one step and an unfinished run is never seen: readers follow the ``published`` log, which gets its
row after the gate has passed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.operators import inference, marts, monitoring, quality, staging, warehouse
from armlens.session import drop_path, pin
from armlens.sources import csv_records, designs, documents, landing, run_log
from armlens.sources.events_csv import read_events_csv
from armlens.sources.layers import layer_path, read_layer, write_bucketed, write_layer
from armlens.sources.local import local_frame

MARTS = (
    "mart_kpi_by_group", "mart_guardrails_by_group", "mart_step_dropoff", "mart_daily_funnel",
)
PUBLISHED_SCHEMA = "run_id string, published_at string, folder string"


def together(spark: SparkSession, **steps: Callable[[], Any]) -> dict[str, Any]:
    """Run independent steps at the same time; Spark fills idle cores of one with tasks of another."""
    with ThreadPoolExecutor(len(steps)) as pool:
        started = {
            name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()
        }
        return {name: future.result() for name, future in started.items()}


def build(rows: DataFrame, folder: str, design: DataFrame | None = None,
          source_file: str | None = None, landed: bool = False, strict_null: bool = False,
          policy: dict[str, tuple[str, int]] = quality.POLICY) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write all layers of one run under ``folder``; returns the tables and the check values.

    ``landed`` tells that ``rows`` are a stored raw layer already, which is then read in place.
    Raises ``GateFailure`` when a check fails; what was written is then never published.
    """
    spark = rows.sparkSession
    design = designs.step_design(spark) if design is None else design

    def write(name: str, table: DataFrame, **layout) -> DataFrame:
        return write_layer(table, folder, name, **layout)

    values: list[tuple[str, int]] = []

    def check(report: DataFrame) -> None:
        values.extend(tuple(row) for row in report.collect())  # one row per check

    def bucketed(name: str, table: DataFrame) -> DataFrame:
        return write_bucketed(table, folder, name, "user_id")

    def watched(name: str, table: DataFrame, conditions: dict, kept=None, put=write, **layout) -> DataFrame:
        """Write a table and take the counts of the checks from the same job."""
        table, counts = quality.observed(table, conditions)
        made = put(name, kept(table) if kept else table, **layout)
        values.extend(counts().items())
        return made

    if landed:
        # Read in place: once for staging, once for the quarantine, whose job counts all rows.
        raw, sorted_rows = rows, rows
        quarantine = lambda: watched(
            "stg_events_rejects", raw, quality.raw_conditions(strict_null), lambda seen: staging.rejects(seen, strict_null))
    else:
        # One pass over the source sorts the rows by verdict; each later step reads its own part.
        whole = landing.land(rows, source_file).withColumn("_verdict", staging.verdict(strict_null))
        sorted_rows = watched("raw_events", whole, quality.raw_conditions(verdict="_verdict"), parts=("_verdict",))
        raw = sorted_rows.drop("_verdict")
        refused = sorted_rows.filter(F.col("_verdict") == "refused").drop("_verdict")
        quarantine = lambda: write("stg_events_rejects", staging.rejects(refused, strict_null))
        sorted_rows = sorted_rows.filter(F.col("_verdict") == "valid").drop("_verdict")
    tables = {"raw_events": raw} | together(
        spark,
        stg_events=lambda: write("stg_events", staging.stage(sorted_rows, strict_null), partition_by="event_date"),
        stg_events_rejects=quarantine,
    )
    events = tables["stg_events"]

    def user_tables() -> dict[str, DataFrame]:
        # Laid out by user once; nothing after this shuffles by user again.
        users = bucketed("user_rollup", warehouse.user_rollup(events))
        made = together(
            spark,
            dim_user=lambda: watched("dim_user", warehouse.dim_user(users), quality.user_conditions(), put=bucketed),
            fact_user_funnel=lambda: watched(
                "fact_user_funnel", warehouse.user_funnel(users), quality.funnel_conditions(), put=bucketed),
        )
        members, funnel = made["dim_user"], made["fact_user_funnel"]

        def arm_marts() -> dict[str, DataFrame]:
            # One pass over the funnel; both marts are columns of its one row per arm.
            by_arm = marts.metrics_by_group(funnel)
            figures = local_frame(spark, [tuple(row) for row in by_arm.collect()], by_arm.schema)
            kpi = figures.select("test_group", *marts.KPI_COLUMNS)
            made = together(
                spark,
                mart_kpi_by_group=lambda: write("mart_kpi_by_group", kpi, files=1),
                mart_guardrails_by_group=lambda: write(
                    "mart_guardrails_by_group", figures.select("test_group", *marts.GUARDRAIL_COLUMNS), files=1),
            )
            check(quality.mart_checks(made["mart_kpi_by_group"]))
            return made

        built = together(
            spark,
            arms=arm_marts,
            mart_daily_funnel=lambda: write("mart_daily_funnel", marts.daily_funnel(funnel)),
            checks=lambda: check(
                quality.orphan_check(members, funnel)
                .unionByName(quality.unique_key_check(members, "dim_user", "user_id"))
                .unionByName(quality.unique_key_check(funnel, "fact_user_funnel", "user_id"))
            ),
        )
        return made | built["arms"] | {"mart_daily_funnel": built["mart_daily_funnel"]}

    def step_tables() -> dict[str, DataFrame]:
        facts = write("fact_onboarding_step_events", warehouse.step_events(events))
        steps = write("dim_step", design, files=1)
        return {
            "fact_onboarding_step_events": facts, "dim_step": steps,
            "mart_step_dropoff": write("mart_step_dropoff", marts.step_dropoff(facts, steps)),
        }

    def date_table() -> dict[str, DataFrame]:
        dates = write("dim_date", warehouse.dim_date(events), files=1)
        check(quality.unique_key_check(dates, "dim_date", "date_key"))
        return {"dim_date": dates}

    branches = together(
        spark, users=user_tables, steps=step_tables, dates=date_table,
        checks=lambda: check(quality.staged_checks(events)),
    )
    tables |= branches["users"] | branches["steps"] | branches["dates"]

    report = local_frame(spark, sorted(values), "check_name string, value bigint")
    tables["dq_report"] = write("dq_report", report, files=1)
    quality.enforce_values(dict(values), {**policy, **quality.UNIQUE_POLICY})
    return tables, dict(values)


def _hopeless(failure: Exception) -> bool:
    """Wrong inputs or design: the same run would fail again, whoever repeats it."""
    if isinstance(failure, (designs.DesignError, csv_records.OpenQuote, AnalysisException)):
        return True
    return isinstance(failure, PySparkException) and failure.getCondition() == "USER_RAISED_EXCEPTION"


def refresh_files(spark: SparkSession, events: str, root: str, step_map: str | None = None,
                  multi_line: bool = False, **options) -> dict[str, DataFrame]:
    """A refresh from event CSV files and, if given, a step map file; ``multi_line`` as in the reader."""
    def design() -> DataFrame:
        return designs.read_dim_step(spark, step_map) if step_map else designs.step_design(spark)

    return refresh(lambda: (read_events_csv(spark, events, multi_line), design()), root, spark=spark, **options)


def prune_runs(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete the folders of failed and superseded runs; returns their run ids.

    The ``keep`` runs published last stay, for readers that are still at it. The logs keep every run.
    """
    history = run_log.read_runs(spark, layer_path(root, "run_history")).select("run_id")
    log = spark.read.schema(PUBLISHED_SCHEMA).json(layer_path(root, "published")).orderBy(
        F.col("published_at").desc(), F.col("run_id").desc()).limit(keep).select("run_id")
    gone = [row["run_id"] for row in history.join(log, "run_id", "left_anti").toLocalIterator()]
    return sorted(run for run in gone if drop_path(spark, layer_path(root, f"runs/{run}")))


def refresh(source: DataFrame | Callable[[], tuple[DataFrame, DataFrame]], root: str,
            spark: SparkSession | None = None, design: DataFrame | None = None,
            retries_used: int = 0, **options) -> dict[str, DataFrame]:
    """Build, gate, publish and record one run; a failed run is recorded and raised again.

    ``source`` is the envelope rows, or a function opening rows and step design, so that files
    which cannot be opened are a recorded failure too.
    """
    spark = pin(spark or source.sparkSession)
    started = datetime.now(timezone.utc)
    run_id = f"{started:%Y%m%dT%H%M%SZ}_{uuid.uuid4().hex[:8]}"
    folder = layer_path(root, f"runs/{run_id}")

    def record(status: str, summary=None, error: Exception | None = None) -> None:
        run_log.append_run(monitoring.run_record(
            spark, run_id, started, datetime.now(timezone.utc), status, retries_used, summary,
            str(error) if error else None,
        ), layer_path(root, "run_history"))

    try:
        rows, design = source() if callable(source) else (source, design)
        tables, summary = build(rows, folder, design, **options)
    except quality.GateFailure as failure:
        record("failed_validation", error=failure)
        raise
    except Exception as failure:
        record("failed_fatal" if _hopeless(failure) else "failed_unclassified", error=failure)
        raise
    published = [(run_id, datetime.now(timezone.utc).isoformat(), folder)]
    local_frame(spark, published, PUBLISHED_SCHEMA).write.mode("append").json(
        layer_path(root, "published")
    )
    record("success", summary)
    return tables


def latest_folder(spark: SparkSession, root: str) -> str:
    """The folder of the run published last."""
    log = spark.read.schema(PUBLISHED_SCHEMA).json(layer_path(root, "published"))
    latest = log.orderBy(F.col("published_at").desc(), F.col("run_id").desc()).first()
    if latest is None:
        raise LookupError(f"nothing published under {root}")
    return latest["folder"]


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the run published last."""
    return read_layer(spark, latest_folder(spark, root), name)


def evaluate(spark: SparkSession, root: str, out: str | None = None) -> DataFrame:
    """Statistics over the marts of the run published last, with the dashboard bundle in ``out``."""
    folder = latest_folder(spark, root)
    frames = {name.removeprefix("mart_"): read_layer(spark, folder, name) for name in MARTS}
    stats = inference.results_document(frames["kpi_by_group"], frames["guardrails_by_group"])
    if out is not None:
        documents.write_document(stats, layer_path(out, "results"))
        documents.export_bundle(frames, stats, layer_path(out, "dashboard"))
    return stats
