"""Increments: a batch rewrites the dates it touches and the marts they feed, and no other date.

Below ``current`` lie the layers by date: staged events, mergeable states of users for each day, and
bitmaps of numbered users for each day and step. A batch is landed, staged and freed of events that are
known from any earlier batch; what is left names the dates. For these dates alone events and states are built anew, in the folder of the run.
User tables and marts come from the states of all days, so old events are never read again, but for the
identifiers that the batch repeats. The checks are the same as those of a whole run.

A run is seen in two steps. After the gate it takes the next number of the commit log, which fails if
another run was faster; from then on its marts are the published ones. Then its dates replace those below
``current`` by partition overwrite. A run that is lost in between is finished by the next one from its
own folder: overwriting the same dates twice gives the same tables.

The first delivery of an event is the one of the earliest batch, within a batch as in ``staging``. So the
tables equal those of a whole refresh over all batches. With an empty batch only the commit is new.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.operators import marts, quality, reach, staging, warehouse
from armlens.plans.refresh import MARTS, together
from armlens.session import pin
from armlens.sources import commits, designs, landing
from armlens.sources.layers import layer_path, overwrite_partitions, read_layer, write_bucketed, write_layer
from armlens.sources.local import local_frame

# Tables below ``current`` and the column they are laid out by.
BY_DATE = {"stg_events": "event_date", "user_days": "event_date", "step_bitmaps": "event_date"}
BY_BATCH = {"raw_events": "_batch", "stg_events_rejects": "_batch", "user_numbers": "_batch"}


def _table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table below ``current``, if a run has written it."""
    folder = layer_path(root, "current")
    if not commits.exists(spark, layer_path(folder, name)):
        return None
    return read_layer(spark, folder, name)


def _with(rest: DataFrame | None, fresh: DataFrame) -> DataFrame:
    return fresh if rest is None else rest.unionByName(fresh)


def publish(spark: SparkSession, root: str, record: dict) -> None:
    """Put the partitions of a committed run in place; the same again if it was done before."""
    def replace(name: str, column: str) -> None:
        overwrite_partitions(read_layer(spark, record["folder"], name), layer_path(root, "current"), name, column)

    # A table without rows has no files to read.
    rows = dict.fromkeys(BY_DATE, len(record["dates"])) | {"step_bitmaps": record["step_rows"]}
    rows |= dict(zip(BY_BATCH, (record["raw_rows"], record["rejects"], record["new_users"])))
    steps = {name: lambda n=name, c=column: replace(n, c)
             for name, column in {**BY_DATE, **BY_BATCH}.items() if rows[name]}
    if steps:
        together(spark, **steps)
    done = f"{layer_path(root, 'placed')}/{record['number']:08d}"
    if not commits.exists(spark, done):
        commits.create_once(spark, done, record["run_id"])


def base(spark: SparkSession, root: str) -> dict | None:
    """The last commit, its partitions put in place first if its run was lost before that."""
    last = commits.latest(spark, root)
    if last and not commits.exists(spark, f"{layer_path(root, 'placed')}/{last['number']:08d}"):
        publish(spark, root, last)
    return last


def apply_batch(rows: DataFrame, root: str, design: DataFrame | None = None, source_file: str | None = None,
                policy: dict[str, tuple[str, int]] = quality.POLICY) -> dict:
    """Add a batch of envelope rows; returns the commit: number, run_id, folder, dates and counts.

    Raises ``GateFailure`` when a check fails and ``commits.Conflict`` when another run came first; in
    both cases nothing that readers see has changed.
    """
    spark = pin(rows.sparkSession)
    last = base(spark, root)
    number = last["number"] + 1 if last else 1
    if last and last["step_rows"] is None:
        raise ValueError(f"{root} was written without step bitmaps; start a new folder")
    run_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}_{uuid.uuid4().hex[:8]}"
    folder = layer_path(root, f"runs/{run_id}")
    design = designs.step_design(spark) if design is None else design

    # One pass over the batch sorts its rows and counts them.
    whole = landing.land(rows, source_file).withColumns({"_verdict": staging.verdict(), "_batch": F.lit(number)})
    watched, counts = quality.observed(whole, quality.raw_conditions(verdict="_verdict"))
    raw = write_layer(watched, folder, "raw_events", parts=("_batch", "_verdict"))
    write_layer(staging.rejects(raw.filter("_verdict = 'refused'").drop("_verdict")), folder, "stg_events_rejects",
                parts=("_batch",))
    seen = counts()

    known = _table(spark, root, "stg_events")
    staged = staging.stage(raw.filter("_verdict = 'valid'").drop("_batch", "_verdict"))
    if known is not None:
        batch = write_layer(staged, folder, "batch_events")
        # Of the events known only identifiers are read, and only those that the batch repeats go on.
        repeated = known.select("event_id").join(batch.select("event_id"), "event_id", "left_semi")
        staged = batch.join(repeated, "event_id", "left_anti").select(*staged.columns)
    fresh = write_layer(staged, folder, "fresh_events", partition_by="event_date")
    dates = [row[0] for row in fresh.select("event_date").distinct().orderBy("event_date").collect()]  # a row a day

    numbered = _table(spark, root, "user_numbers")
    own = write_layer(reach.number_users(warehouse.step_events(fresh), numbered).withColumn("_batch", F.lit(number)),
                      folder, "user_numbers", parts=("_batch",))
    new_users = own.count()
    numbered = _with(numbered.select(*own.columns) if numbered is not None else None, own)

    touched = F.col("event_date").isin(dates) if dates else F.lit(False)
    events = write_layer(_with(known.filter(touched).select(*fresh.columns) if known is not None else None, fresh),
                         folder, "stg_events", partition_by="event_date")
    made = together(
        spark,
        user_days=lambda: write_layer(warehouse.user_states(events, "event_date"), folder, "user_days",
                                      partition_by="event_date"),
        step_bitmaps=lambda: write_layer(
            reach.step_bitmaps(marts.step_states(warehouse.step_events(events), "event_date"), numbered), folder,
            "step_bitmaps", partition_by="event_date"),
        duplicates=lambda: quality.staged_checks(events).collect(),
    )
    values = dict(tuple(row) for row in made["duplicates"])
    before = {"raw_row_count": 0, "staging_rejects": 0}
    if last:
        sums = commits.commits(spark, root).agg(F.sum("raw_rows"), F.sum("rejects")).first()
        before = dict(zip(before, sums))
    values |= {name: n + before[name] for name, n in seen.items()}

    def of_all_days(name: str) -> DataFrame:
        stored, own = _table(spark, root, name), made[name]
        return _with(stored.filter(~touched).select(*own.columns) if stored is not None else None, own)

    tables, found = from_states(of_all_days("user_days"), of_all_days("step_bitmaps"), design, folder)
    values |= found
    write_layer(local_frame(spark, sorted(values.items()), "check_name string, value bigint"), folder, "dq_report", files=1)
    quality.enforce_values(values, {**policy, **quality.UNIQUE_POLICY})

    record = {"run_id": run_id, "folder": folder, "dates": [str(d) for d in dates], "raw_rows": seen["raw_row_count"],
              "rejects": seen["staging_rejects"], "new_users": new_users, "step_rows": made["step_bitmaps"].count(),
              "published_at": datetime.now(timezone.utc).isoformat()}
    commits.commit(spark, root, number, **record)
    publish(spark, root, {"number": number, **record})
    return {"number": number, **record}


def from_states(user_days: DataFrame, step_bitmaps: DataFrame, design: DataFrame,
                folder: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """User tables, dates and marts from the states and bitmaps of days, and the values of their checks."""
    spark = user_days.sparkSession
    values: dict[str, int] = {}

    def write(name: str, table: DataFrame, **layout) -> DataFrame:
        return write_layer(table, folder, name, **layout)

    def watched(name: str, table: DataFrame, conditions: dict) -> DataFrame:
        table, counts = quality.observed(table, conditions)
        made = write_bucketed(table, folder, name, "user_id")
        values.update(counts())
        return made

    def check(report: DataFrame) -> None:
        values.update(tuple(row) for row in report.collect())  # one row per check

    def user_tables() -> dict[str, DataFrame]:
        users = write_bucketed(warehouse.merged_users(user_days), folder, "user_rollup", "user_id")
        made = together(
            spark,
            dim_user=lambda: watched("dim_user", warehouse.dim_user(users), quality.user_conditions()),
            fact_user_funnel=lambda: watched(
                "fact_user_funnel", warehouse.user_funnel(users), quality.funnel_conditions()),
        )
        members, funnel = made["dim_user"], made["fact_user_funnel"]

        def arm_marts() -> None:
            both = marts.metrics_by_group(funnel)
            figures = local_frame(spark, [tuple(row) for row in both.collect()], both.schema)  # a row per arm
            kpi = write("mart_kpi_by_group", figures.select("test_group", *marts.KPI_COLUMNS), files=1)
            write("mart_guardrails_by_group", figures.select("test_group", *marts.GUARDRAIL_COLUMNS), files=1)
            check(quality.mart_checks(kpi))

        together(
            spark, arms=arm_marts,
            daily=lambda: write("mart_daily_funnel", marts.daily_funnel(funnel)),
            checks=lambda: check(
                quality.orphan_check(members, funnel)
                .unionByName(quality.unique_key_check(members, "dim_user", "user_id"))
                .unionByName(quality.unique_key_check(funnel, "fact_user_funnel", "user_id"))),
        )
        return made

    def step_tables() -> None:
        steps = write("dim_step", design, files=1)
        write("mart_step_dropoff", marts.counted_steps(reach.user_counts(step_bitmaps), steps))

    def date_table() -> None:
        dates = write("dim_date", warehouse.dim_date(user_days), files=1)
        check(quality.unique_key_check(dates, "dim_date", "date_key"))

    together(spark, users=user_tables, steps=step_tables, dates=date_table)
    return {name: read_layer(spark, folder, name) for name in MARTS}, values


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as of the last commit: by date or batch from ``current``, any other from its run."""
    last = base(spark, root)
    if last is None:
        raise LookupError(f"nothing committed under {root}")
    return read_layer(spark, layer_path(root, "current") if name in {**BY_DATE, **BY_BATCH} else last["folder"], name)
