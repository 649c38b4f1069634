"""Experiment metadata kept as JSON: step map and event catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.domain import ARM_STEPS, CATALOG_SCHEMA, DIM_STEP_SCHEMA, STEP_BUCKETS, STEPMAP_SCHEMA
from armlens.sources.local import local_frame


class DesignError(ValueError):
    """The design files contradict each other; running again cannot help."""


def step_design(spark: SparkSession, arm_steps=ARM_STEPS, buckets=STEP_BUCKETS) -> DataFrame:
    """dim_step from a design held in Python; one row per arm and position."""
    missing = sorted({s for steps in arm_steps.values() for s in steps} - set(buckets))
    if missing:
        raise DesignError(f"steps without a bucket: {', '.join(missing)}")
    rows = [
        (arm, position, step, buckets[step])
        for arm, steps in arm_steps.items()
        for position, step in enumerate(steps, start=1)
    ]
    return local_frame(spark, rows, DIM_STEP_SCHEMA)


def read_dim_step(spark: SparkSession, path: str) -> DataFrame:
    """dim_step from a step map file.

    ``step_number`` is the position in the arm's own list, not the number in the master list. A
    step the master list does not know makes the query fail.
    """
    step_map = spark.read.schema(STEPMAP_SCHEMA).option("multiLine", "true").json(path)
    design = step_map.select(
        F.map_from_entries(
            F.transform("all_steps_master_list", lambda s: F.struct(s["step_name"], s["bucket"]))
        ).alias("buckets"),
        F.explode("variants").alias("test_group", "variant"),
    ).select(
        "test_group", "buckets", F.posexplode("variant.step_names").alias("position", "step_name")
    )
    known = F.map_contains_key("buckets", F.col("step_name"))
    return design.select(
        "test_group",
        (F.col("position") + 1).alias("step_number"),
        "step_name",
        F.when(known, F.col("buckets")[F.col("step_name")])
        .otherwise(F.raise_error(F.concat(F.lit("step without a bucket: "), "step_name")))
        .alias("step_bucket"),
    )


def read_event_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per event and payload key; an event without keys has one row with a NULL key.

    Without ``multi_line`` every line is a catalogue of its own, for one written by many tasks.
    """
    return (
        spark.read.schema(CATALOG_SCHEMA).option("multiLine", str(multi_line).lower()).json(path)
        .select(F.explode("event_catalog").alias("event_name", "keys"))
        .select("event_name", F.explode_outer("keys").alias("property"))
    )


def read_required_fields(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(CATALOG_SCHEMA).option("multiLine", "true").json(path)
        .select(F.explode("required_envelope_fields").alias("field"))
    )
