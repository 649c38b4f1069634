"""Data-quality checks, the policy they are held to, and the gate."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from armlens.domain import ARMS
from armlens.functions.scalars import literal_map
from armlens.operators.staging import refused
from armlens.sources.local import local_frame

# Policed check -> (comparison, bound). staging_rejects is informational.
POLICY = {
    "raw_row_count": (">", 0),
    "staging_duplicate_event_ids": ("=", 0),
    "users_missing_install_event": ("=", 0),
    "orphan_fact_users": ("=", 0),
    "completed_without_started": ("=", 0),
    "activated_without_completed": ("=", 0),
    "purchased_without_activated": ("=", 0),
    "invalid_test_group_values": ("=", 0),
    "mart_kpi_group_count": ("=", len(ARMS)),
    "negative_time_to_first_lesson": ("=", 0),
    "kpi_rates_out_of_bounds": ("=", 0),
}
UNIQUE_POLICY = {
    "dim_user_duplicate_user_ids": ("=", 0),
    "dim_date_duplicate_date_keys": ("=", 0),
    "fact_user_funnel_duplicate_user_ids": ("=", 0),
}


class GateFailure(Exception):
    """The policy is violated; the same input would fail again."""


def duplicate_keys(table: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphan_users(funnel: DataFrame, users: DataFrame) -> DataFrame:
    """Funnel rows whose user is not in dim_user."""
    return funnel.join(users.select("user_id"), "user_id", "left_anti")


def _counted(frame: DataFrame, **conditions) -> DataFrame:
    """One row per condition: how many rows meet it, all in one pass."""
    counts = [
        F.count(F.when(condition, 1)).alias(name) for name, condition in conditions.items()
    ]
    return frame.agg(*counts).unpivot([], list(conditions), "check_name", "value")


def observed(frame: DataFrame, conditions: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame, whose next action also counts the rows that meet each condition, and the counts after it.

    To be written by the stage that the conditions stand in: tasks of a writing stage count once, however
    often they run, those of a stage before a shuffle might count twice when executors are lost.
    """
    watch = Observation()
    counts = [F.count(F.when(condition, 1)).alias(name) for name, condition in conditions.items()]

    def values() -> dict[str, int]:
        seen = watch.get  # nothing when Spark saw at once that there are no rows
        return {name: seen.get(name, 0) for name in conditions}

    return frame.observe(watch, *counts), values


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def raw_conditions(strict_null: bool = False, verdict: str | None = None) -> dict[str, Column]:
    """What is counted of raw rows; by their column ``verdict`` if they have one."""
    gone = F.col(verdict) == "refused" if verdict else refused(strict_null)
    return {"raw_row_count": F.lit(True), "staging_rejects": gone}


def user_conditions() -> dict[str, Column]:
    """What is counted of users."""
    return {"users_missing_install_event": F.col("install_ts").isNull()}


def funnel_conditions() -> dict[str, Column]:
    """What is counted of funnel rows."""
    return {
        "completed_without_started": (F.col("completed_onboarding") == 1) & (F.col("started_onboarding") == 0),
        "activated_without_completed": (F.col("activated") == 1) & (F.col("completed_onboarding") == 0),
        "purchased_without_activated": (F.col("purchased") == 1) & (F.col("activated") == 0),
        "invalid_test_group_values": ~F.col("test_group").isin(*ARMS),
        "negative_time_to_first_lesson": F.col("time_to_first_lesson_seconds") < 0,
    }


def staged_checks(staged: DataFrame) -> DataFrame:
    """Ids staged more than once."""
    return _counted(duplicate_keys(staged, "event_id"), staging_duplicate_event_ids=F.lit(True))


def orphan_check(users: DataFrame, funnel: DataFrame) -> DataFrame:
    return _counted(orphan_users(funnel, users), orphan_fact_users=F.lit(True))


def event_checks(raw: DataFrame, staged: DataFrame, strict_null: bool = False) -> DataFrame:
    """Rows landed and rows rejected from one pass over the raw layer, ids staged more than once."""
    return _union([_counted(raw, **raw_conditions(strict_null)), staged_checks(staged)])


def user_checks(users: DataFrame, funnel: DataFrame) -> DataFrame:
    """Users without install, orphans, and the five funnel predicates in one scan."""
    return _union([
        _counted(users, **user_conditions()), orphan_check(users, funnel), _counted(funnel, **funnel_conditions()),
    ])


def mart_checks(kpi: DataFrame) -> DataFrame:
    """Number of arms, and arms with a rate outside 0..1."""
    outside = [
        F.col(c).isNotNull() & ~F.col(c).between(0, 1)
        for c in ("onboarding_completion_rate", "activation_rate", "paid_conversion_rate")
    ]
    return _counted(
        kpi,
        mart_kpi_group_count=F.lit(True),
        kpi_rates_out_of_bounds=reduce(lambda a, b: a | b, outside),
    )


def dq_report(tables: dict[str, DataFrame]) -> DataFrame:
    """The twelve checks as (check_name, value).

    Tables: raw, staged, dim_user, user_funnel, kpi.
    """
    return _union([
        event_checks(tables["raw"], tables["staged"]),
        user_checks(tables["dim_user"], tables["user_funnel"]),
        mart_checks(tables["kpi"]),
    ])


def unique_key_check(table: DataFrame, name: str, key: str) -> DataFrame:
    """Keys of a table that should be unique and are not."""
    return _counted(duplicate_keys(table, key), **{f"{name}_duplicate_{key}s": F.lit(True)})


def unique_key_report(users: DataFrame, dates: DataFrame, funnel: DataFrame) -> DataFrame:
    return _union([
        unique_key_check(users, "dim_user", "user_id"),
        unique_key_check(dates, "dim_date", "date_key"),
        unique_key_check(funnel, "fact_user_funnel", "user_id"),
    ])


def dq_gate(report: DataFrame, policy: dict[str, tuple[str, int]] = POLICY) -> DataFrame:
    """The policed checks with their value, whether they pass, and what is wrong if not.

    A row per policed check is added to the report before grouping, so a check that never ran
    still shows up, without a value.
    """
    names = [(name, None) for name in policy]
    asked = local_frame(report.sparkSession, names, "check_name string, value bigint")
    judged = (
        asked.unionByName(report.filter(F.col("check_name").isin(*policy)))
        .groupBy("check_name").agg(F.max("value").alias("value"))
    )
    value = F.col("value")
    bound = literal_map({n: b for n, (_, b) in policy.items()})[F.col("check_name")]
    above = F.col("check_name").isin(*[n for n, (op, _) in policy.items() if op == ">"])
    passed = F.coalesce(F.when(above, value > bound).otherwise(value == bound), F.lit(False))
    detail = (
        F.when(value.isNull(), F.lit("check did not run"))
        .when(~passed, F.concat(F.lit("value "), value.cast("string"), F.lit(" violates policy")))
    )
    return judged.select("check_name", "value", passed.cast("int").alias("passed"), detail.alias("detail"))


def violations(values: dict[str, int], policy: dict[str, tuple[str, int]] = POLICY) -> dict[str, str]:
    """What is wrong with check values already at hand: check -> detail, failed ones only."""
    wrong = {}
    for name, (comparison, bound) in policy.items():
        value = values.get(name)
        if value is None:
            wrong[name] = "check did not run"
        elif not (value > bound if comparison == ">" else value == bound):
            wrong[name] = f"value {value} violates policy"
    return wrong


def enforce_values(values: dict[str, int], policy: dict[str, tuple[str, int]] = POLICY) -> None:
    """Raise with every failed check."""
    if wrong := violations(values, policy):
        raise GateFailure("; ".join(f"{name}: {wrong[name]}" for name in sorted(wrong)))


def enforce(gate: DataFrame) -> None:
    """Raise with every failed check; only failed rows, at most one per check, reach the driver."""
    failed = gate.filter("passed = 0").orderBy("check_name").collect()
    if failed:
        raise GateFailure("; ".join(f"{row['check_name']}: {row['detail']}" for row in failed))
