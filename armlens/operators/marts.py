"""Marts: small tables by arm, by step and by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.domain import STEP_EVENTS
from armlens.functions.scalars import ratio


def _total(column: str) -> Column:
    return F.sum(column)


def _kpis() -> list[Column]:
    users, completed = F.count(F.lit(1)), _total("completed_onboarding")
    activated, purchased = _total("activated"), _total("purchased")
    return [
        users.alias("users_started"),
        completed.alias("users_completed"),
        ratio(completed, users).alias("onboarding_completion_rate"),
        activated.alias("users_activated"),
        ratio(activated, completed).alias("activation_rate"),
        purchased.alias("users_purchased"),
        ratio(purchased, activated).alias("paid_conversion_rate"),
        F.round(F.avg("time_to_first_lesson_seconds"), 1).alias("avg_time_to_first_lesson_seconds"),
        ratio(_total("returned_day1"), completed).alias("day1_return_rate"),
        ratio(_total("returned_day7"), completed).alias("day7_return_rate"),
        ratio(_total("returned_day30"), completed).alias("day30_return_rate"),
    ]


def _guardrails() -> list[Column]:
    users, purchased = F.count(F.lit(1)), _total("purchased")
    return [
        F.round(F.avg("avg_relevance_score"), 3).alias("avg_lesson_relevance_score"),
        ratio(_total("refund_requested"), purchased).alias("refund_rate"),
        ratio(_total("subscription_cancelled"), purchased).alias("cancellation_rate"),
        ratio(_total("filed_support_ticket"), users).alias("support_ticket_rate"),
        ratio(_total("notif_accepted"), _total("notif_shown")).alias("notification_optin_rate"),
    ]


KPI_COLUMNS = (
    "users_started", "users_completed", "onboarding_completion_rate", "users_activated", "activation_rate",
    "users_purchased", "paid_conversion_rate", "avg_time_to_first_lesson_seconds", "day1_return_rate",
    "day7_return_rate", "day30_return_rate",
)
GUARDRAIL_COLUMNS = (
    "avg_lesson_relevance_score", "refund_rate", "cancellation_rate", "support_ticket_rate",
    "notification_optin_rate",
)


def kpi_by_group(funnel: DataFrame) -> DataFrame:
    return funnel.groupBy("test_group").agg(*_kpis())


def guardrails_by_group(funnel: DataFrame) -> DataFrame:
    return funnel.groupBy("test_group").agg(*_guardrails())


def metrics_by_group(funnel: DataFrame) -> DataFrame:
    """The columns of both arm marts from one pass over the funnel."""
    return funnel.groupBy("test_group").agg(*_kpis(), *_guardrails())


STEP = ("test_group", "step_number", "step_name")
STEP_COUNTS = ("users_viewed", "users_completed", "users_abandoned")


def step_states(events: DataFrame, *more: str) -> DataFrame:
    """Mergeable states of steps: what each user did at each step, 0 or 1, per ``more`` keys."""
    seen = [F.max(F.when(F.col("step_event_type") == event, 1).otherwise(0)).alias(column)
            for column, event in zip(STEP_COUNTS, STEP_EVENTS)]
    return events.groupBy(*STEP, "user_id", *more).agg(*seen)


def step_dropoff(events: DataFrame, design: DataFrame) -> DataFrame:
    """Distinct users per arm and step who viewed, completed and abandoned it.

    Distinct counting is a grouping by user first and a sum after, so no rows are multiplied and
    neither a hot step nor a hot user meets in one task.
    """
    return counted_steps(step_states(events), design)


def counted_steps(per_user: DataFrame, design: DataFrame) -> DataFrame:
    """Users per arm and step from one row per step and user, or from counts of users apart. The design is
    joined to the summed rows, where both sides are small; steps outside the design drop out there."""
    counted = per_user.groupBy(*STEP).agg(*[F.sum(c).alias(c) for c in STEP_COUNTS])
    buckets = design.select("test_group", "step_number", "step_bucket").distinct()
    return counted.join(buckets, ["test_group", "step_number"]).select(
        *STEP, "step_bucket", *STEP_COUNTS,
        ratio(F.col("users_abandoned"), F.col("users_viewed")).alias("step_abandon_rate"),
    )


def daily_funnel(funnel: DataFrame) -> DataFrame:
    users, completed = F.count(F.lit(1)), _total("completed_onboarding")
    return funnel.groupBy("install_date", "test_group").agg(
        users.alias("users_started"),
        completed.alias("users_completed"),
        ratio(completed, users).alias("onboarding_completion_rate"),
    )
