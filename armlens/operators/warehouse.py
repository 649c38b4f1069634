"""Warehouse layer: users, dates, steps, step events and the per-user funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlens.domain import STEP_EVENTS

# 0/1 column -> event that sets it.
INSTALLED = "app_installed"
USER_FLAGS = {"account_created_flag": "account_created"}
FUNNEL_FLAGS = {
    "started_onboarding": "onboarding_started",
    "completed_onboarding": "onboarding_completed",
    "started_first_lesson": "first_lesson_started",
    "activated": "first_lesson_completed",
    "returned_day1": "app_opened_day1",
    "returned_day7": "app_opened_day7",
    "returned_day30": "app_opened_day30",
    "notif_shown": "notification_permission_shown",
    "notif_accepted": "notification_permission_accepted",
    "trial_started": "trial_started",
    "purchased": "subscription_purchased",
    "refund_requested": "refund_requested",
    "subscription_cancelled": "subscription_cancelled",
    "filed_support_ticket": "support_ticket_created",
}
FIRST_TIMES = {
    "install_ts": INSTALLED,
    "onboarding_started_ts": "onboarding_started",
    "onboarding_completed_ts": "onboarding_completed",
    "first_lesson_started_ts": "first_lesson_started",
}
_BITS = {name: 1 << i for i, name in enumerate({**USER_FLAGS, **FUNNEL_FLAGS}.values())}

USER_KEYS = ("user_id", "test_group", "platform")


def _event_bit() -> Column:
    cases = " ".join(f"WHEN '{name}' THEN {bit}" for name, bit in _BITS.items())
    return F.expr(f"CASE event_name {cases} ELSE 0 END")


def _flag(bits: str, event: str, column: str) -> Column:
    return F.expr(f"CAST(({bits} & {_BITS[event]}) > 0 AS INT) AS {column}")


def _if_event(event: str, column: str) -> Column:
    return F.expr(f"CASE WHEN event_name = '{event}' THEN {column} END")


def user_states(staged: DataFrame, *more: str) -> DataFrame:
    """Mergeable states of users: what ``merged_users`` needs, per user, arm, platform and ``more`` keys.

    The signup method is a key too, because a text maximum would turn the pass over all events into a
    sort; flags travel as bits of one number, times as minima, scores as sum and count. Partial sums
    leave one row per user and task, so a user with a third of all events costs no more than others.
    """
    firsts = [F.min(_if_event(event, "event_timestamp")).alias(c) for c, event in FIRST_TIMES.items()]
    return staged.groupBy(
        *USER_KEYS, _if_event("account_created", "signup_method").alias("signup_method"), *more
    ).agg(
        F.bit_or(_event_bit()).alias("bits"),
        *firsts,
        F.max(_if_event("onboarding_completed", "steps_completed")).alias("steps_completed"),
        F.max(_if_event("subscription_purchased", "price_usd")).alias("price_usd"),
        F.sum(_if_event("lesson_feedback_submitted", "relevance_score")).alias("relevance_sum"),
        F.count(_if_event("lesson_feedback_submitted", "relevance_score")).alias("relevance_n"),
    )


def merged_users(states: DataFrame) -> DataFrame:
    """States of any days added up, one row per user, arm and platform, laid out by user for ``user_funnel``."""
    return states.repartition("user_id").groupBy(*USER_KEYS).agg(
        F.max("signup_method").alias("signup_method"),
        F.bit_or("bits").alias("bits"),
        *[F.min(c).alias(c) for c in FIRST_TIMES],
        F.max("steps_completed").alias("steps_completed"),
        F.max("price_usd").alias("price_usd"),
        F.sum("relevance_sum").alias("relevance_sum"),
        F.sum("relevance_n").alias("relevance_n"),
    )


def user_rollup(staged: DataFrame) -> DataFrame:
    """What both user tables need, one row per user, arm and platform, from one pass over events."""
    return merged_users(user_states(staged))


def dim_user(rollup: DataFrame) -> DataFrame:
    """One row per user, arm and platform; unique by user as long as users keep their arm."""
    return rollup.select(
        *USER_KEYS,
        "install_ts",
        F.to_date("install_ts").alias("install_date"),
        *[_flag("bits", event, c) for c, event in USER_FLAGS.items()],
        "signup_method",
    )


def user_funnel(rollup: DataFrame) -> DataFrame:
    """One row per row of dim_user with the outcomes of all events of that user.

    Equal to dim_user left-joined to its events and grouped. Since the join is on the user
    alone, a user seen in two arms gets the same outcomes in both rows; the window adds up the at
    most arms x platforms rows of a user.
    """
    of_user = Window.partitionBy("user_id")
    merged = rollup.select(
        *USER_KEYS,
        F.to_date("install_ts").alias("install_date"),
        *[_flag("bits", event, c) for c, event in USER_FLAGS.items()],
        F.bit_or("bits").over(of_user).alias("user_bits"),
        F.max("steps_completed").over(of_user).alias("steps_completed"),
        *[
            F.min(c).over(of_user).alias(c)
            for c in FIRST_TIMES if c != "install_ts"
        ],
        F.max("price_usd").over(of_user).alias("price_usd"),
        F.sum("relevance_sum").over(of_user).alias("relevance_sum"),
        F.sum("relevance_n").over(of_user).alias("relevance_n"),
    )
    flags = {c: _flag("user_bits", event, c) for c, event in FUNNEL_FLAGS.items()}
    waited = F.unix_timestamp("first_lesson_started_ts") - F.unix_timestamp("onboarding_started_ts")
    return merged.select(
        *USER_KEYS, "install_date", "account_created_flag",
        flags["started_onboarding"], flags["completed_onboarding"], "steps_completed",
        "onboarding_started_ts", "onboarding_completed_ts",
        flags["started_first_lesson"], flags["activated"], "first_lesson_started_ts",
        flags["returned_day1"], flags["returned_day7"], flags["returned_day30"],
        flags["notif_shown"], flags["notif_accepted"], flags["trial_started"],
        flags["purchased"], "price_usd", flags["refund_requested"],
        flags["subscription_cancelled"], flags["filed_support_ticket"],
        F.try_divide("relevance_sum", "relevance_n").alias("avg_relevance_score"),
        waited.alias("time_to_first_lesson_seconds"),
    )


def dim_date(staged: DataFrame) -> DataFrame:
    """Every calendar day between the first and the last event; empty when there are none."""
    span = staged.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("date_key"))
    weekday = F.dayofweek("date_key") - 1
    return days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).cast("int").alias("is_weekend"),
    )


def step_events(staged: DataFrame) -> DataFrame:
    """Viewed, completed and abandoned onboarding steps."""
    return staged.filter(F.col("event_name").isin(*STEP_EVENTS)).select(
        "event_id", "user_id", "test_group", "platform",
        F.col("event_name").alias("step_event_type"),
        "step_number", "step_name", "step_bucket", "time_on_step_seconds", "exit_reason",
        "event_timestamp", "event_date",
    )
