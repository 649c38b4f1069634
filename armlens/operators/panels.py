"""Frames behind the dashboard panels; drawing is left to whatever shows them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.domain import ARM_SHORT_LABELS
from armlens.functions.scalars import fixed, literal_map

# Guardrails drawn -> scale.
GUARDRAIL_SCALES = {
    "avg_lesson_relevance_score": 1.0,
    "refund_rate": 100.0,
    "support_ticket_rate": 100.0,
    "notification_optin_rate": 100.0,
}


def completion_panel(arms: DataFrame) -> DataFrame:
    """Completion rate in percent with the distances to both interval bounds."""
    rate, low, high = (F.col(c) * 100 for c in ("completion_rate", "ci_95_low", "ci_95_high"))
    return arms.select(
        "test_group",
        F.round(rate, 2).alias("rate_pct"),
        F.round(rate - low, 2).alias("error_low"),
        F.round(high - rate, 2).alias("error_high"),
    )


def guardrail_panel(guardrails: DataFrame) -> DataFrame:
    """One row per arm and drawn guardrail, rates in percent."""
    long = guardrails.unpivot(["test_group"], list(GUARDRAIL_SCALES), "metric", "raw")
    scale = literal_map(GUARDRAIL_SCALES)[F.col("metric")]
    return long.select("test_group", "metric", F.round(F.col("raw") * scale, 3).alias("value"))


def step_series(dropoff: DataFrame) -> DataFrame:
    """Abandon rate in percent by arm and step, in drawing order."""
    return dropoff.select(
        "test_group", "step_number", F.round(F.col("step_abandon_rate") * 100, 2).alias("abandon_pct")
    ).orderBy("test_group", "step_number")


def daily_trend(daily: DataFrame) -> DataFrame:
    """Completion rate in percent by install day, labelled MM-DD, in drawing order."""
    return daily.select(
        "test_group", "install_date",
        F.date_format("install_date", "MM-dd").alias("day_label"),
        F.round(F.col("onboarding_completion_rate") * 100, 2).alias("rate_pct"),
    ).orderBy("test_group", "install_date")


def kpi_cards(arms: DataFrame, srm: DataFrame) -> DataFrame:
    """A card per arm (rate; users and interval) and a closing line on the split."""
    cards = arms.select(
        literal_map(ARM_SHORT_LABELS)[F.col("test_group")].alias("card"),
        F.concat(fixed(F.col("completion_rate") * 100, 1), F.lit("%")).alias("headline"),
        F.concat(
            F.lit("n="), fixed(F.col("users_started"), 0),
            F.lit("  CI["), fixed(F.col("ci_95_low") * 100, 1),
            F.lit(", "), fixed(F.col("ci_95_high") * 100, 1), F.lit("]%"),
        ).alias("detail"),
    )
    line = srm.select(
        F.lit("SRM check").alias("card"),
        F.when(F.col("passes"), "passes").otherwise("fails").alias("headline"),
        F.concat(
            F.lit("chi2="), F.col("chi2_statistic").cast("string"),
            F.lit(", p="), F.col("p_value").cast("string"),
        ).alias("detail"),
    )
    return cards.unionByName(line)
