"""Statistics over the marts. Inputs have one row per arm; every result is a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.domain import (
    ALPHA, ARM_LABELS, ARMS, CONTROL, PAIRS, POWER, SRM_THRESHOLD, TREATMENT, Z_ALPHA, Z_POWER,
)
from armlens.functions.normal import chi2_tail, two_sided_p, wilson
from armlens.functions.scalars import fixed, literal_map, percent_text

# Metric columns of the two arm marts.
SECONDARY = (
    "activation_rate", "day1_return_rate", "day7_return_rate", "day30_return_rate",
    "paid_conversion_rate", "avg_time_to_first_lesson_seconds",
)
GUARDRAILS = (
    "avg_lesson_relevance_score", "refund_rate", "cancellation_rate",
    "support_ticket_rate", "notification_optin_rate",
)
# Guardrail -> (label, direction that is worse).
REGRESSIONS = {
    "avg_lesson_relevance_score": ("Lesson relevance score", "lower"),
    "refund_rate": ("Refund rate", "higher"),
    "support_ticket_rate": ("Support-ticket rate", "higher"),
    "notification_optin_rate": ("Notification opt-in", "lower"),
}
EXTENDED_REGRESSIONS = {
    "day30_return_rate": ("Day-30 return rate", "lower"),
    "cancellation_rate": ("Cancellation rate", "higher"),
}
# Verdicts.
HOLD = "HOLD"
SHIP = "SHIP (Medium, Arm B)"
SHIP_MODERATE = "SHIP WITH MITIGATION (Arm B, not C)"
SHIP_CAREFULLY = "SHIP WITH MITIGATION"


EQUAL_SPLIT = {arm: 1.0 for arm in ARMS}


def srm_check(kpi: DataFrame, weights: dict[str, float] = EQUAL_SPLIT) -> DataFrame:
    """Chi-square test of the realised split against the planned one, by default equal over the
    designed arms; one row. An arm of the plan that got nobody counts with all it was due."""
    rows = F.sort_array(F.collect_list(F.struct("test_group", "users_started")))
    gathered = kpi.agg(rows.alias("observed"), F.sum("users_started").alias("users"))
    users = F.col("users").cast("double")
    whole = float(sum(weights.values()))
    share = literal_map({arm: weight / whole for arm, weight in weights.items()})

    def expected(row: Column) -> Column:
        return users * share[row["test_group"]]

    def add(total: Column, row: Column) -> Column:
        gap = row["users_started"] - expected(row)
        return total + gap * gap / expected(row)

    present = F.aggregate("observed", F.lit(0.0), lambda t, row: t + share[row["test_group"]])
    missing = F.size("observed") < len(weights)
    absent = F.when(missing, users * (F.lit(1.0) - present)).otherwise(0.0)
    chi2 = F.aggregate("observed", F.lit(0.0), add) + absent
    scored = gathered.filter(F.size("observed") > 0).select(
        "observed", (users / len(weights)).alias("expected"), chi2.alias("chi2"),
        F.lit(len(weights) - 1).alias("degrees"),
    ).withColumn("p", chi2_tail(F.col("chi2"), F.col("degrees")))
    passes = F.col("p") >= SRM_THRESHOLD
    return scored.select(
        F.map_from_entries("observed").alias("observed"),
        F.round("expected", 1).alias("expected_per_arm"),
        F.round("chi2", 4).alias("chi2_statistic"),
        F.round("p", 4).alias("p_value"),
        passes.alias("passes"),
        F.when(passes, "Allocation is consistent with the planned split")
        .otherwise("Sample ratio mismatch: check the randomizer and the logging first")
        .alias("interpretation"),
    )


def completion_by_arm(kpi: DataFrame) -> DataFrame:
    """Completion rate of each arm with its Wilson 95% interval."""
    low, high = wilson(F.col("users_completed"), F.col("users_started"), Z_ALPHA)
    return kpi.select(
        "test_group",
        literal_map(ARM_LABELS)[F.col("test_group")].alias("label"),
        "users_started", "users_completed",
        F.col("onboarding_completion_rate").alias("completion_rate"),
        F.round(low, 4).alias("ci_95_low"),
        F.round(high, 4).alias("ci_95_high"),
    )


def pairwise_tests(kpi: DataFrame) -> DataFrame:
    """Two-proportion tests of every pair of arms.

    z is pooled, from raw counts, and negative when the second arm is better. Difference, lift
    and interval start from the published, rounded rates.
    """
    # The few arms meet in one row, so the marts behind them are computed once.
    figures = F.struct(
        F.col("users_completed").cast("double").alias("x"), F.col("users_started").cast("double").alias("n"),
        F.col("onboarding_completion_rate").alias("rate"),
    )
    met = kpi.agg(F.map_from_entries(F.collect_list(F.struct("test_group", figures))).alias("arms"))
    arms = F.col("arms")
    tested = F.array(*[
        F.struct(F.lit(a).alias("arm_a"), F.lit(b).alias("arm_b"), arms[a].alias("a"), arms[b].alias("b"))
        for a, b in PAIRS
    ])
    pairs = met.select(F.explode(tested).alias("pair")).select("pair.*").filter(
        F.col("a").isNotNull() & F.col("b").isNotNull()
    ).select("arm_a", "arm_b", *[
        F.col(f"{side}.{name}").alias(f"{name}_{side}") for side in "ab" for name in ("x", "n", "rate")
    ])

    x_a, n_a, p_a = F.col("x_a"), F.col("n_a"), F.col("rate_a")
    x_b, n_b, p_b = F.col("x_b"), F.col("n_b"), F.col("rate_b")
    pooled = (x_a + x_b) / (n_a + n_b)
    error = F.sqrt(pooled * (1.0 - pooled) * (1.0 / n_a + 1.0 / n_b))
    scored = pairs.select(
        "arm_a", "arm_b", "rate_a", "rate_b",
        F.try_divide(x_a / n_a - x_b / n_b, error).alias("z"),
        F.round(p_b - p_a, 4).alias("absolute_diff"),
        F.round(F.try_divide(p_b - p_a, p_a) * 100, 2).alias("relative_lift_pct"),
        (F.sqrt(p_a * (1.0 - p_a) / n_a + p_b * (1.0 - p_b) / n_b) * Z_ALPHA).alias("margin"),
    ).withColumn("p_value", two_sided_p(F.col("z")))
    labels = literal_map(ARM_LABELS)

    def named(arm: str) -> Column:
        return F.concat(arm, F.lit(" ("), labels[F.col(arm)], F.lit(")"))

    return scored.select(
        "arm_a", "arm_b",
        F.concat(named("arm_a"), F.lit(" vs "), named("arm_b")).alias("label"),
        "rate_a", "rate_b", "absolute_diff", "relative_lift_pct",
        F.round(F.col("absolute_diff") - F.col("margin"), 4).alias("diff_ci_low"),
        F.round(F.col("absolute_diff") + F.col("margin"), 4).alias("diff_ci_high"),
        F.array(
            F.round(F.col("absolute_diff") - F.col("margin"), 4), F.round(F.col("absolute_diff") + F.col("margin"), 4),
        ).alias("diff_ci_95"),
        F.round("z", 4).alias("z_statistic"),
        "p_value",
        F.coalesce(F.col("p_value") < ALPHA, F.lit(False)).alias("significant_at_05"),
    )


def metrics_by_arm(mart: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Long form of the metric columns turned so that arms are columns: one row per metric."""
    long = mart.select("test_group", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["test_group"], list(metrics), "metric", "value"
    )
    return long.groupBy("metric").pivot("test_group", list(ARMS)).agg(F.max("value"))


def secondary_metrics(kpi: DataFrame) -> DataFrame:
    return metrics_by_arm(kpi, SECONDARY)


def guardrail_metrics(guardrails: DataFrame) -> DataFrame:
    return metrics_by_arm(guardrails, GUARDRAILS)


def regression_flags(guardrails: DataFrame, kpi: DataFrame | None = None,
                     control: str = CONTROL, treatment: str = TREATMENT) -> DataFrame:
    """Guardrails on which the treatment moved the wrong way, one row per guardrail watched.

    A missing value (no purchases, say) cannot be compared and is not flagged. With ``kpi`` given,
    day-30 return and cancellation are watched as well.
    """
    watched = dict(REGRESSIONS)
    if kpi is None:
        turned = metrics_by_arm(guardrails, tuple(watched))
    else:
        watched.update(EXTENDED_REGRESSIONS)
        turned = metrics_by_arm(
            guardrails, tuple(m for m in watched if m in GUARDRAILS)
        ).unionByName(metrics_by_arm(kpi, ("day30_return_rate",)))
    metric = F.col("metric")
    label = literal_map({m: name for m, (name, _) in watched.items()})[metric]
    worse = literal_map({m: direction for m, (_, direction) in watched.items()})[metric]
    base, tried = F.col(control), F.col(treatment)
    flagged = F.coalesce(
        F.when(worse == "lower", tried < base).otherwise(tried > base), F.lit(False)
    )

    def shown(value: Column) -> Column:
        return F.when(metric == "avg_lesson_relevance_score", fixed(value, 2)).otherwise(percent_text(value))

    # Fixed form of the message.
    message = F.format_string(
        f"%s is %s in {treatment} (%s) than {control} (%s)", label, worse, shown(tried), shown(base)
    )
    return turned.select(
        "metric", worse.alias("bad_direction"), base.alias("control_value"),
        tried.alias("treatment_value"), flagged.cast("int").alias("flagged"),
        F.when(flagged, message).alias("message"),
    )


def _second_proportion(p: Column, h: Column) -> Column:
    """The proportion that is ``h`` (Cohen's effect size) above ``p``."""
    return F.pow(F.sin((h + F.asin(F.sqrt(p)) * 2.0) / 2.0), 2)


def power_recheck(kpi: DataFrame, control: str = CONTROL) -> DataFrame:
    """Smallest completion-rate difference the smallest arm could detect; one row."""
    base = F.max(F.when(F.col("test_group") == control, F.col("onboarding_completion_rate")))
    seen = kpi.agg(F.min("users_started").alias("n"), base.alias("p"))
    h = F.lit(Z_ALPHA + Z_POWER) / F.sqrt(F.col("n") / 2.0)
    points = F.abs(_second_proportion(F.col("p"), h) - F.col("p")) * 100
    return seen.select(
        F.col("n").alias("n_per_arm_achieved"),
        F.col("p").alias("baseline_completion_rate"),
        F.lit(ALPHA).alias("alpha"),
        F.lit(POWER).alias("target_power"),
        F.round(points, 2).alias("achievable_mde_pp_at_80pct_power"),
        F.concat(
            F.lit("At 80% power, arms of "), F.col("n").cast("string"), F.lit(" users show completion rates that differ by "),
            fixed(points, 1), F.lit(" points or more; smaller differences may be missed"),
        ).alias("interpretation"),
    )


def required_sample_size(scenarios: DataFrame) -> DataFrame:
    """Users per arm a two-proportion z-test needs to find ``mde`` above ``baseline`` (fractions)."""
    p1 = F.col("baseline")
    p2 = p1 + F.col("mde")
    middle = (p1 + p2) / 2.0
    under_null = F.sqrt(middle * (1.0 - middle) * 2.0) * Z_ALPHA
    under_effect = F.sqrt(p1 * (1.0 - p1) + p2 * (1.0 - p2)) * Z_POWER
    needed = F.try_divide(F.pow(under_null + under_effect, 2), F.pow(p2 - p1, 2))
    possible = (p1 >= 0) & (p2 <= 1)
    return scenarios.select("*", F.when(possible, F.round(needed, 1)).alias("users_per_arm"))


def revenue_projection(scenarios: DataFrame) -> DataFrame:
    """Completions, payers and revenue: users x completion x paid conversion x revenue per payer."""
    completions = F.col("users") * F.col("completion_rate")
    payers = completions * F.col("paid_conversion_rate")
    return scenarios.select(
        "*",
        F.round(completions, 2).alias("completions"),
        F.round(payers, 2).alias("paying_users"),
        F.round(payers * F.col("arpu"), 2).alias("revenue"),
    )


def revenue_delta(projection: DataFrame, baseline: str, scenario: str) -> DataFrame:
    """What one scenario adds to another; one row."""
    def of(name: str, measure: str) -> Column:
        return F.max(F.when(F.col("scenario") == name, F.col(measure)))

    return projection.agg(*[
        F.round(of(scenario, m) - of(baseline, m), 2).alias(f"{m}_delta")
        for m in ("completions", "paying_users", "revenue")
    ]).select(F.lit(baseline).alias("baseline"), F.lit(scenario).alias("scenario"), "*")


def recommendation(srm: DataFrame, pairs: DataFrame, flags: DataFrame) -> DataFrame:
    """Ship or hold; one row.

    The three inputs are brought together as named numbers, so no join is needed. ``any_significant``
    stands beside the verdict because the last branch says "ship" even when nothing is.
    """
    name, value = "name", F.col("value")
    facts = (
        srm.select(F.lit("srm").alias(name), F.col("passes").cast("int").alias("value"))
        .unionByName(pairs.select(
            F.concat_ws("_", "arm_a", "arm_b").alias(name),
            F.col("significant_at_05").cast("int").alias("value"),
        ))
        .unionByName(flags.select(F.lit("flags").alias(name), F.col("flagged").alias("value")))
    )

    def fact(key: str, combine=F.max) -> Column:
        return F.coalesce(combine(F.when(F.col(name) == key, value)), F.lit(0))

    gathered = facts.agg(
        fact("srm").alias("srm"),
        fact("A_B").alias("ab"),
        fact("A_C").alias("ac"),
        fact("B_C").alias("bc"),
        fact("flags", F.sum).cast("int").alias("flags"),
    )
    srm_ok, ab, ac = F.col("srm") == 1, F.col("ab") == 1, F.col("ac") == 1
    n = F.col("flags")
    verdict = (
        F.when(~srm_ok, HOLD)
        .when(ab & ac & (n == 0), SHIP)
        .when(ab & (n >= 2), SHIP_MODERATE)
        .otherwise(SHIP_CAREFULLY)
    )
    why = (
        F.when(~srm_ok, "The split is off plan; fix the randomizer and run again before reading results")
        .when(ab & ac & (n == 0), "B and C both beat control and no guardrail got worse; B is the smaller change")
        .when(ab & (n >= 2), F.concat(
            F.lit("B beats control; C got worse on "), n.cast("string"),
            F.lit(" guardrails, so C needs a follow-up experiment"),
        ))
        .otherwise("Ship only with the guardrails watched after launch")
    )
    any_significant = F.greatest("ab", "ac", "bc")
    return gathered.select(
        verdict.alias("verdict"), why.alias("reasoning"),
        n.alias("guardrail_regression_count"), any_significant.alias("any_significant"),
    )


def results_document(kpi: DataFrame, guardrails: DataFrame) -> DataFrame:
    """All statistics as one nested row with six sections."""
    from armlens.sources.documents import side_by_side

    srm, arms, pairs = srm_check(kpi), completion_by_arm(kpi), pairwise_tests(kpi)
    flags = regression_flags(guardrails)
    verdict = recommendation(srm, pairs, flags)

    def whole(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(F.struct(*frame.columns).alias(name))

    def by_key(frame: DataFrame, key: str, name: str) -> DataFrame:
        rest = F.struct(*[c for c in frame.columns if c != key])
        return frame.agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key), rest)))).alias(name)
        )

    def in_order(frame: DataFrame, name: str) -> DataFrame:
        return frame.agg(F.sort_array(F.collect_list(F.struct(*frame.columns))).alias(name))

    pair_key = F.concat_ws("_vs_", "arm_a", "arm_b")
    parts = side_by_side(
        whole(srm, "srm_check"),
        by_key(arms, "test_group", "per_arm"),
        in_order(pairs, "pairwise_tests"),
        by_key(pairs.withColumn("pair", pair_key), "pair", "supporting_tests"),
        by_key(secondary_metrics(kpi), "metric", "secondary_metrics"),
        by_key(guardrail_metrics(guardrails), "metric", "by_arm"),
        flags.agg(F.array_compact(F.transform(
            F.sort_array(F.collect_list(F.struct(
                F.array_position(F.array(*[F.lit(m) for m in REGRESSIONS]), F.col("metric")).alias("at"),
                "message",
            ))),
            lambda r: r["message"],
        )).alias("regression_flags_vs_control")),
        whole(power_recheck(kpi), "power_recheck"),
        whole(verdict, "verdict"),
    )
    return parts.select(
        "srm_check",
        F.struct("per_arm", "pairwise_tests").alias("primary_metric"),
        "secondary_metrics",
        F.struct("by_arm", "regression_flags_vs_control").alias("guardrail_metrics"),
        "power_recheck",
        F.struct(
            F.col("verdict.verdict"), F.col("verdict.reasoning"),
            F.col("verdict.guardrail_regression_count").alias("guardrail_regression_count_C_vs_A"),
            F.col("verdict.any_significant"), "supporting_tests",
        ).alias("recommendation"),
    )
