from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from armlens.domain import Z_ALPHA, Z_POWER
from armlens.functions.normal import chi2_tail, erfc, two_sided_p
from armlens.operators import inference, panels
from armlens.sources.local import local_frame
from conftest import as_dicts

KPI_SCHEMA = (
    "test_group string, users_started bigint, users_completed bigint, onboarding_completion_rate double, "
    "users_activated bigint, activation_rate double, users_purchased bigint, paid_conversion_rate double, "
    "avg_time_to_first_lesson_seconds double, day1_return_rate double, day7_return_rate double, "
    "day30_return_rate double"
)
GUARD_SCHEMA = (
    "test_group string, avg_lesson_relevance_score double, refund_rate double, cancellation_rate double, "
    "support_ticket_rate double, notification_optin_rate double"
)
# Published marts of the experiment.
KPI = [
    ("A", 2000, 1148, 0.574, 801, 0.6977, 49, 0.0612, 1584.4, 0.5584, 0.4268, 0.3615),
    ("B", 2000, 1460, 0.73, 923, 0.6322, 53, 0.0574, 1507.0, 0.5438, 0.4014, 0.3425),
    ("C", 2000, 1630, 0.815, 1070, 0.6564, 67, 0.0626, 1475.6, 0.5552, 0.4209, 0.2896),
]
GUARDRAILS = [
    ("A", 3.983, 0.0, 0.0816, 0.009, 0.5281),
    ("B", 3.861, 0.0377, 0.0566, 0.012, 0.5117),
    ("C", 3.436, 0.0, 0.0448, 0.022, 0.327),
]


@pytest.fixture
def kpi(spark):
    return local_frame(spark, KPI, KPI_SCHEMA)


@pytest.fixture
def guardrails(spark):
    return local_frame(spark, GUARDRAILS, GUARD_SCHEMA)


def split(spark, *counts):
    rows = [(arm, n, n // 2, 0.5, *[None] * 8) for arm, n in zip("ABCDE", counts)]
    return local_frame(spark, rows, KPI_SCHEMA)


def test_erfc_follows_math(spark):
    xs = [0.0, 1e-9, 0.1, 0.5, 1.0, 1.5, 1.999999, 2.0, 2.5, 3.0, 5.0, 8.0, 12.0, 26.0]
    frame = local_frame(spark, [(x,) for x in xs], "x double").select("x", erfc(F.col("x")).alias("y"))
    for row in frame.collect():
        assert row.y == pytest.approx(math.erfc(row.x), rel=1e-11)


def test_two_sided_p_is_symmetric_and_null_safe(spark):
    frame = local_frame(spark, [(-1.96,), (1.96,), (None,)], "z double")
    low, high, missing = [r.p for r in frame.select(two_sided_p(F.col("z")).alias("p")).collect()]
    assert low == high == pytest.approx(0.04999579, abs=1e-8) and missing is None


def test_chi2_tail_for_every_parity(spark):
    def numeric(x, df):
        # Simpson on the density from x to far out.
        n, top = 20000, x + 200.0
        h = (top - x) / n
        norm = 2 ** (df / 2) * math.gamma(df / 2)
        total = 0.0
        for i in range(n + 1):
            t = x + i * h
            total += t ** (df / 2 - 1) * math.exp(-t / 2) / norm * (1 if i in (0, n) else 4 if i % 2 else 2)
        return total * h / 3

    cases = [(x, df) for x in (0.5, 2.0, 7.3, 25.0) for df in (1, 2, 3, 4, 5, 6, 7)]
    frame = local_frame(spark, cases, "x double, df int").select(
        "x", "df", chi2_tail(F.col("x"), F.col("df")).alias("p"))
    for row in frame.collect():
        assert row.p == pytest.approx(numeric(row.x, row.df), rel=1e-6), row


def test_srm_of_an_even_split(kpi):
    row = inference.srm_check(kpi).first()
    assert (row.observed, row.expected_per_arm, row.chi2_statistic, row.p_value, row.passes) == (
        {"A": 2000, "B": 2000, "C": 2000}, 2000.0, 0.0, 1.0, True)


def test_srm_catches_a_broken_split_and_takes_weights(spark):
    assert inference.srm_check(split(spark, 2000, 2000, 2300)).first().passes is False
    two = inference.srm_check(split(spark, 1000, 1100), {"A": 1, "B": 1}).first()
    assert two.chi2_statistic == pytest.approx(4.7619, abs=1e-4)
    assert two.p_value == pytest.approx(math.erfc(math.sqrt(4.761904761904762 / 2)), abs=1e-4)
    weighted = inference.srm_check(split(spark, 1000, 2000), {"A": 1, "B": 2}).first()
    assert (weighted.chi2_statistic, weighted.passes) == (0.0, True)
    missing = inference.srm_check(split(spark, 500, 500)).first()
    assert (missing.chi2_statistic, missing.passes) == (500.0, False)


def test_wilson_intervals(kpi):
    got = {r.test_group: (r.label, r.ci_95_low, r.ci_95_high) for r in inference.completion_by_arm(kpi).collect()}
    assert got == {
        "A": ("Control (13 steps)", 0.5522, 0.5955), "B": ("Medium (7 steps)", 0.7101, 0.749),
        "C": ("Short (5 steps)", 0.7974, 0.8314),
    }


def test_pairwise_tests(kpi):
    got = {(r.arm_a, r.arm_b): r for r in inference.pairwise_tests(kpi).collect()}
    want = {
        ("A", "B"): (0.156, 27.18, 0.1269, 0.1851, -10.3565, 3.9118733748027436e-25),
        ("A", "C"): (0.241, 41.99, 0.2134, 0.2686, -16.5453, 1.730275923644254e-61),
        ("B", "C"): (0.085, 11.64, 0.0592, 0.1108, -6.4118, 1.4382516029468581e-10),
    }
    assert set(got) == set(want)
    for pair, (diff, lift, low, high, z, p) in want.items():
        r = got[pair]
        assert (r.absolute_diff, r.relative_lift_pct, r.diff_ci_low, r.diff_ci_high, r.z_statistic) == (
            diff, lift, low, high, z)
        assert r.p_value == pytest.approx(p, rel=1e-9)
        assert r.significant_at_05 is True
    assert got[("A", "B")].label == "A (Control (13 steps)) vs B (Medium (7 steps))"


def test_lift_without_a_baseline_is_null(spark):
    rows = [("A", 10, 0, 0.0, *[None] * 8), ("B", 10, 0, 0.0, *[None] * 8)]
    r = inference.pairwise_tests(local_frame(spark, rows, KPI_SCHEMA)).first()
    assert r.relative_lift_pct is None and r.z_statistic is None and r.significant_at_05 is False


def test_metrics_by_arm(kpi, guardrails):
    second = {r.metric: (r.A, r.B, r.C) for r in inference.secondary_metrics(kpi).collect()}
    assert second["day30_return_rate"] == (0.3615, 0.3425, 0.2896)
    assert second["avg_time_to_first_lesson_seconds"] == (1584.4, 1507.0, 1475.6)
    guards = {r.metric: (r.A, r.B, r.C) for r in inference.guardrail_metrics(guardrails).collect()}
    assert len(second) == 6 and len(guards) == 5 and guards["refund_rate"] == (0.0, 0.0377, 0.0)


def test_regression_flags_and_messages(kpi, guardrails):
    rows = inference.regression_flags(guardrails).collect()
    assert {r.message for r in rows if r.flagged} == {
        "Lesson relevance score is lower in C (3.44) than A (3.98)",
        "Support-ticket rate is higher in C (2.2%) than A (0.9%)",
        "Notification opt-in is lower in C (32.7%) than A (52.8%)",
    }
    assert len(rows) == 4
    more = {r.metric: r.flagged for r in inference.regression_flags(guardrails, kpi=kpi).collect()}
    assert more["day30_return_rate"] == 1 and more["cancellation_rate"] == 0 and len(more) == 6


def test_missing_guardrails_are_not_flagged(spark):
    rows = [("A", None, None, None, 0.1, 0.5), ("C", 1.0, 0.5, None, None, None)]
    flags = inference.regression_flags(local_frame(spark, rows, GUARD_SCHEMA)).collect()
    assert [r.flagged for r in flags] == [0, 0, 0, 0]


def test_power_recheck(kpi):
    r = inference.power_recheck(kpi).first()
    assert tuple(r)[:5] == (2000, 0.574, 0.05, 0.8, 4.35)


def test_required_sample_size(spark):
    frame = local_frame(spark, [(0.6, 0.05), (0.98, 0.05), (0.6, 0.0)], "baseline double, mde double")
    first, impossible, none = [r.users_per_arm for r in inference.required_sample_size(frame).collect()]
    assert first == 1470.5 and impossible is None and none is None
    spread = Z_ALPHA * math.sqrt(2 * 0.625 * 0.375) + Z_POWER * math.sqrt(0.6 * 0.4 + 0.65 * 0.35)
    assert first == pytest.approx((spread / 0.05) ** 2, abs=0.05)


def test_revenue_projection_and_delta(spark):
    frame = local_frame(
        spark, [("now", 100000.0, 0.6, 0.06, 30.0), ("benchmark", 100000.0, 0.8, 0.06, 30.0)],
        "scenario string, users double, completion_rate double, paid_conversion_rate double, arpu double")
    projected = inference.revenue_projection(frame)
    got = {r.scenario: (r.completions, r.paying_users, r.revenue) for r in projected.collect()}
    assert got == {"now": (60000.0, 3600.0, 108000.0), "benchmark": (80000.0, 4800.0, 144000.0)}
    delta = inference.revenue_delta(projected, "now", "benchmark").first()
    assert tuple(delta) == ("now", "benchmark", 20000.0, 1200.0, 36000.0)


def verdict(kpi, guardrails):
    return inference.recommendation(
        inference.srm_check(kpi), inference.pairwise_tests(kpi), inference.regression_flags(guardrails)).first()


def test_recommendation_branches(spark, kpi, guardrails):
    r = verdict(kpi, guardrails)
    assert (r.verdict, r.guardrail_regression_count, r.any_significant) == (
        "SHIP WITH MITIGATION (Arm B, not C)", 3, 1)
    calm = local_frame(spark, [(arm, 4.0, 0.0, 0.0, 0.0, 0.5) for arm in "ABC"], GUARD_SCHEMA)
    assert verdict(kpi, calm).verdict == "SHIP (Medium, Arm B)"
    assert verdict(split(spark, 2000, 2000, 2300), calm).verdict == "HOLD"
    flat = verdict(split(spark, 2000, 2000, 2000), calm)
    assert (flat.verdict, flat.any_significant) == ("SHIP WITH MITIGATION", 0)


def test_results_document_nests_every_section(kpi, guardrails):
    doc = as_dicts(inference.results_document(kpi, guardrails))[0]
    assert list(doc) == ["srm_check", "primary_metric", "secondary_metrics", "guardrail_metrics",
                         "power_recheck", "recommendation"]
    assert doc["primary_metric"]["per_arm"]["B"]["ci_95_low"] == 0.7101
    assert [(p["arm_a"], p["arm_b"]) for p in doc["primary_metric"]["pairwise_tests"]] == [
        ("A", "B"), ("A", "C"), ("B", "C")]
    assert doc["guardrail_metrics"]["regression_flags_vs_control"][0].startswith("Lesson relevance")
    assert doc["secondary_metrics"]["activation_rate"] == {"A": 0.6977, "B": 0.6322, "C": 0.6564}
    assert set(doc["recommendation"]["supporting_tests"]) == {"A_vs_B", "A_vs_C", "B_vs_C"}
    assert doc["recommendation"]["verdict"] == "SHIP WITH MITIGATION (Arm B, not C)"


def test_panels(kpi, guardrails):
    arms = inference.completion_by_arm(kpi)
    done = {r.test_group: (r.rate_pct, r.error_low, r.error_high) for r in panels.completion_panel(arms).collect()}
    assert done["A"] == (57.4, 2.18, 2.15)
    bars = {(r.test_group, r.metric): r.value for r in panels.guardrail_panel(guardrails).collect()}
    assert bars[("C", "notification_optin_rate")] == 32.7 and bars[("A", "avg_lesson_relevance_score")] == 3.983
    assert len(bars) == 12
    cards = {r.card: (r.headline, r.detail) for r in panels.kpi_cards(arms, inference.srm_check(kpi)).collect()}
    assert cards["A (Control)"] == ("57.4%", "n=2,000  CI[55.2, 59.6]%")
    assert cards["SRM check"] == ("passes", "chi2=0.0, p=1.0")
