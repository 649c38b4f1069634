from __future__ import annotations

import pytest

from armlens.operators import marts, quality, staging, warehouse
from armlens.sources.faults import corrupt_arm
from armlens.sources.local import local_frame
from conftest import event


def report_of(spark, values):
    return local_frame(spark, list(values.items()), "check_name string, value bigint")


HEALTHY = {name: {"raw_row_count": 10, "mart_kpi_group_count": 3}.get(name, 0) for name in quality.POLICY}


def test_a_healthy_report_passes(spark):
    quality.enforce_values({**HEALTHY, "staging_rejects": 6})
    gate = quality.dq_gate(report_of(spark, {**HEALTHY, "staging_rejects": 6}))
    assert gate.count() == 11 and gate.filter("passed = 0").count() == 0
    quality.enforce(gate)


def test_failures_and_missing_checks_are_named(spark):
    values = {**HEALTHY, "completed_without_started": 2, "mart_kpi_group_count": 2, "raw_row_count": 0}
    del values["orphan_fact_users"]
    with pytest.raises(quality.GateFailure) as failure:
        quality.enforce(quality.dq_gate(report_of(spark, values)))
    with pytest.raises(quality.GateFailure) as at_hand:
        quality.enforce_values(values)
    assert str(at_hand.value) == str(failure.value)
    assert str(failure.value) == (
        "completed_without_started: value 2 violates policy; "
        "mart_kpi_group_count: value 2 violates policy; "
        "orphan_fact_users: check did not run; raw_row_count: value 0 violates policy"
    )


def tables(raw):
    staged = staging.stage(raw)
    rollup = warehouse.user_rollup(staged)
    funnel = warehouse.user_funnel(rollup)
    return {"raw": raw, "staged": staged,
            "dim_user": warehouse.dim_user(rollup), "user_funnel": funnel, "kpi": marts.kpi_by_group(funnel)}


def test_report_counts_every_kind_of_trouble(landed):
    raw = landed([
        event("a", "u_1", "onboarding_started", "2026-06-15T10:00:00"),
        event("b", "u_1", "first_lesson_started", "2026-06-15T09:00:00"),
        event("c", "u_2", "onboarding_completed", arm="B"),
        event("d", "u_3", "first_lesson_completed", arm="C"),
        event("e", "u_4", "subscription_purchased", arm="C"),
        event("f", "u_5", arm="Z"),
        event("g", "u_6"), event("g", "u_6"),
    ])
    got = {r.check_name: r.value for r in quality.dq_report(tables(raw)).collect()}
    assert got == {
        "raw_row_count": 8, "staging_rejects": 1, "staging_duplicate_event_ids": 0,
        "users_missing_install_event": 4, "orphan_fact_users": 0, "completed_without_started": 1,
        "activated_without_completed": 1, "purchased_without_activated": 1, "invalid_test_group_values": 0,
        "mart_kpi_group_count": 3, "negative_time_to_first_lesson": 1, "kpi_rates_out_of_bounds": 0,
    }


def test_all_arms_invalid_fails_on_the_group_count(landed):
    raw = corrupt_arm(landed([event(f"e{i}", f"u_{i}", arm="ABC"[i % 3]) for i in range(9)]))
    with pytest.raises(quality.GateFailure, match="mart_kpi_group_count: value 0 violates policy"):
        quality.enforce(quality.dq_gate(quality.dq_report(tables(raw))))


def test_rates_above_one_are_out_of_bounds(landed):
    raw = landed([
        event("a", "u_1", "onboarding_completed"), event("b", "u_1", "first_lesson_completed"),
        event("c", "u_2", "first_lesson_completed"),
    ])
    got = {r.check_name: r.value for r in quality.dq_report(tables(raw)).collect()}
    assert got["kpi_rates_out_of_bounds"] == 1
