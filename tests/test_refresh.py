"""A whole run from events shaped after the published experiment, back to its published figures."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from armlens.domain import ARM_STEPS, ENVELOPE, STEP_BUCKETS
from armlens.operators import quality, staging, warehouse
from armlens.operators.quality import GateFailure
from armlens.plans import refresh
from armlens.sources import run_log
from armlens.sources.events_csv import write_events_csv
from armlens.sources.faults import inject_dirty
from armlens.sources.landing import land
from armlens.sources.layers import read_bucketed, write_bucketed
from armlens.sources.local import local_frame
from conftest import event

USERS = 2000
# Users who saw each step, then those who finished the last one.
REACHED = {
    "A": (2000, 1944, 1882, 1849, 1741, 1668, 1611, 1493, 1418, 1353, 1280, 1234, 1186, 1148),
    "B": (2000, 1960, 1856, 1764, 1707, 1584, 1495, 1460),
    "C": (2000, 1970, 1858, 1780, 1659, 1630),
}
# Users per outcome.
OUTCOMES = {
    "first_lesson_completed": {"A": 801, "B": 923, "C": 1070},
    "subscription_purchased": {"A": 49, "B": 53, "C": 67},
    "refund_requested": {"A": 0, "B": 2, "C": 0},
    "subscription_cancelled": {"A": 4, "B": 3, "C": 3},
    "support_ticket_created": {"A": 18, "B": 24, "C": 44},
    "app_opened_day1": {"A": 641, "B": 794, "C": 905},
    "app_opened_day7": {"A": 490, "B": 586, "C": 686},
    "app_opened_day30": {"A": 415, "B": 500, "C": 472},
}
RATES = {
    "A": (1148, 0.574, 801, 0.6977, 49, 0.0612, 0.5584, 0.4268, 0.3615),
    "B": (1460, 0.73, 923, 0.6322, 53, 0.0574, 0.5438, 0.4014, 0.3425),
    "C": (1630, 0.815, 1070, 0.6564, 67, 0.0626, 0.5552, 0.4209, 0.2896),
}


def experiment(spark):
    """User n of an arm gets as far as the counts say: the first users get furthest."""
    plan = []
    for arm, reached in REACHED.items():
        plan += [(arm, "app_installed", USERS, 0, "{}"), (arm, "onboarding_started", USERS, 0, "{}")]
        for i, step in enumerate(ARM_STEPS[arm]):
            seen, done = reached[i], reached[i + 1]
            text = f'{{"step_number": {i + 1}, "step_name": "{step}"'
            plan += [
                (arm, "onboarding_step_viewed", seen, 0, f'{text}, "step_bucket": "{STEP_BUCKETS[step]}"}}'),
                (arm, "onboarding_step_completed", done, 0, f'{text}, "time_on_step_seconds": 9.5}}'),
                (arm, "onboarding_step_abandoned", seen, done, f'{text}, "exit_reason": "timeout"}}'),
            ]
        plan += [(arm, "onboarding_completed", reached[-1], 0, f'{{"steps_completed": {len(ARM_STEPS[arm])}}}'),
                 (arm, "first_lesson_started", reached[-1], 0, "{}")]
        plan += [(arm, name, counts[arm], 0, "{}") for name, counts in OUTCOMES.items()]
    steps = local_frame(spark, plan, "arm string, name string, upto int, past int, payload string")
    users = steps.select("*", F.explode(F.sequence(F.lit(0), F.lit(USERS - 1))).alias("n"))
    mine = users.filter("n < upto AND n >= past")
    user = F.format_string("u_%s_%07d", "arm", "n")
    return mine.select(
        F.concat_ws("|", user, "name", "payload").alias("event_id"), user.alias("user_id"),
        F.col("name").alias("event_name"),
        F.format_string("2026-06-%02dT10:%02d:00.250000+00:00", F.lit(15) + F.col("n") % 10,
                        F.when(F.col("name") == "first_lesson_started", 30).otherwise(5)).alias("event_timestamp"),
        F.col("arm").alias("test_group"), F.when(F.col("n") % 2 == 0, "iOS").otherwise("Android").alias("platform"),
        F.lit("s").alias("session_id"), F.col("payload").alias("properties"),
    )


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("refresh"))
    raw = inject_dirty(land(experiment(spark), "events.csv"))
    return root, refresh.refresh(raw, root)


def test_published_marts_equal_the_experiment(spark, run):
    root, _ = run
    kpi = {r.test_group: r for r in refresh.published(spark, root, "mart_kpi_by_group").collect()}
    for arm, want in RATES.items():
        r = kpi[arm]
        assert (r.users_started, r.users_completed, r.onboarding_completion_rate, r.users_activated,
                r.activation_rate, r.users_purchased, r.paid_conversion_rate, r.day1_return_rate,
                r.day7_return_rate, r.day30_return_rate) == (USERS, *want)
        assert r.avg_time_to_first_lesson_seconds == 1500.0
    guards = {r.test_group: (r.refund_rate, r.cancellation_rate, r.support_ticket_rate)
              for r in refresh.published(spark, root, "mart_guardrails_by_group").collect()}
    assert guards == {"A": (0.0, 0.0816, 0.009), "B": (0.0377, 0.0566, 0.012), "C": (0.0, 0.0448, 0.022)}


def test_step_mart_keeps_the_funnel_invariants(spark, run):
    root, _ = run
    steps = {(r.test_group, r.step_number): r for r in refresh.published(spark, root, "mart_step_dropoff").collect()}
    assert len(steps) == 25
    for (arm, n), r in steps.items():
        assert r.users_viewed == r.users_completed + r.users_abandoned == REACHED[arm][n - 1]
        assert r.users_completed == REACHED[arm][n]
        assert r.step_bucket == STEP_BUCKETS[r.step_name]
    assert steps[("A", 7)].step_abandon_rate == 0.0732 and steps[("C", 5)].step_abandon_rate == 0.0175


def test_daily_mart_adds_up_to_the_kpi_mart(spark, run):
    root, _ = run
    daily = refresh.published(spark, root, "mart_daily_funnel")
    totals = daily.groupBy("test_group").agg(F.sum("users_started").alias("s"), F.sum("users_completed").alias("c"))
    assert {r.test_group: (r.s, r.c) for r in totals.collect()} == {
        arm: (USERS, reached[-1]) for arm, reached in REACHED.items()}
    assert daily.select("install_date").distinct().count() == 10


def test_checks_and_history_of_the_run(spark, run):
    root, tables = run
    report = {r.check_name: r.value for r in tables["dq_report"].collect()}
    assert report["staging_rejects"] == 6 and report["mart_kpi_group_count"] == 3
    assert report["raw_row_count"] == tables["stg_events"].count() + 9
    (record,) = run_log.read_runs(spark, f"{root}/run_history").collect()
    assert record.status == "success" and record.validation_summary["staging_rejects"] == 6


def test_evaluation_reaches_the_verdict(spark, run, tmp_path):
    root, _ = run
    stats = refresh.evaluate(spark, root, str(tmp_path)).first()
    pairs = {(p.arm_a, p.arm_b): p for p in stats.primary_metric.pairwise_tests}
    assert pairs[("A", "B")].z_statistic == -10.3565 and pairs[("B", "C")].z_statistic == -6.4118
    assert stats.power_recheck.achievable_mde_pp_at_80pct_power == 4.35
    assert stats.recommendation.guardrail_regression_count_C_vs_A == 1
    assert stats.recommendation.verdict == "SHIP WITH MITIGATION"
    assert pairs[("A", "B")].diff_ci_95 == [0.1269, 0.1851]
    assert "4.3 points" in stats.power_recheck.interpretation or "4.4 points" in stats.power_recheck.interpretation
    bundle = spark.read.json(f"{tmp_path}/dashboard")
    sections = {r.section: r["count"] for r in bundle.groupBy("section").count().collect()}
    assert sections["step_dropoff"] == 25 and sections["daily_funnel"] == 30 and sections["kpi_by_group"] == 3
    assert json.loads(bundle.filter("section = 'stats'").first().row)["srm_check"]["passes"] is True


def test_a_failed_run_is_recorded_and_not_published(spark, envelope, run, tmp_path):
    root = str(tmp_path)
    two_arms = [event(f"e{i}", f"u_{i % 4}", arm="ABC"[i % 3]) for i in range(12)]
    with pytest.raises(GateFailure, match="dim_user_duplicate_user_ids: value 4 violates policy"):
        refresh.refresh(envelope(two_arms), root)
    (record,) = run_log.read_runs(spark, f"{root}/run_history").collect()
    assert record.status == "failed_validation" and "dim_user_duplicate_user_ids" in record.error
    with pytest.raises(Exception):
        refresh.published(spark, root, "mart_kpi_by_group")


def test_staging_is_laid_out_by_date(spark, run):
    root, _ = run
    folder = refresh.latest_folder(spark, root)
    plan = spark.read.parquet(f"{folder}/stg_events").filter("event_date = DATE'2026-06-16'")
    assert "PartitionFilters: [isnotnull(event_date" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_landed_raw_layer_is_read_in_place(spark, envelope, tmp_path):
    rows = [event(f"{name}{i}", f"u_{i}", name, f"2026-06-15T10:0{at}:00", "ABC"[i % 3])
            for i in range(6) for at, name in enumerate(("app_installed", "onboarding_started"))]
    land(envelope(rows), "x").write.parquet(str(tmp_path / "raw"))
    tables = refresh.refresh(spark.read.parquet(str(tmp_path / "raw")), str(tmp_path / "out"), landed=True)
    assert tables["stg_events"].count() == 12
    assert not os.path.exists(f"{refresh.latest_folder(spark, str(tmp_path / 'out'))}/raw_events")


def test_user_tables_are_shuffled_by_user_once(spark, landed, tmp_path):
    rows = [event(f"{name}{i}", f"u_{i % 40}", name, f"2026-06-15T10:0{at}:00", "ABC"[i % 40 % 3])
            for i in range(60) for at, name in enumerate(("app_installed", "onboarding_started"))]
    root = str(tmp_path)
    rollup = warehouse.user_rollup(staging.stage(landed(rows)))
    users = write_bucketed(rollup, root, "users", "user_id", 4)
    members = write_bucketed(warehouse.dim_user(users), root, "dim_user", "user_id", 4)
    funnel = write_bucketed(warehouse.user_funnel(users), root, "funnel", "user_id", 4)
    assert all(sum(f.endswith(".parquet") for f in os.listdir(f"{root}/{name}")) <= 4 for name in ("users", "dim_user", "funnel"))
    dealt = write_bucketed(funnel.repartition(3), root, "dealt", "user_id", 4, deal=True)
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, funnel.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [warehouse.user_funnel(users), quality.orphan_users(funnel, members), quality.duplicate_keys(funnel, "user_id"),
                  warehouse.user_funnel(read_bucketed(spark, root, "users", "user_id", 4))]
        for frame in frames:
            assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
        assert [f.count() for f in frames] == [40, 0, 0, 40]
        # From events on: one exchange of partial sums, one that lays the few states out by user.
        plan = rollup._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(user_id#") == 2 and plan.count("hashpartitioning(event_id#") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plain = warehouse.user_funnel(rollup)
    assert sorted(map(repr, funnel.collect())) == sorted(map(repr, plain.collect()))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("layer_")]


def test_superseded_and_failed_runs_are_pruned(spark, envelope, tmp_path):
    root = str(tmp_path)
    good = envelope([event(f"{name}{i}", f"u_{i}", name, f"2026-06-15T10:0{at}:00", "ABC"[i % 3])
                     for i in range(3) for at, name in enumerate(("app_installed", "onboarding_started"))])
    for rows in (good, good.limit(0), good):
        try:
            refresh.refresh(rows, root)
        except GateFailure:
            pass
    runs = {r.run_id: r.status for r in run_log.read_runs(spark, f"{root}/run_history").collect()}
    latest = os.path.basename(refresh.latest_folder(spark, root))
    assert set(refresh.prune_runs(spark, root, keep=1)) == set(runs) - {latest}
    assert os.listdir(f"{root}/runs") == [latest]
    assert refresh.published(spark, root, "mart_kpi_by_group").count() == 3
    assert refresh.prune_runs(spark, root, keep=1) == []


def statuses(spark, root):
    runs = run_log.read_runs(spark, f"{root}/run_history").orderBy("started_at")
    return [(r.status, r.retries_used) for r in runs.collect()]


def test_files_in_published_marts_out(spark, envelope, tmp_path):
    root, events = str(tmp_path / "out"), str(tmp_path / "events")
    rows = [event(f"{name}{i}", f"u_{i}", name, f"2026-06-15T10:0{at}:00", "ABC"[i % 3])
            for i in range(6) for at, name in enumerate(("app_installed", "onboarding_started"))]
    write_events_csv(envelope(rows), events)
    design = tmp_path / "map.json"
    design.write_text(json.dumps({
        "all_steps_master_list": [{"step_number": 1, "step_name": "hello", "bucket": "must_have"}],
        "variants": {arm: {"label": arm, "step_names": ["hello"]} for arm in "ABC"},
    }))
    refresh.refresh_files(spark, events, root, str(design))
    assert refresh.published(spark, root, "dim_step").count() == 3
    assert {r.users_started for r in refresh.published(spark, root, "mart_kpi_by_group").collect()} == {2}

    with pytest.raises(Exception):
        refresh.refresh_files(spark, str(tmp_path / "nowhere"), root, retries_used=2)
    design.write_text(design.read_text().replace('"step_name": "hello"', '"step_name": "other"'))
    with pytest.raises(Exception, match="hello"):
        refresh.refresh_files(spark, events, root, str(design))
    half = tmp_path / "half.csv"
    half.write_text(",".join(ENVELOPE) + '\ne1,u,app_installed,t,A,iOS,s,"{\n')
    with pytest.raises(ValueError, match="half.csv"):
        refresh.refresh_files(spark, str(half), root, multi_line=True)
    assert statuses(spark, root) == [("success", 0), ("failed_fatal", 2), ("failed_fatal", 0), ("failed_fatal", 0)]
    assert refresh.published(spark, root, "dim_step").count() == 3


def test_an_unexpected_error_is_unclassified(spark, tmp_path):
    def source():
        raise OSError("disk on fire")

    with pytest.raises(OSError):
        refresh.refresh(source, str(tmp_path), spark=spark)
    assert statuses(spark, str(tmp_path)) == [("failed_unclassified", 0)]
