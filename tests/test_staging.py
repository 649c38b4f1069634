from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from armlens.domain import ARM_STEPS, EVENT_CATALOG
from armlens.operators import staging
from armlens.sources.faults import corrupt_arm, inject_dirty
from armlens.sources.landing import append_batches, land
from conftest import as_dicts, event

BAD = [
    (event(None), "null_event_id"),
    (event("b1", user=None), "null_user_id"),
    (event("b2", name=None), "null_event_name"),
    (event("b3", at=None), "null_event_timestamp"),
    (event("b4", arm="Z"), "bad_test_group"),
    (event("b5", platform="Windows"), "bad_platform"),
    (event("b6", arm=None), "bad_test_group"),
    (event("b7", platform=None), "bad_platform"),
    (event("b8", at="zzz"), "bad_timestamp"),
    (event("b9", user=""), "null_user_id"),
]


def test_every_bad_row_is_quarantined_with_its_code(landed):
    raw = landed([event("ok"), *[row for row, _ in BAD]])
    got = as_dicts(staging.rejects(raw).select("event_id", "reject_reason", "reject_codes"))
    assert {(r["event_id"], *r["reject_codes"]) for r in got} == {(row[0], code) for row, code in BAD}
    assert {r["reject_reason"] for r in got} == {"null_or_invalid_key"}
    assert [r.event_id for r in staging.stage(raw).collect()] == ["ok"]


def test_strict_null_lets_unknown_arms_vanish_and_keeps_odd_times(landed):
    raw = landed([event("ok"), *[row for row, _ in BAD]])
    rejected = {r.event_id for r in staging.rejects(raw, strict_null=True).collect()}
    staged = {r.event_id for r in staging.stage(raw, strict_null=True).collect()}
    assert rejected == {None, "b1", "b2", "b3", "b4", "b5"}
    assert staged == {"ok", "b8", "b9"}


def test_first_delivery_wins_by_time_then_batch(spark, envelope):
    first = land(envelope([event("e1", session="first"), event("e2")]), "a.csv", ingest_seq=0)
    again = land(envelope([event("e1", session="again")]), "b.csv", ingest_seq=1)
    late = again.withColumn("_ingested_at", F.expr("_ingested_at - INTERVAL 1 DAY"))
    assert {(r.event_id, r.session_id) for r in staging.stage(append_batches(first, again)).collect()} == {
        ("e1", "first"), ("e2", "s1")}
    assert {r.session_id for r in staging.stage(append_batches(first, late)).collect()} == {"again", "s1"}


def test_identical_ties_are_settled_the_same_way_every_time(landed):
    rows = [event("e1", session=f"s{i}") for i in range(50)]
    picks = {staging.stage(landed(order)).first().session_id for order in (rows, rows[::-1])}
    assert len(picks) == 1


def test_time_is_utc_and_cut_to_the_second(landed):
    raw = landed([
        event("e1", at="2026-06-15T23:30:00-05:00"),
        event("e2", at="2026-06-15T01:02:03.999999+00:00"),
        event("e3", at="2026-07-01T00:00:00"),
    ])
    got = {r.event_id: (r.event_timestamp, r.event_date) for r in staging.stage(raw).select(
        "event_id", F.col("event_timestamp").cast("string").alias("event_timestamp"), "event_date").collect()}
    assert got == {
        "e1": ("2026-06-16 04:30:00", date(2026, 6, 16)),
        "e2": ("2026-06-15 01:02:03", date(2026, 6, 15)),
        "e3": ("2026-07-01 00:00:00", date(2026, 7, 1)),
    }


def test_payload_types(landed):
    raw = landed([
        event("e1", step_number="3", price_usd=12, score=71.9, is_onboarding_related=True, plan="annual",
              reason="other", category="x", relevance_score=4),
        event("e2", step_number="abc", is_onboarding_related=False),
        event("e3", raw="{bad"),
        event("e4", raw=None),
        event("e5", raw='{"step_name": "a\\"b, c", "time_on_step_seconds": 1.5e1}'),
    ])
    got = {r.event_id: r for r in staging.stage(raw).collect()}
    e1 = got["e1"]
    assert (e1.step_number, e1.price_usd, e1.lesson_score, e1.is_onboarding_related) == (3, 12.0, 71, 1)
    assert (e1.subscription_plan, e1.refund_reason, e1.ticket_category, e1.relevance_score) == ("annual", "other", "x", 4.0)
    assert (got["e2"].step_number, got["e2"].is_onboarding_related) == (None, 0)
    assert got["e3"].step_number is None and got["e3"].properties == "{bad"
    assert got["e4"].properties is None
    assert (got["e5"].step_name, got["e5"].time_on_step_seconds) == ('a"b, c', 15.0)


def test_the_catalogue_may_be_a_table(spark, landed):
    rows = [event("e1", name="app_installed", device_platform="iOS"), event("e2", name="app_installed", other=1),
            event("e3", name="unheard_of"), event("e4", name="notification_permission_shown"), event("e5", name="app_crash", raw="{")]
    staged = staging.stage(landed(rows))
    keys = [(name, key) for name, known in EVENT_CATALOG.items() for key in (known or (None,))]
    catalog = spark.createDataFrame([*keys, *keys[:5], (None, "x")], "event_name string, property string")
    want = sorted(map(tuple, staging.contract_violations(staged).collect()))
    assert sorted(map(tuple, staging.contract_violations(staged, catalog).collect())) == want and len(want) >= 4
    for size, join in ((staging.CATALOG_BYTES, "BroadcastHashJoin"), (10, "SortMergeJoin")):
        plan = staging.with_expected(staged, catalog, size)._jdf.queryExecution().executedPlan().toString()
        assert join in plan
    none = staging.contract_violations(staged, catalog.filter("false"))
    assert {r["code"] for r in none.collect()} >= {"unknown_event"}


def test_contract_violations_name_each_finding(landed):
    raw = landed([
        event("fine", name="onboarding_step_viewed", step_number=1, step_name="welcome_screen", step_bucket="x"),
        event("unknown", name="teleported"),
        event("json", name="trial_started", raw="{bad"),
        event("keys", name="account_created", method="email"),
        event("none", name="trial_started", raw=None),
        event("step", name="onboarding_step_completed", step_number=14, step_name="x", time_on_step_seconds=1),
        event("score", name="lesson_feedback_submitted", relevance_score=6),
        event("exit", name="onboarding_step_abandoned", step_number=2, step_name="select_learning_goal", exit_reason="bored"),
        event("plan", name="subscription_purchased", plan="weekly", price_usd=1),
        event("reason", name="refund_requested", days_since_purchase=1, reason="mood"),
        event("design", name="onboarding_step_viewed", arm="C", step_number=6, step_name="x", step_bucket="y"),
        event("name", name="onboarding_step_viewed", arm="C", step_number=1, step_name="welcome_screen", step_bucket="y"),
        event("empty", name="notification_permission_shown"),
    ])
    found = staging.contract_violations(staging.stage(raw), design=ARM_STEPS)
    assert {(r.event_id, r.code, r.detail) for r in found.collect()} == {
        ("unknown", "unknown_event", "teleported"),
        ("json", "bad_json", "{bad"),
        ("keys", "missing_key", "signup_method"), ("keys", "extra_key", "method"),
        ("keys", "bad_signup_method", None),
        ("none", "missing_key", "trial_length_days"),
        ("step", "bad_step_number", "14"),
        ("score", "bad_relevance_score", "6.0"),
        ("exit", "bad_exit_reason", "bored"),
        ("plan", "bad_subscription_plan", "weekly"),
        ("reason", "bad_refund_reason", "mood"),
        ("design", "step_outside_design", "6"),
        ("name", "step_name_mismatch", "welcome_screen"),
    }


def test_layers_add_up_after_dirty_injection(landed):
    raw = landed([event(f"e{i}") for i in range(20)])
    dirty = inject_dirty(raw)
    row = staging.reconciliation(dirty, staging.stage(dirty)).first()
    assert staging.rejects(dirty).count() == 6
    assert (row.landed, row.staged, row.rejected, row.duplicates, row.balanced) == (29, 20, 6, 3, 1)
    assert dirty.filter("_source_file = 'dirty_injection_dup'").count() == 3
    none = staging.reconciliation(raw.limit(0), staging.stage(raw.limit(0))).first()
    assert (none.landed, none.staged, none.rejected, none.duplicates, none.balanced) == (0, 0, 0, 0, 1)


def test_corrupt_arm_spoils_all_rows(landed):
    raw = landed([event(f"e{i}") for i in range(20)])
    assert corrupt_arm(raw).count() == 20
    assert staging.stage(corrupt_arm(raw)).count() == 0


def test_strict_null_refuses_fewer_rows(landed):
    raw = landed([event("a"), event("b", arm=None), event("c", arm="Z"), event(None), event("d", at="zzz")])
    counted = raw.agg(F.count_if(staging.refused()).alias("default"), F.count_if(staging.refused(True)).alias("strict")).first()
    assert (counted.default, counted.strict) == (4, 2)
    assert staging.rejects(raw, strict_null=True).count() == 2


def test_a_hot_id_is_cut_down_before_the_shuffle(spark):
    from armlens.domain import ENVELOPE

    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_id"),
        F.lit("u").alias("user_id"), F.lit("app_installed").alias("event_name"),
        F.lit("2026-06-15T10:00:00").alias("event_timestamp"), F.lit("A").alias("test_group"),
        F.lit("iOS").alias("platform"), F.col("id").cast("string").alias("session_id"),
        F.lit("{}").alias("properties"),
    ).select(*ENVELOPE, F.col("session_id").cast("int").alias("_ingest_seq"))
    staged = staging.stage(land(rows, "x"))
    assert staged.count() == 20_001
    assert staged.filter("event_id = 'hot'").first().session_id == "0"
    plan = staged._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(event_id")
    assert "WindowGroupLimit" in plan[exchange:]
