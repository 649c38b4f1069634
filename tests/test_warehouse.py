from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from armlens.domain import ARM_STEPS, ARMS, EVENT_CATALOG, PLATFORMS
from armlens.operators import marts, quality, staging, warehouse
from armlens.sources.designs import step_design
from conftest import as_dicts, event

START = datetime(2026, 6, 15)


def at(seconds):
    return (START + timedelta(seconds=seconds)).isoformat()


def random_events(seed, n=600, users=25):
    """Events in no order, a third of them of one user, some users in two arms."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rng.random() < 0.34 else rng.randrange(users)
        arm = ARMS[user % 3] if user % 7 or rng.random() < 0.5 else rng.choice(ARMS)
        name = rng.choice(list(EVENT_CATALOG))
        props = {
            "steps_completed": rng.randrange(14), "price_usd": rng.choice([12.99, 89.99]),
            "relevance_score": rng.randint(1, 5), "signup_method": rng.choice(["email", "google", "apple"]),
            "step_number": rng.randint(1, 13), "step_name": f"step_{rng.randint(1, 3)}",
        }
        rows.append(event(f"e{i}", f"u_{user}", name, at(rng.randrange(3_000_000)), arm,
                          PLATFORMS[user % 2], **props))
    return rows


def by_hand(rows):
    """dim_user left join events, grouped: the definition, in plain Python."""
    import json

    groups = {}
    for row in rows:
        groups.setdefault((row[1], row[4], row[5]), []).append(row)
    out = {}
    for (user, arm, platform), own in groups.items():
        mine = [r for r in rows if r[1] == user]

        def has(name, of=mine):
            return int(any(r[2] == name for r in of))

        def times(name, of=mine):
            return [datetime.fromisoformat(r[3]) for r in of if r[2] == name]

        def values(name, key, of=mine):
            return [json.loads(r[7])[key] for r in of if r[2] == name]

        started, lesson = times("onboarding_started"), times("first_lesson_started")
        relevance = values("lesson_feedback_submitted", "relevance_score")
        installs = times("app_installed", own)
        out[(user, arm, platform)] = {
            "install_date": min(installs).date() if installs else None,
            "account_created_flag": has("account_created", own),
            "signup_method": max(values("account_created", "signup_method", own), default=None),
            **{column: has(name) for column, name in warehouse.FUNNEL_FLAGS.items()},
            "steps_completed": max(values("onboarding_completed", "steps_completed"), default=None),
            "price_usd": max(values("subscription_purchased", "price_usd"), default=None),
            "avg_relevance_score": round(sum(relevance) / len(relevance), 9) if relevance else None,
            "time_to_first_lesson_seconds":
                int((min(lesson) - min(started)).total_seconds()) if lesson and started else None,
        }
    return out


def test_user_tables_equal_join_then_group(landed):
    for seed in (1, 2):
        rows = random_events(seed)
        rollup = warehouse.user_rollup(staging.stage(landed(rows))).cache()
        users = {(r.user_id, r.test_group, r.platform): r for r in warehouse.dim_user(rollup).collect()}
        funnel = {(r.user_id, r.test_group, r.platform): r for r in warehouse.user_funnel(rollup).collect()}
        expected = by_hand(rows)
        assert set(users) == set(funnel) == set(expected)
        assert len({k[0] for k in expected}) < len(expected)
        for key, want in expected.items():
            got = {**funnel[key].asDict(), "signup_method": users[key].signup_method}
            if got["avg_relevance_score"] is not None:
                got["avg_relevance_score"] = round(got["avg_relevance_score"], 9)
            assert {c: got[c] for c in want} == want, key
            assert users[key].install_date == want["install_date"]
        rollup.unpersist()


def test_rollup_needs_no_third_shuffle_for_the_funnel(landed):
    funnel = warehouse.user_funnel(warehouse.user_rollup(staging.stage(landed(random_events(3)))))
    plan = funnel._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 2
    assert "SortAggregate" not in plan[plan.index("REPARTITION_BY_COL"):]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dim_date_fills_gaps_and_knows_weekends(landed):
    staged = staging.stage(landed([event("a", at="2026-06-19T10:00:00"), event("b", at="2026-06-22T01:00:00")]))
    got = [(r.date_key, r.year, r.month, r.day, r.day_of_week, r.is_weekend)
           for r in warehouse.dim_date(staged).orderBy("date_key").collect()]
    assert got == [
        (date(2026, 6, 19), 2026, 6, 19, 5, 0), (date(2026, 6, 20), 2026, 6, 20, 6, 1),
        (date(2026, 6, 21), 2026, 6, 21, 0, 1), (date(2026, 6, 22), 2026, 6, 22, 1, 0),
    ]
    assert warehouse.dim_date(staged.filter("false")).count() == 0


def test_dim_step_is_the_arm_position(spark):
    rows = as_dicts(step_design(spark))
    assert len(rows) == 25
    assert {r["test_group"]: sum(x["test_group"] == r["test_group"] for x in rows) for r in rows} == {
        "A": 13, "B": 7, "C": 5}
    assert {"test_group": "C", "step_number": 1, "step_name": "select_native_language",
            "step_bucket": "must_have"} in rows


def test_step_dropoff_equals_distinct_counts(spark, landed):
    facts = warehouse.step_events(staging.stage(landed(random_events(5, 900)))).cache()
    design = step_design(spark)
    got = marts.step_dropoff(facts, design)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    direct = facts.join(design.drop("step_name"), ["test_group", "step_number"]).drop("facts.step_bucket")

    def users(kind):
        return F.countDistinct(F.when(F.col("step_event_type") == kind, F.col("user_id")))

    naive = direct.groupBy("test_group", "step_number", "step_name").agg(
        users("onboarding_step_viewed").alias("users_viewed"),
        users("onboarding_step_completed").alias("users_completed"),
        users("onboarding_step_abandoned").alias("users_abandoned"),
    )
    keys = ("test_group", "step_number", "step_name")
    assert as_dicts(got.select(*naive.columns), *keys) == as_dicts(naive, *keys)
    assert got.filter("test_group = 'C' and step_number > 5").count() == 0
    facts.unpersist()


def test_kpi_and_guardrails_by_hand(landed):
    names = ["app_installed", "onboarding_started", "onboarding_completed", "first_lesson_started",
             "first_lesson_completed", "subscription_purchased", "refund_requested",
             "notification_permission_shown"]
    rows = [event(f"x{i}", "u_1", n, at(60 * i)) for i, n in enumerate(names)]
    rows += [event("y0", "u_2", "app_installed", at(5)), event("y1", "u_2", "onboarding_started", at(6)),
             event("y2", "u_2", "onboarding_completed", at(9)), event("y3", "u_2", "support_ticket_created", at(10))]
    rows += [event("f1", "u_1", "lesson_feedback_submitted", at(700), relevance_score=2),
             event("f2", "u_1", "lesson_feedback_submitted", at(701), relevance_score=3),
             event("f3", "u_2", "lesson_feedback_submitted", at(701), relevance_score=5)]
    funnel = warehouse.user_funnel(warehouse.user_rollup(staging.stage(landed(rows))))
    kpi = as_dicts(marts.kpi_by_group(funnel))[0]
    assert kpi == {
        "test_group": "A", "users_started": 2, "users_completed": 2, "onboarding_completion_rate": 1.0,
        "users_activated": 1, "activation_rate": 0.5, "users_purchased": 1, "paid_conversion_rate": 1.0,
        "avg_time_to_first_lesson_seconds": 120.0, "day1_return_rate": 0.0, "day7_return_rate": 0.0,
        "day30_return_rate": 0.0,
    }
    guard = as_dicts(marts.guardrails_by_group(funnel))[0]
    assert guard == {
        "test_group": "A", "avg_lesson_relevance_score": 3.75, "refund_rate": 1.0, "cancellation_rate": 0.0,
        "support_ticket_rate": 0.5, "notification_optin_rate": 0.0,
    }
    daily = as_dicts(marts.daily_funnel(funnel))
    assert daily == [{"install_date": date(2026, 6, 15), "test_group": "A", "users_started": 2,
                      "users_completed": 2, "onboarding_completion_rate": 1.0}]


def test_ratio_without_denominator_is_null(landed):
    funnel = warehouse.user_funnel(warehouse.user_rollup(staging.stage(landed([event("a")]))))
    row = marts.kpi_by_group(funnel).first()
    assert row.activation_rate is None and row.onboarding_completion_rate == 0.0
    assert marts.guardrails_by_group(funnel).first().refund_rate is None


def test_unique_keys_and_orphans(landed):
    rows = [event("a", "u_1"), event("b", "u_1", arm="B"), event("c", "u_2")]
    staged = staging.stage(landed(rows))
    rollup = warehouse.user_rollup(staged)
    users, funnel = warehouse.dim_user(rollup), warehouse.user_funnel(rollup)
    report = {r.check_name: r.value for r in quality.unique_key_report(
        users, warehouse.dim_date(staged), funnel).collect()}
    assert report == {"dim_user_duplicate_user_ids": 1, "dim_date_duplicate_date_keys": 0,
                      "fact_user_funnel_duplicate_user_ids": 1}
    assert [r.user_id for r in quality.orphan_users(funnel, users.filter("user_id = 'u_1'")).collect()] == ["u_2"]
    assert [tuple(r) for r in quality.duplicate_keys(users, "user_id").collect()] == [("u_1", 2)]
    assert list(ARM_STEPS) == ["A", "B", "C"]
