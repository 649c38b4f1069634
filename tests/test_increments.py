"""Increments against whole refreshes over the same rows."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from armlens.operators import quality
from armlens.operators.quality import GateFailure
from armlens.plans import increments, refresh
from armlens.sources import commits
from armlens.sources.landing import append_batches
from conftest import event

POLICY = {name: quality.POLICY[name] for name in ("raw_row_count", "staging_duplicate_event_ids", "orphan_fact_users")}
DAYS = [f"2026-06-{d:02}" for d in range(15, 20)]


def day_rows(day, seed=1, users=30):
    rng = random.Random(f"{day}{seed}")
    names = ("app_installed", "onboarding_started", "onboarding_completed", "first_lesson_started", "first_lesson_completed",
             "subscription_purchased", "account_created", "lesson_feedback_submitted", "onboarding_step_viewed",
             "onboarding_step_completed")
    rows = []
    for i in range(60):
        user, name = rng.randrange(users), rng.choice(names)
        props = {"account_created": {"signup_method": rng.choice(["email", "google"])},
                 "lesson_feedback_submitted": {"relevance_score": rng.randint(1, 5)},
                 "subscription_purchased": {"price_usd": rng.choice([5.0, 9.5])},
                 "onboarding_completed": {"steps_completed": rng.randint(1, 13)}}.get(name, {})
        if name.startswith("onboarding_step"):
            props = {"step_number": 1, "step_name": "welcome_goal", "step_bucket": "must_have"}
        rows.append(event(f"{day}-{i}", f"u_{user}", name, f"{day}T10:{rng.randrange(60):02}:00", "ABC"[user % 3], **props))
    return rows + [event(None, "u_1"), event(f"bad-{day}", "u_1", arm="Z")]


def files(root, name="stg_events"):
    folder = f"{root}/current/{name}"
    return {d: sorted(os.listdir(f"{folder}/{d}")) for d in os.listdir(folder) if "=" in d}


def rows_of(frame):
    return sorted(map(repr, frame.collect()))


def same_as_whole(spark, envelope, root, batches, tmp):
    parts = [envelope(b).withColumn("_ingest_seq", F.lit(i)) for i, b in enumerate(batches) if b]
    refresh.refresh(append_batches(*parts), tmp, policy=POLICY)
    for name in (*refresh.MARTS, "dim_user", "dim_date", "fact_user_funnel", "dq_report"):
        assert rows_of(increments.published(spark, root, name)) == rows_of(refresh.published(spark, tmp, name)), name
    columns = refresh.published(spark, tmp, "stg_events").columns
    assert rows_of(increments.published(spark, root, "stg_events").select(columns)) == rows_of(
        refresh.published(spark, tmp, "stg_events"))


def test_a_late_day_rewrites_its_date_alone(spark, envelope, tmp_path):
    root = str(tmp_path / "inc")
    batches = [[r for d in DAYS if d != DAYS[2] for r in day_rows(d)], day_rows(DAYS[2])]
    first = increments.apply_batch(envelope(batches[0]), root, policy=POLICY)
    assert first["number"] == 1 and first["dates"] == [d for d in DAYS if d != DAYS[2]]
    before = {name: files(root, name) for name in increments.BY_DATE}
    second = increments.apply_batch(envelope(batches[1]), root, policy=POLICY)
    assert second["dates"] == [DAYS[2]]
    for name, was in before.items():
        now = files(root, name)
        assert {d: now[d] for d in was} == was and set(now) - set(was) == {f"event_date={DAYS[2]}"}
    same_as_whole(spark, envelope, root, batches, str(tmp_path / "whole"))


def test_repeats_of_known_events_are_no_rows_of_the_batch(spark, envelope, tmp_path):
    root = str(tmp_path / "inc")
    again = [(r[0], "u_29", *r[2:]) for r in day_rows(DAYS[0])[:20]]  # known ids, other content
    moved = [(day_rows(DAYS[0])[30][0], *day_rows(DAYS[1], 2)[5][1:])]  # a known id with another date
    more = [(f"x{r[0]}", *r[1:]) for r in day_rows(DAYS[1], 3) if r[0]]
    batches = [[*day_rows(DAYS[0]), *day_rows(DAYS[1])], [*again, *moved, *more, *more[:7]], again, []]
    touched = []
    for batch in batches:
        touched.append(increments.apply_batch(envelope(batch), root, policy=POLICY)["dates"])
    assert touched == [DAYS[:2], [DAYS[1]], [], []]
    same_as_whole(spark, envelope, root, batches, str(tmp_path / "whole"))
    assert commits.commits(spark, root).count() == 4


def test_users_keep_their_numbers_and_days_without_steps_have_no_bitmaps(spark, envelope, tmp_path):
    root = str(tmp_path / "inc")
    plain = [event("p1", "u_90", at=f"{DAYS[0]}T10:00:00"), event("p2", "u_91", arm="B", at=f"{DAYS[0]}T10:00:00")]
    assert increments.apply_batch(envelope(plain), root, policy=POLICY)["new_users"] == 0
    batches = [plain, day_rows(DAYS[1], users=10), day_rows(DAYS[2], users=30)]
    sizes = []
    for batch in batches[1:]:
        sizes.append(increments.apply_batch(envelope(batch), root, policy=POLICY)["new_users"])
    numbers = increments.published(spark, root, "user_numbers").collect()
    assert sorted(r.number for r in numbers) == list(range(1, sum(sizes) + 1)) and len({r.user_id for r in numbers}) == sum(sizes)
    assert max(r.number for r in numbers if r._batch == 2) == sizes[0]
    assert set(files(root, "step_bitmaps")) == {f"event_date={d}" for d in DAYS[1:3]}
    same_as_whole(spark, envelope, root, batches, str(tmp_path / "whole"))


def test_a_run_lost_after_its_commit_is_finished_by_the_next(spark, envelope, tmp_path, monkeypatch):
    root = str(tmp_path / "inc")
    increments.apply_batch(envelope(day_rows(DAYS[0])), root, policy=POLICY)
    with monkeypatch.context() as patch:
        patch.setattr(increments, "overwrite_partitions", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            increments.apply_batch(envelope(day_rows(DAYS[1])), root, policy=POLICY)
    assert set(files(root)) == {f"event_date={DAYS[0]}"}
    increments.apply_batch(envelope(day_rows(DAYS[2])), root, policy=POLICY)
    same_as_whole(spark, envelope, root, [day_rows(d) for d in DAYS[:3]], str(tmp_path / "whole"))


def test_of_two_writers_one_is_refused(spark, envelope, tmp_path, monkeypatch):
    root = str(tmp_path / "inc")
    increments.apply_batch(envelope(day_rows(DAYS[0])), root, policy=POLICY)
    real, inside = increments.from_states, []

    def overtaken(*args):
        if not inside:
            inside.append(True)
            increments.apply_batch(envelope(day_rows(DAYS[2])), root, policy=POLICY)  # commits first
        return real(*args)

    monkeypatch.setattr(increments, "from_states", overtaken)
    with pytest.raises(commits.Conflict):
        increments.apply_batch(envelope(day_rows(DAYS[1])), root, policy=POLICY)
    assert set(files(root)) == {f"event_date={DAYS[0]}", f"event_date={DAYS[2]}"}
    same_as_whole(spark, envelope, root, [day_rows(DAYS[0]), day_rows(DAYS[2])], str(tmp_path / "whole"))


def test_a_refused_batch_changes_nothing(spark, envelope, tmp_path):
    root = str(tmp_path / "inc")
    increments.apply_batch(envelope(day_rows(DAYS[0])), root, policy=POLICY)
    before, marts = files(root), rows_of(increments.published(spark, root, "mart_kpi_by_group"))
    two_arms = [event("t1", "u_1", arm="A", at=f"{DAYS[3]}T10:00:00"), event("t2", "u_1", arm="C", at=f"{DAYS[3]}T10:00:00")]
    with pytest.raises(GateFailure, match="dim_user_duplicate_user_ids"):
        increments.apply_batch(envelope(two_arms), root, policy=POLICY)
    assert files(root) == before
    assert rows_of(increments.published(spark, root, "mart_kpi_by_group")) == marts
    with pytest.raises(LookupError):
        increments.published(spark, str(tmp_path / "none"), "dim_user")


def test_checks_are_counted_by_the_writing_jobs(spark, envelope, tmp_path):
    rows = [*day_rows(DAYS[0]), *day_rows(DAYS[1])]
    tables, values = refresh.build(envelope(rows), str(tmp_path / "run"), policy=POLICY)
    assert values["raw_row_count"] == len(rows) and values["staging_rejects"] == 4
    counted = quality.dq_report({
        "raw": tables["raw_events"], "staged": tables["stg_events"], "dim_user": tables["dim_user"],
        "user_funnel": tables["fact_user_funnel"], "kpi": tables["mart_kpi_by_group"]})
    assert {tuple(r) for r in counted.collect()} <= set(values.items())
    # The raw layer is sorted by verdict, so staging and quarantine each read their own part.
    assert {d for d in os.listdir(tmp_path / "run/raw_events") if "=" in d} == {"_verdict=valid", "_verdict=refused"}


def test_counts_of_no_rows(spark):
    frame, counts = quality.observed(spark.range(0), {"n": F.lit(True)})
    frame.write.format("noop").mode("overwrite").save()
    assert counts() == {"n": 0}
