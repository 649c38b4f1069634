"""The recorded runs of ``refresh_history`` over small tables of events, against its statement."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from armlens.operators import quality
from armlens.plans import oracle, refresh, workload
from armlens.sources import event_table

COLUMNS = ("run", "status", "retries_used", "error", "raw_row_count", "staging_rejects")


@pytest.fixture
def events(spark, tmp_path):
    """A folder with an ``events`` table: rows dealt to the given users."""
    def make(users, rows=400):
        types = F.array(*map(F.lit, ("signup", "view", "click", "purchase", "error")))
        spark.range(rows).select(
            F.col("id").alias("event_id"),
            F.expr("timestamp_ntz'2026-03-01 08:00:00' + make_dt_interval(0, 0, CAST(id AS INT) * 7, 0)").alias("ts"),
            F.array(*map(F.lit, users))[(F.col("id") * 7 % len(users)).cast("int")].cast("bigint").alias("user_id"),
            types[(F.col("id") % 5).cast("int")].alias("event_type"), (F.col("id") % 9 + 0.5).cast("double").alias("value"),
            F.format_string('{"k": %d}', F.col("id") * 37 % 100).alias("props"),
        ).write.parquet(str(tmp_path / "events.parquet"))
        return str(tmp_path)
    return make


def recorded(spark, folder):
    """The recorded runs in order, after comparison with the statement."""
    rows = [tuple(r[c] for c in COLUMNS) for r in workload.registered()["refresh_history"](spark, folder).collect()]
    database = duckdb.connect()
    database.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    want = database.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracle.statements()['refresh_history']})").fetchall()
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    return sorted(rows, key=lambda r: r[0])


def test_a_run_under_the_full_policy_succeeds_beside_the_runs_over_the_events(spark, events, tmp_path):
    folder = events(range(30))
    first, second, third = recorded(spark, folder)
    assert first[1] == "failed_validation" and "users_missing_install_event" in first[3]
    assert second[:4] == (2, "success", 0, None) and second[4] == 408
    journeys = event_table.journey_rows(event_table.read_events_table(spark, folder))
    assert third == (3, "success", 0, None, journeys.count(), 0)
    _, values = refresh.build(journeys, str(tmp_path / "run"), workload.design(spark))
    assert not quality.violations(values, {**quality.POLICY, **quality.UNIQUE_POLICY}) and len(values) == 15


def test_every_run_may_fail_and_is_recorded(spark, events):
    runs = recorded(spark, events([uid for uid in range(30) if uid % 3 < 2]))
    assert [r[1] for r in runs] == ["failed_validation"] * 3
    assert all("mart_kpi_group_count: value 2 violates policy" in r[3] for r in runs)
    assert runs[1][3] == runs[2][3] == "mart_kpi_group_count: value 2 violates policy"


def test_the_last_run_is_held_to_checks_that_the_second_is_not(spark, events, monkeypatch):
    monkeypatch.setattr(event_table, "IN_JOURNEY", event_table.IN_JOURNEY.replace("WHEN 0 THEN TRUE", "WHEN 0 THEN FALSE"))
    _, second, third = recorded(spark, events(range(12)))
    assert second[1] == "success"
    assert third[1:4] == ("failed_validation", 0, "users_missing_install_event: value 12 violates policy")
