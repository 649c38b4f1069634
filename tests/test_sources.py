from __future__ import annotations

import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from armlens.domain import ARM_STEPS, ARMS, ENVELOPE, EVENT_CATALOG, PLATFORMS, REQUIRED, STEP_BUCKETS
from armlens.operators import assignment, monitoring
from armlens.session import scratch_path, scratch_root
from armlens.sources import designs, documents, events_csv, run_log
from armlens.sources.landing import land
from armlens.sources.layers import read_layer, write_layer
from armlens.sources.local import local_frame
from conftest import as_dicts, event

NASTY = [
    event("e1", note='say "hi", then {go}'),
    event("e2", raw='{"a": "back\\\\slash", "b": "tab\\t"}'),
    event("e3", session=" padded ", note="ünïcode, ключ"),
    event("e4", user=None, session=None),
]


def test_csv_round_trip_keeps_every_character(spark, envelope, tmp_path):
    path = events_csv.write_events_csv(envelope(NASTY), str(tmp_path / "events"))
    back = events_csv.read_events_csv(spark, path)
    assert sorted(map(str, back.select(*ENVELOPE).collect())) == sorted(map(str, envelope(NASTY).collect()))
    landed = land(back, ingest_seq=3)
    row = landed.first()
    assert row._source_file.endswith(".csv") and row._ingest_seq == 3 and row._ingested_at is not None


def test_csv_written_elsewhere_with_doubled_quotes(spark, tmp_path):
    import csv

    path = tmp_path / "one.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(ENVELOPE)
        writer.writerows([[v if v is not None else "" for v in row] for row in NASTY])
        writer.writerow(event("e5", raw='{"text": "two\nlines"}'))
    back = events_csv.read_events_csv(spark, str(path), multi_line=True)
    got = {r.event_id: r.properties for r in back.collect()}
    assert got == {row[0]: row[7] for row in NASTY} | {"e5": '{"text": "two\nlines"}'}


def broken_payloads(n):
    """Payloads with line breaks of several kinds, blank lines, quotes and commas; some longer than a split."""
    rng = random.Random(n)
    pieces = ["\n", "\n\n", '"', '""', ",", "\r\n", "ключ", "a" * 40, "\n" * 7, " ", '",\n"']
    return [event(f"e{i}", user=None if i % 9 == 0 else f"u_{i}", session="" if i % 7 == 0 else "s",
                  raw="{" + "".join(rng.choices(pieces, k=300 if i % 41 == 0 else rng.randrange(8))) + "}")
            for i in range(n)]


@pytest.mark.parametrize("split", [97, 1_000, 1 << 27])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_raw_line_breaks_in_files_of_many_splits(spark, tmp_path, split, newline):
    import csv

    rows = broken_payloads(400)
    for name, part in (("one.csv", rows[:250]), ("two.csv", rows[250:]), ("none.csv", [])):
        with open(tmp_path / name, "w", newline="") as out:
            out.write("" if name == "one.csv" else newline)
            writer = csv.writer(out, lineterminator=newline)
            writer.writerow(ENVELOPE)
            writer.writerows([["" if v is None else v for v in row] for row in part])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        back = events_csv.read_events_csv(spark, str(tmp_path), multi_line=True)
        tasks = back.rdd.getNumPartitions()
        got = back.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == len(rows) and (tasks > 50 if split == 97 else True)
    assert {r.event_id: r.properties for r in got} == {row[0]: row[7] for row in rows}
    assert {r.event_id: r.user_id for r in got} == {row[0]: row[1] for row in rows}
    assert {r._source_file for r in got} == {"one.csv", "two.csv"}


def test_a_line_break_is_never_a_wrong_row_count(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text(",".join(ENVELOPE) + "\n" + 'e1,u,n,t,A,iOS,s,"{\n}"\n')
    assert events_csv.read_events_csv(spark, str(path), multi_line=True).count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        events_csv.read_events_csv(spark, str(path)).count()
    path.write_text(",".join(ENVELOPE) + "\n" + 'e1,u,n,t,A,iOS,s,"{\n}\n')
    with pytest.raises(ValueError, match="one.csv"):
        events_csv.read_events_csv(spark, str(path), multi_line=True)
    path.write_text(",".join(reversed(ENVELOPE)) + "\n" + ",".join("12345678") + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        events_csv.read_events_csv(spark, str(path), multi_line=True).collect()


def test_csv_with_other_column_order_is_refused(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text(",".join(reversed(ENVELOPE)) + "\n" + ",".join("12345678") + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        events_csv.read_events_csv(spark, str(path)).collect()


def test_csv_writer_turns_a_struct_payload_into_json(spark, tmp_path):
    rows = spark.range(2).select(
        *[F.lit(c).alias(c) for c in ENVELOPE if c != "properties"],
        F.struct(F.lit(3).alias("step_number"), F.lit('q"x').alias("step_name")).alias("properties"),
    )
    path = events_csv.write_events_csv(rows, str(tmp_path / "events"))
    assert {r.properties for r in events_csv.read_events_csv(spark, path).collect()} == {
        '{"step_number":3,"step_name":"q\\"x"}'}


def step_map(path, buckets=STEP_BUCKETS):
    path.write_text(json.dumps({
        "all_steps_master_list": [
            {"step_number": i, "step_name": s, "bucket": b, "base_abandon_rate": 0.1}
            for i, (s, b) in enumerate(buckets.items(), start=1)
        ],
        "variants": {arm: {"label": arm, "step_names": list(steps)} for arm, steps in ARM_STEPS.items()},
        "notes": "x",
    }, indent=2))
    return str(path)


def test_step_map_file_gives_the_same_rows_as_the_constants(spark, tmp_path):
    keys = ("test_group", "step_number")
    read = designs.read_dim_step(spark, step_map(tmp_path / "map.json"))
    assert as_dicts(read, *keys) == as_dicts(designs.step_design(spark), *keys)


def test_step_without_a_bucket_fails(spark, tmp_path):
    fewer = {s: b for s, b in STEP_BUCKETS.items() if s != "welcome_screen"}
    with pytest.raises(Exception, match="welcome_screen"):
        designs.read_dim_step(spark, step_map(tmp_path / "map.json", fewer)).collect()
    with pytest.raises(designs.DesignError, match="welcome_screen"):
        designs.step_design(spark, ARM_STEPS, fewer)


def test_event_catalog_file(spark, tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps({
        "envelope": {}, "event_catalog": {e: list(k) for e, k in EVENT_CATALOG.items()},
        "required_envelope_fields": list(REQUIRED),
    }))
    catalog = designs.read_event_catalog(spark, str(path))
    names = {}
    for row in catalog.collect():
        names.setdefault(row.event_name, []).extend([row.property] * (row.property is not None))
    assert {event: tuple(keys) for event, keys in names.items()} == EVENT_CATALOG
    assert [r.field for r in designs.read_required_fields(spark, str(path)).collect()] == list(REQUIRED)


def test_layer_partitioned_by_a_hot_date(spark, tmp_path):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").otherwise("cold").alias("day"))
    write_layer(rows, str(tmp_path), "t", partition_by="day")
    table = write_layer(rows, str(tmp_path), "t", partition_by="day")
    assert table.groupBy("day").count().orderBy("day").collect() == [("cold", 100), ("hot", 900)]
    assert read_layer(spark, str(tmp_path), "t").count() == 1000


class Session:
    """Stands in for a session with a given master and checkpoint setting."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")


def test_scratch_folder_is_the_shared_one(tmp_path):
    cluster = Session("spark://host:7077", f"{tmp_path}/")
    assert scratch_root(cluster) == str(tmp_path)
    assert scratch_path(cluster, "x") != scratch_path(cluster, "x")


def test_only_a_local_session_gets_a_folder_of_its_own():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session("yarn"))
    local = Session("local[2]")
    assert scratch_root(local) == scratch_root(local)


RUNS = [("success", 3.0), ("success", 5.0), ("failed_validation", 9.0)]


def history(spark, path, outcomes):
    from datetime import datetime, timedelta

    for i, (status, seconds) in enumerate(outcomes):
        start = datetime(2026, 7, 1) + timedelta(days=i)
        summary = {"raw_row_count": i} if status == "success" else None
        run_log.append_run(monitoring.run_record(
            spark, f"run_{i:02d}", start, start + timedelta(seconds=seconds), status, i,
            summary, None if summary else 'bad "data"'), path)
    return run_log.read_runs(spark, path)


def test_run_history_and_health(spark, tmp_path):
    runs = history(spark, str(tmp_path / "runs"), RUNS)
    last = runs.filter("run_id = 'run_02'").first()
    assert (last.duration_seconds, last.error, last.validation_summary, last.retries_used) == (9.0, 'bad "data"', None, 2)
    assert runs.filter("run_id = 'run_01'").first().validation_summary == {"raw_row_count": 1}
    health = monitoring.run_health(runs).first()
    assert tuple(health) == (3, 66.67, 4.0, "run_02", "failed_validation", 'bad "data"', 1)
    assert [r.run_id for r in monitoring.recent_runs(runs, 2).collect()] == ["run_02", "run_01"]


@pytest.mark.parametrize("outcomes, unhealthy", [
    ("s", 0), ("fs", 0), ("fffs", 0), ("ffsss", 1), ("fssss", 0), ("sssf", 1),
])
def test_health_rules(spark, tmp_path, outcomes, unhealthy):
    names = {"s": ("success", 1.0), "f": ("failed_fatal", 1.0)}
    runs = history(spark, str(tmp_path / "runs"), [names[o] for o in outcomes])
    assert monitoring.run_health(runs).first().unhealthy == unhealthy


def test_no_runs_no_health_and_unknown_status(spark):
    from datetime import datetime

    from armlens.domain import RUN_SCHEMA

    assert monitoring.run_health(local_frame(spark, [], RUN_SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        monitoring.run_record(spark, "x", datetime.now(), datetime.now(), "fine")


def test_bundle_is_written_row_by_row(spark, tmp_path):
    mart = spark.range(50).select(F.col("id").alias("test_group"))
    marts = {
        "kpi_by_group": mart, "guardrails_by_group": mart,
        "step_dropoff": mart.selectExpr("test_group", "1 AS step_number", "'x' AS step_name"),
        "daily_funnel": mart.selectExpr("CAST(NULL AS DATE) AS install_date", "test_group", "CAST(NULL AS DOUBLE) AS rate"),
    }
    stats = spark.range(1).select(F.lit("v").alias("verdict"))
    path = documents.export_bundle(marts, stats, str(tmp_path / "bundle"))
    rows = documents.read_bundle(spark, path).collect()
    assert len(rows) == 201
    kpi = sorted(json.loads(r.row)["test_group"] for r in rows if r.section == "kpi_by_group")
    assert kpi == list(range(50))
    daily = next(r for r in rows if r.section == "daily_funnel")
    assert set(json.loads(daily.row)) == {"install_date", "test_group", "rate"}
    assert json.loads(daily.sort_key)["install_date"] is None
    assert [json.loads(r.row) for r in rows if r.section == "stats"] == [{"verdict": "v"}]


def test_scratch_tables_can_be_cleared(spark, tmp_path):
    from armlens.session import clear_scratch, drop_path, scratch_path
    from armlens.sources.layers import through_scratch

    clear_scratch(spark)
    kept = through_scratch(spark.range(5), "numbers")
    assert kept.count() == 5
    scratch_path(spark, "never_written")
    assert clear_scratch(spark) == 1 and clear_scratch(spark) == 0
    assert drop_path(spark, str(tmp_path / "nothing")) is False


def test_assignment_is_balanced_by_index_and_close_by_hash(spark):
    users = spark.range(6000).withColumnRenamed("id", "i")
    got = assignment.assign_arms(users, "i")
    assert got.filter("i = 7").first().asDict() == {"i": 7, "test_group": "B", "platform": "iOS"}
    balance = as_dicts(assignment.arm_balance(got), "test_group")
    assert balance == [{"test_group": arm, "users_ios": 1000, "users_android": 1000} for arm in ARMS]
    named = users.select(F.format_string("u_%07d", "i").alias("user_id"))
    hashed = assignment.assign_arms_by_hash(named, "user_id")
    assert hashed.columns == ["user_id", "test_group", "platform"]
    for row in assignment.arm_balance(hashed).collect():
        assert 850 < row.users_ios < 1150 and 850 < row.users_android < 1150
    assert len(PLATFORMS) == 2
