"""The registered queries: each reads the given tables and runs one operator over all of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from armlens.domain import ENVELOPE, EVENT_CATALOG, KEYS, STEP_RANGE
from armlens.functions import payload
from armlens.operators import (
    assignment, inference, marts, monitoring, panels, quality, reach, staging, warehouse,
)
from armlens.plans import increments, refresh
from armlens.session import pin, scratch_path
from armlens.sources import designs, documents, event_table, events_csv, faults, landing, run_log
from armlens.sources.layers import read_layer, through_scratch, write_layer
from armlens.sources.local import local_frame
from armlens.streaming import landing as stream_landing

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; time columns are returned as text, flags as 0/1."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(function(pin(spark), folder))

    _QUERIES[function.__name__] = run
    return function


def plain(frame: DataFrame) -> DataFrame:
    columns = []
    for name, kind in frame.dtypes:
        column = F.col(name)
        if kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind == "boolean":
            column = column.cast("int")
        columns.append(column.alias(name))
    return frame.select(*columns)


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- tables the queries start from --------------------------------------------------------------

def landed(spark: SparkSession, folder: str) -> DataFrame:
    return event_table.landed_events(spark, folder)


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stage(landed(spark, folder))


def rollup(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.user_rollup(staged(spark, folder))


def funnel(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.user_funnel(rollup(spark, folder))


def kpi(spark: SparkSession, folder: str) -> DataFrame:
    return marts.kpi_by_group(funnel(spark, folder))


def guardrails(spark: SparkSession, folder: str) -> DataFrame:
    return marts.guardrails_by_group(funnel(spark, folder))


def design(spark: SparkSession) -> DataFrame:
    return designs.step_design(spark, event_table.ARM_STEPS, event_table.STEP_BUCKETS)


def written_marts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """KPI and guardrail columns by arm, written once, for queries that use both many times."""
    both = through_scratch(marts.metrics_by_group(funnel(spark, folder)), "metrics_by_group")
    return both, both


def quality_tables(spark: SparkSession, raw: DataFrame) -> dict[str, DataFrame]:
    events = through_scratch(staging.stage(raw), "staged")
    users = through_scratch(warehouse.user_rollup(events), "user_rollup")
    facts = warehouse.user_funnel(users)
    return {
        "raw": raw, "staged": events,
        "dim_user": warehouse.dim_user(users), "dim_date": warehouse.dim_date(events),
        "user_funnel": facts, "kpi": marts.kpi_by_group(facts),
    }


# ---- landing and staging ------------------------------------------------------------------------

@query
def landed_events(spark, folder):
    return landed(spark, folder).select(*ENVELOPE, "_source_file", "_ingest_seq")


@query
def valid_events(spark, folder):
    return landed(spark, folder).filter(staging.passes()).select(*ENVELOPE, "_ingest_seq")


@query
def staged_events(spark, folder):
    return staged(spark, folder)


def _with_codes(rejected: DataFrame) -> DataFrame:
    return rejected.select(
        *ENVELOPE, "_ingest_seq", "reject_reason", F.concat_ws(",", "reject_codes").alias("reject_codes")
    )


@query
def rejects(spark, folder):
    return _with_codes(staging.rejects(landed(spark, folder)))


@query
def rejects_strict_null(spark, folder):
    return _with_codes(staging.rejects(landed(spark, folder), strict_null=True))


@query
def staged_strict_null(spark, folder):
    return staging.stage(landed(spark, folder), strict_null=True)


@query
def dedup_events(spark, folder):
    rows = landed(spark, folder).filter(staging.passes())
    return staging.first_delivery(rows).select(*ENVELOPE, "_ingest_seq")


@query
def parsed_time(spark, folder):
    return staging.with_time(landed(spark, folder)).select(
        "event_id", "_ingest_seq", "event_timestamp", "event_date"
    )


@query
def flattened_props(spark, folder):
    return staging.flatten_properties(landed(spark, folder)).select(
        "event_id", "_ingest_seq", *payload.COLUMNS
    )


@query
def contract_violations(spark, folder):
    return staging.contract_violations(staged(spark, folder), EVENT_CATALOG, event_table.ARM_STEPS)


@query
def contract_violations_by_file(spark, folder):
    """The same findings with the catalogue read from its JSON file."""
    path = scratch_path(spark, "event_catalog")
    listed = local_frame(spark, list(EVENT_CATALOG.items()), "event_name string, keys array<string>")
    listed.coalesce(1).select(F.create_map("event_name", "keys").alias("event_catalog")).write.json(path)
    catalog = designs.read_event_catalog(spark, path, multi_line=False)
    return staging.contract_violations(staged(spark, folder), catalog, event_table.ARM_STEPS)


@query
def stage_reconciliation(spark, folder):
    raw = landed(spark, folder)
    return staging.reconciliation(raw, through_scratch(staging.stage(raw), "staged"))


# ---- warehouse ----------------------------------------------------------------------------------

@query
def dim_user(spark, folder):
    return warehouse.dim_user(rollup(spark, folder))


@query
def dim_date(spark, folder):
    return warehouse.dim_date(staged(spark, folder))


@query
def dim_step(spark, folder):
    """The design beside the number of step events that fall on each of its steps."""
    hits = (
        warehouse.step_events(staged(spark, folder))
        .groupBy("test_group", "step_number").agg(F.count(F.lit(1)).alias("step_events"))
    )
    return design(spark).join(hits, ["test_group", "step_number"], "left").fillna({"step_events": 0})


@query
def step_events(spark, folder):
    return warehouse.step_events(staged(spark, folder))


@query
def user_funnel(spark, folder):
    return funnel(spark, folder).withColumn("avg_relevance_score", F.round("avg_relevance_score", 6))


@query
def orphan_users(spark, folder):
    """Funnel rows of users who never installed."""
    users = through_scratch(rollup(spark, folder), "user_rollup")
    installed = warehouse.dim_user(users).filter(F.col("install_ts").isNotNull())
    return quality.orphan_users(warehouse.user_funnel(users), installed).select(
        "user_id", "test_group", "platform"
    )


# ---- marts --------------------------------------------------------------------------------------

@query
def mart_kpi_by_group(spark, folder):
    return kpi(spark, folder)


@query
def mart_guardrails_by_group(spark, folder):
    return guardrails(spark, folder)


@query
def mart_step_dropoff(spark, folder):
    return marts.step_dropoff(warehouse.step_events(staged(spark, folder)), design(spark))


def bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    states = through_scratch(
        marts.step_states(warehouse.step_events(staged(spark, folder)), "event_date"), "step_days")
    return reach.step_bitmaps(states, reach.number_users(states))


@query
def mart_step_dropoff_by_bitmaps(spark, folder):
    """The step mart from one bitmap per day, step and chunk of users."""
    return marts.counted_steps(reach.user_counts(bitmaps(spark, folder)), design(spark))


@query
def step_reach(spark, folder):
    return reach.step_reach(bitmaps(spark, folder))


@query
def mart_daily_funnel(spark, folder):
    return marts.daily_funnel(funnel(spark, folder))


# ---- quality ------------------------------------------------------------------------------------

@query
def dq_report(spark, folder):
    return quality.dq_report(quality_tables(spark, landed(spark, folder)))


@query
def dq_gate(spark, folder):
    return quality.dq_gate(quality.dq_report(quality_tables(spark, landed(spark, folder))))


@query
def dq_unique_keys(spark, folder):
    tables = quality_tables(spark, landed(spark, folder))
    return quality.unique_key_report(tables["dim_user"], tables["dim_date"], tables["user_funnel"])


@query
def dirty_injection(spark, folder):
    """The layers must still add up after bad rows and repeats are slipped in."""
    raw = faults.inject_dirty(landed(spark, folder))
    return staging.reconciliation(raw, through_scratch(staging.stage(raw), "staged"))


@query
def corrupt_arm_gate(spark, folder):
    """Every arm invalid: nothing is staged and the gate has to say so."""
    raw = faults.corrupt_arm(landed(spark, folder))
    return quality.dq_gate(quality.dq_report(quality_tables(spark, raw)))


# ---- statistics ---------------------------------------------------------------------------------

def _srm_figures(by_kpi: DataFrame) -> DataFrame:
    return inference.srm_check(by_kpi).select(
        F.array_join(F.transform(F.sort_array(F.map_entries("observed")), lambda e: F.concat(
            e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("observed"),
        "expected_per_arm", "chi2_statistic", "p_value", "passes",
    )


@query
def srm_check(spark, folder):
    return _srm_figures(kpi(spark, folder))


@query
def srm_missing_arm(spark, folder):
    """An arm that vanished has to fail the check."""
    return _srm_figures(kpi(spark, folder).filter(F.col("test_group") != "C"))


@query
def wilson_ci(spark, folder):
    return inference.completion_by_arm(kpi(spark, folder))


@query
def ztest_pairs(spark, folder):
    return inference.pairwise_tests(kpi(spark, folder)).select("arm_a", "arm_b", "label", "z_statistic")


@query
def ztest_pvalues(spark, folder):
    return inference.pairwise_tests(kpi(spark, folder)).select(
        "arm_a", "arm_b", F.round("p_value", 8).alias("p_value"),
        F.round(F.log10("p_value"), 6).alias("log10_p_value"),
    )


@query
def diff_ci(spark, folder):
    return inference.pairwise_tests(kpi(spark, folder)).select(
        "arm_a", "arm_b", "absolute_diff", "diff_ci_low", "diff_ci_high"
    )


@query
def lift(spark, folder):
    return inference.pairwise_tests(kpi(spark, folder)).select(
        "arm_a", "arm_b", "rate_a", "rate_b", "relative_lift_pct"
    )


@query
def significance(spark, folder):
    return inference.pairwise_tests(kpi(spark, folder)).select("arm_a", "arm_b", "significant_at_05")


@query
def secondary_metrics(spark, folder):
    return inference.secondary_metrics(kpi(spark, folder))


@query
def guardrail_metrics(spark, folder):
    return inference.guardrail_metrics(guardrails(spark, folder))


@query
def regression_flags(spark, folder):
    return inference.regression_flags(guardrails(spark, folder))


@query
def regression_flags_extended(spark, folder):
    by_kpi, by_guardrail = written_marts(spark, folder)
    return inference.regression_flags(by_guardrail, kpi=by_kpi)


@query
def power_recheck(spark, folder):
    return inference.power_recheck(kpi(spark, folder))


@query
def recommendation(spark, folder):
    by_kpi, by_guardrail = written_marts(spark, folder)
    return inference.recommendation(
        inference.srm_check(by_kpi), inference.pairwise_tests(by_kpi),
        inference.regression_flags(by_guardrail),
    )


@query
def required_sample_size(spark, folder):
    """Every arm's completion rate as the baseline, for effects of 1 to 10 points."""
    effects = F.explode(F.sequence(F.lit(1), F.lit(10))).alias("points")
    scenarios = kpi(spark, folder).select(
        "test_group", F.col("onboarding_completion_rate").alias("baseline"), effects
    ).withColumn("mde", F.col("points") / 100.0)
    return inference.required_sample_size(scenarios).drop("points")


def _projection(spark, folder) -> DataFrame:
    scenarios = kpi(spark, folder).select(
        F.col("test_group").alias("scenario"),
        F.lit(100000.0).alias("users"),
        F.col("onboarding_completion_rate").alias("completion_rate"),
        "paid_conversion_rate",
        F.lit(30.0).alias("arpu"),
    )
    return inference.revenue_projection(scenarios)


@query
def revenue_projection(spark, folder):
    return _projection(spark, folder)


@query
def revenue_delta(spark, folder):
    return inference.revenue_delta(_projection(spark, folder), "A", "B")


# ---- panels -------------------------------------------------------------------------------------

@query
def panel_completion(spark, folder):
    return panels.completion_panel(inference.completion_by_arm(kpi(spark, folder)))


@query
def panel_guardrails(spark, folder):
    return panels.guardrail_panel(guardrails(spark, folder))


@query
def panel_step_series(spark, folder):
    return panels.step_series(mart_step_dropoff(spark, folder))


@query
def panel_daily_trend(spark, folder):
    return panels.daily_trend(mart_daily_funnel(spark, folder))


@query
def panel_kpi_cards(spark, folder):
    by_kpi = through_scratch(kpi(spark, folder), "kpi")
    return panels.kpi_cards(inference.completion_by_arm(by_kpi), inference.srm_check(by_kpi))


# ---- assignment and run monitoring --------------------------------------------------------------

def _assigned(spark, folder) -> DataFrame:
    users = event_table.read_events_table(spark, folder).select("user_id").distinct()
    return assignment.assign_arms(users, "user_id")


@query
def assign_arms(spark, folder):
    return _assigned(spark, folder)


@query
def assign_arms_by_hash(spark, folder):
    """Users known by a text id; the arm and platform of each, and whether the slot fits the hash."""
    users = event_table.read_events_table(spark, folder).select(
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("user_id")).distinct()
    slot = F.pmod(F.xxhash64("user_id"), F.lit(6))
    return assignment.assign_arms_by_hash(users, "user_id").select(
        "user_id",
        (F.element_at(F.array(*map(F.lit, "ABC")), (slot % 3 + 1).cast("int")) == F.col("test_group")).alias("arm_fits"),
        (F.element_at(F.array(F.lit("iOS"), F.lit("Android")), (F.floor(slot / 3) + 1).cast("int"))
         == F.col("platform")).alias("platform_fits"),
    )


@query
def arm_balance(spark, folder):
    return assignment.arm_balance(_assigned(spark, folder))


def daily_runs(raw: DataFrame) -> DataFrame:
    """Run records derived from the events: a run per day, failed when over 5% was rejected."""
    bad = (~staging.valid_event()).cast("int")
    per_day = raw.groupBy(F.substring("event_timestamp", 1, 10).alias("day")).agg(
        F.min("event_timestamp").alias("started_at"),
        F.max("event_timestamp").alias("finished_at"),
        F.count(F.lit(1)).alias("n"),
        F.sum(bad).alias("rejected"),
    )
    failed = F.col("rejected") * 20 > F.col("n")
    summary = F.create_map(
        F.lit("raw_row_count"), F.col("n"), F.lit("staging_rejects"), F.col("rejected")
    )
    seconds = F.unix_timestamp(F.try_to_timestamp("finished_at")) - F.unix_timestamp(F.try_to_timestamp("started_at"))
    return per_day.select(
        F.concat(F.lit("run_"), "day").alias("run_id"),
        "started_at", "finished_at",
        seconds.cast("double").alias("duration_seconds"),
        F.when(failed, "failed_validation").otherwise("success").alias("status"),
        (F.col("n") % 3).cast("int").alias("retries_used"),
        F.when(~failed, summary).alias("validation_summary"),
        F.when(failed, F.concat(
            F.lit("staging_rejects: value "), F.col("rejected").cast("string"), F.lit(" violates policy")
        )).alias("error"),
    )


@query
def run_history_roundtrip(spark, folder):
    """Appended in two parts, read back as one history."""
    path = scratch_path(spark, "run_history")
    runs = daily_runs(landed(spark, folder))
    succeeded = F.col("status") == "success"
    run_log.append_run(runs.filter(succeeded), path)
    run_log.append_run(runs.filter(~succeeded), path)
    return run_log.read_runs(spark, path).select(
        "run_id", "started_at", "finished_at", "duration_seconds", "status", "retries_used",
        F.col("validation_summary")["raw_row_count"].alias("raw_row_count"),
        F.col("validation_summary")["staging_rejects"].alias("staging_rejects"),
        "error",
    )


@query
def run_health(spark, folder):
    return monitoring.run_health(daily_runs(landed(spark, folder)))


# ---- files --------------------------------------------------------------------------------------

@query
def csv_roundtrip(spark, folder):
    path = events_csv.write_events_csv(landed(spark, folder), scratch_path(spark, "events_csv"))
    read = events_csv.read_events_csv(spark, path)
    return landing.land(read).select(*ENVELOPE)


@query
def csv_raw_line_breaks(spark, folder):
    """Payloads with raw line breaks, written and read in splits."""
    broken = F.concat(F.translate("properties", ",", "\n"), F.lit("\n\n"))
    rows = landed(spark, folder).withColumn("properties", broken)
    path = events_csv.write_events_csv(rows, scratch_path(spark, "events_csv"))
    return landing.land(events_csv.read_events_csv(spark, path, multi_line=True)).select(*ENVELOPE)


@query
def streamed_landing(spark, folder):
    """Event files landed by a stream that is started twice; the second start finds nothing new."""
    root = scratch_path(spark, "stream")
    files = events_csv.write_events_csv(landed(spark, folder), f"{root}/events_csv")
    for _ in range(2):
        stream_landing.land_stream(stream_landing.events_stream(spark, files), root).awaitTermination()
    return read_layer(spark, root, "raw_events").select(*ENVELOPE)


@query
def layer_roundtrip(spark, folder):
    root = scratch_path(spark, "layers")
    table = write_layer(staged(spark, folder), root, "stg_events", partition_by="event_date")
    return table.select("event_id", "user_id", "event_name", "event_timestamp", "event_date", "step_number")


@query
def read_dim_step(spark, folder):
    """A step map drawn from the events, written as JSON and read as dim_step."""
    events = through_scratch(staged(spark, folder), "staged")
    master = (
        events.filter(
            (F.col("event_name") == "onboarding_step_viewed") & F.col("step_number").between(*STEP_RANGE)
        )
        .groupBy("step_number").agg(F.min("step_name").alias("step_name"), F.min("step_bucket").alias("bucket"))
    )
    length = events.groupBy("test_group").agg(F.max("total_steps_in_flow").alias("steps"))
    steps = F.sort_array(F.collect_list(F.struct("step_number", "step_name", "bucket")))
    whole = documents.side_by_side(
        master.agg(steps.alias("all_steps_master_list")),
        length.agg(F.map_from_entries(F.collect_list(F.struct("test_group", "steps"))).alias("lengths")),
    )
    names = F.col("all_steps_master_list")
    step_map = whole.select(
        "all_steps_master_list",
        F.transform_values("lengths", lambda arm, n: F.struct(
            arm.alias("label"),
            F.transform(F.slice(names, F.lit(1), n), lambda s: s["step_name"]).alias("step_names"),
        )).alias("variants"),
    )
    path = documents.write_document(step_map, scratch_path(spark, "stepmap"))
    return designs.read_dim_step(spark, path)


@query
def read_event_catalog(spark, folder):
    """The catalogue the events themselves follow, written as JSON, a property a line, and read back."""
    keys = (
        landed(spark, folder)
        .select("event_name", F.explode_outer(F.json_object_keys("properties")).alias("property"))
        .groupBy("event_name", "property").agg(F.count(F.lit(1)))
    )
    path = scratch_path(spark, "catalog")
    known = F.when(F.col("property").isNull(), F.array().cast("array<string>")).otherwise(F.array("property"))
    keys.select(F.create_map("event_name", known).alias("event_catalog")).write.json(path)
    return designs.read_event_catalog(spark, path, multi_line=False)


@query
def required_fields(spark, folder):
    """The required fields of a written catalogue, each with the rows that lack it."""
    path = scratch_path(spark, "required")
    required = (*KEYS, "test_group", "platform")
    local_frame(spark, [(list(required),)], "required_envelope_fields array<string>").write.json(path)
    raw = landed(spark, folder)
    lacking = raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).unpivot(
        [], list(required), "field", "rows_without")
    return designs.read_required_fields(spark, path).join(lacking, "field", "left")


@query
def export_bundle(spark, folder):
    """The bundle written and read back; position and main figure of every mart row in it."""
    events = through_scratch(staged(spark, folder), "staged")
    table = through_scratch(warehouse.user_funnel(warehouse.user_rollup(events)), "user_funnel")
    frames = {
        "kpi_by_group": marts.kpi_by_group(table),
        "guardrails_by_group": marts.guardrails_by_group(table),
        "step_dropoff": marts.step_dropoff(warehouse.step_events(events), design(spark)),
        "daily_funnel": marts.daily_funnel(table),
    }
    frames = {name: through_scratch(frame, name) for name, frame in frames.items()}
    stats = inference.results_document(frames["kpi_by_group"], frames["guardrails_by_group"])
    path = documents.export_bundle(frames, stats, scratch_path(spark, "bundle"))
    return bundle_figures(documents.read_bundle(spark, path))


def bundle_figures(rows: DataFrame) -> DataFrame:
    """Every field of every row of a bundle: section, label, field, and its value as number or text."""
    fields = rows.filter(F.col("section") != "stats").select(
        "section",
        F.array_join(F.map_values(F.from_json("sort_key", "map<string,string>")), "/", "-").alias("label"),
        F.explode(F.from_json("row", "map<string,string>")).alias("field", "shown"),
    )
    stats = rows.filter(F.col("section") == "stats").select(
        "section", F.lit("verdict").alias("label"), F.lit("verdict").alias("field"),
        F.get_json_object("row", "$.recommendation.verdict").alias("shown"),
    )
    number = F.col("shown").try_cast("double")
    return fields.unionByName(stats).select(
        "section", "label", "field", number.alias("value"),
        F.when(number.isNull(), F.col("shown")).alias("text"),
    )


@query
def results_document(spark, folder):
    """The statistics document written and read back, one row per figure."""
    by_kpi, by_guardrail = written_marts(spark, folder)
    document = inference.results_document(by_kpi, by_guardrail)
    path = documents.write_document(document, scratch_path(spark, "results"))
    return document_figures(spark.read.schema(document.schema).json(path))


def document_figures(read: DataFrame) -> DataFrame:
    """Every figure of a results document: section, name, value or text."""
    def leaves(at: str, kind: T.DataType) -> list[tuple[str, Column, bool]]:
        """(name, column, is it a number) of each field below a struct."""
        if isinstance(kind, T.StructType):
            return [(f"{f.name}/{name}".rstrip("/"), c, n) for f in kind for name, c, n in leaves(f"{at}.{f.name}", f.dataType)]
        if isinstance(kind, T.ArrayType):
            return [(str(i), F.col(at)[i], True) for i in (0, 1)]
        if isinstance(kind, T.StringType):
            return [("", F.col(at), False)]
        return [("", F.col(at), True)] if not isinstance(kind, T.MapType) else []

    def rows(section: str, frame: DataFrame, at: str, key: Column | None = None) -> DataFrame:
        figures = F.array(*[
            F.struct(F.lit(name).alias("name"), (F.round(c.cast("double"), 8) if number else F.lit(None).cast("double")).alias("value"),
                     (F.lit(None) if number else c).cast("string").alias("text"))
            for name, c, number in leaves(at, frame.schema[at].dataType)])
        named = frame.select((F.lit("") if key is None else F.concat(key, F.lit("/"))).alias("key"), F.explode(figures).alias("f"))
        return named.select(F.lit(section).alias("section"), F.concat("key", "f.name").alias("name"), "f.value", "f.text")

    def entries(column: str) -> DataFrame:
        return read.select(F.explode(column).alias("key", "at"))

    pairs = read.select(F.explode("primary_metric.pairwise_tests").alias("at"))
    flags = read.select(F.posexplode("guardrail_metrics.regression_flags_vs_control").alias("n", "message"))
    counts = read.select(F.explode("srm_check.observed").alias("arm", "n"))
    parts = [
        rows("srm", read, "srm_check"), rows("power", read, "power_recheck"), rows("verdict", read, "recommendation"),
        counts.select(F.lit("observed").alias("section"), F.col("arm").alias("name"), F.col("n").cast("double").alias("value"),
                      F.lit(None).cast("string").alias("text")),
        rows("pairwise", pairs, "at", F.concat_ws("_vs_", "at.arm_a", "at.arm_b")),
        flags.select(F.lit("flags").alias("section"), F.col("n").cast("string").alias("name"),
                     F.lit(None).cast("double").alias("value"), F.col("message").alias("text")),
    ] + [rows(section, entries(column), "at", F.col("key")) for section, column in (
        ("per_arm", "primary_metric.per_arm"), ("supporting", "recommendation.supporting_tests"),
        ("secondary", "secondary_metrics"), ("guardrail", "guardrail_metrics.by_arm"))]
    return reduce(lambda a, b: a.unionByName(b), parts)


#: Checks that hold of events in any order; the others are reported and not policed.
ORDERLESS = {name: quality.POLICY[name] for name in (
    "raw_row_count", "staging_duplicate_event_ids", "orphan_fact_users", "invalid_test_group_values",
    "mart_kpi_group_count")}


def _envelope(spark: SparkSession, folder: str) -> DataFrame:
    return event_table.envelope_rows(event_table.read_events_table(spark, folder))


def _refreshed(spark: SparkSession, folder: str, root: str) -> dict[str, DataFrame]:
    return refresh.refresh(
        _envelope(spark, folder), root, design=design(spark), source_file="events.parquet", policy=ORDERLESS)


def _whole_run(marts_of: dict[str, DataFrame], report: DataFrame) -> DataFrame:
    """Every field of the four marts and of the report."""
    values = report.select(
        F.lit("dq_report").alias("section"), F.col("check_name").alias("label"), F.lit("value").alias("field"),
        F.col("value").cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
    frames = {name.removeprefix("mart_"): frame for name, frame in marts_of.items()}
    return bundle_figures(documents.bundle_rows(frames)).unionByName(values)


@query
def full_refresh(spark, folder):
    """A whole run over the events as they are: the published marts and the report."""
    root = scratch_path(spark, "refresh")
    _refreshed(spark, folder, root)
    run = refresh.latest_folder(spark, root)
    return _whole_run({name: read_layer(spark, run, name) for name in refresh.MARTS}, read_layer(spark, run, "dq_report"))


@query
def refresh_history(spark, folder):
    """What is recorded of three runs: the events as they are under the full policy and under ``ORDERLESS``, and
    the journeys of all users, which are in order, under the full policy again."""
    root = scratch_path(spark, "refresh")
    journeys = event_table.journey_rows(event_table.read_events_table(spark, folder))
    events = _envelope(spark, folder)
    for rows, policy in ((events, quality.POLICY), (events, ORDERLESS), (journeys, quality.POLICY)):
        try:
            refresh.refresh(rows, root, design=design(spark), source_file="events.parquet", policy=policy)
        except quality.GateFailure:
            pass  # recorded, which is what is looked at
    runs = run_log.read_runs(spark, f"{root}/run_history").select(F.struct(
        "started_at", "run_id", "status", "retries_used", "error",
        F.col("validation_summary")["raw_row_count"].alias("raw_row_count"),
        F.col("validation_summary")["staging_rejects"].alias("staging_rejects"),
    ).alias("record"))
    # The runs follow each other, so their starts number them; one record a run is all there is.
    numbered = runs.agg(F.sort_array(F.collect_list("record")).alias("records")).select(
        F.posexplode("records").alias("at", "record"))
    return numbered.select(
        (F.col("at") + 1).alias("run"), "record.status", "record.retries_used", "record.error",
        "record.raw_row_count", "record.staging_rejects",
    )


def _late_day(spark: SparkSession, folder: str) -> tuple[str, dict]:
    """All events in two batches, those of the first day after all others; the root and the last commit."""
    root = scratch_path(spark, "increments")
    rows = _envelope(spark, folder)
    day = F.to_date(F.substring("event_timestamp", 1, 10))
    first = rows.filter(staging.passes()).agg(F.min(day)).first()[0]
    late = day == F.lit(first)
    for batch in (rows.filter(~F.coalesce(late, F.lit(False))), rows.filter(late)):
        commit = increments.apply_batch(batch, root, design(spark), "events.parquet", ORDERLESS)
    return root, commit


@query
def late_day_marts(spark, folder):
    """The marts and checks after a day that came late: as if all events had come at once."""
    root, _ = _late_day(spark, folder)
    run = increments.base(spark, root)["folder"]
    return _whole_run({name: read_layer(spark, run, name) for name in refresh.MARTS}, read_layer(spark, run, "dq_report"))


@query
def late_day_dates(spark, folder):
    """Staged events by date after a day that came late, and which dates the late batch has rewritten."""
    root, commit = _late_day(spark, folder)
    staged_days = increments.published(spark, root, "stg_events").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n_rows"))
    return staged_days.withColumn(
        "rewritten", F.col("event_date").cast("string").isin(commit["dates"]).cast("int"))
