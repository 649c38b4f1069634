"""Adapter from a generic ``events`` table to envelope rows.

The rules are plain SQL text, so the DuckDB check reads the very same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.domain import ENUMERATIONS, ENVELOPE, EVENT_CATALOG
from armlens.sources.landing import land

ARM_FLOW_LENGTH = {"A": 13, "B": 7, "C": 5}
STEP_NAMES = tuple(f"step_{n}" for n in range(1, 14))
ARM_STEPS = {arm: STEP_NAMES[:length] for arm, length in ARM_FLOW_LENGTH.items()}
BUCKET_BY_REMAINDER = ("must_have", "can_wait", "nice_to_have")
STEP_BUCKETS = {f"step_{n}": BUCKET_BY_REMAINDER[n % 3] for n in range(1, 14)}

# Over columns eid, uid, etype, value, k.
USER_ID = "CASE WHEN eid % 83 = 0 THEN NULL ELSE concat('u_', CAST(uid AS STRING)) END"
TEST_GROUP = (
    "CASE WHEN eid % 79 = 0 THEN NULL WHEN eid % 97 = 0 THEN 'Z' "
    "WHEN uid % 3 = 0 THEN 'A' WHEN uid % 3 = 1 THEN 'B' ELSE 'C' END"
)
PLATFORM = (
    "CASE WHEN eid % 89 = 0 THEN 'Windows' "
    "WHEN CAST(floor(uid / 3) AS BIGINT) % 2 = 0 THEN 'iOS' ELSE 'Android' END"
)
JOURNEY_ARM = "CASE uid % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END"
JOURNEY_PLATFORM = "CASE WHEN CAST(floor(uid / 3) AS BIGINT) % 2 = 0 THEN 'iOS' ELSE 'Android' END"
EVENT_NAME = """CASE etype
 WHEN 'signup' THEN CASE WHEN k < 40 THEN 'app_installed' WHEN k < 80 THEN 'onboarding_started'
  ELSE 'account_created' END
 WHEN 'view' THEN CASE WHEN k < 50 THEN 'onboarding_step_viewed'
  WHEN k < 85 THEN 'onboarding_step_completed' ELSE 'onboarding_step_abandoned' END
 WHEN 'click' THEN CASE WHEN k < 10 THEN 'onboarding_completed' WHEN k < 20 THEN 'first_lesson_started'
  WHEN k < 26 THEN 'first_lesson_completed' WHEN k < 31 THEN 'app_opened_day1'
  WHEN k < 35 THEN 'app_opened_day7' WHEN k < 38 THEN 'app_opened_day30'
  WHEN k < 58 THEN 'notification_permission_shown' WHEN k < 68 THEN 'notification_permission_accepted'
  WHEN k < 78 THEN 'notification_permission_denied' ELSE 'lesson_feedback_submitted' END
 WHEN 'purchase' THEN CASE WHEN k < 5 THEN 'subscription_purchased' WHEN k < 7 THEN 'refund_requested'
  WHEN k < 9 THEN 'subscription_cancelled' ELSE 'trial_started' END
 ELSE CASE WHEN k < 3 THEN 'support_ticket_created' WHEN k < 50 THEN 'app_crash' ELSE 'app_error' END
END"""


def _choice(index: str, options: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(options[:-1]))
    return f"CASE {index} {cases} ELSE '{options[-1]}' END"


def _allowed(index: str, column: str) -> str:
    return _choice(index, ENUMERATIONS[column][1])


_STEP = "CAST(k % 13 + 1 AS STRING)"
# Payload key -> its JSON value, with <marks> for what depends on the row.
_VALUES = {
    "device_platform": '"<platform>"',
    "total_steps_in_flow": "<flow>",
    "step_number": "<step>",
    "step_name": '"step_<step>"',
    "step_bucket": '"<bucket>"',
    "time_on_step_seconds": "<value>",
    "exit_reason": '"<exit>"',
    "total_time_seconds": "<value>",
    "steps_completed": "<k>",
    "signup_method": '"<signup>"',
    "lesson_id": '"lesson_<k>"',
    "score": "<k>",
    "days_since_install": "<k>",
    "trial_length_days": "<k>",
    "plan": '"<plan>"',
    "price_usd": "<price>",
    "days_since_purchase": "<k>",
    "reason": '"<reason>"',
    "error_code": '"E<k>"',
    "screen": '"<screen>"',
    "is_onboarding_related": "<related>",
    "category": '"<category>"',
    "relevance_score": "<relevance>",
}
_MARKS = {
    "platform": "platform",
    "flow": "CASE uid % 3 WHEN 0 THEN '13' WHEN 1 THEN '7' ELSE '5' END",
    "step": _STEP,
    "bucket": _choice("(k % 13 + 1) % 3", BUCKET_BY_REMAINDER),
    "value": "CAST(value AS STRING)",
    "exit": _allowed("k % 4", "exit_reason"),
    "k": "CAST(k AS STRING)",
    "signup": _allowed("k % 3", "signup_method"),
    "plan": _allowed("k % 2", "subscription_plan"),
    "price": _choice("k % 2", ("12.99", "89.99")),
    "reason": _allowed("k % 4", "refund_reason"),
    "screen": _choice("k % 4", ("start", "exercise", "profile", "store")),
    "related": _choice("k % 2", ("true", "false")),
    "category": _choice("k % 4", ("payments", "sign_in", "content", "device")),
    "relevance": "CAST(k % 5 + 1 AS STRING)",
}


def payload_sql(catalog: dict[str, tuple[str, ...]]) -> str:
    """SQL text for the JSON payload: the event's template with its marks replaced."""
    cases = []
    for event, keys in catalog.items():
        body = ", ".join(f'"{key}": {_VALUES[key]}' for key in keys)
        cases.append(f"WHEN '{event}' THEN '{{{body}}}'")
    text = "CASE event_name " + " ".join(cases) + " END"
    for mark, value in _MARKS.items():
        text = f"replace({text}, '<{mark}>', {value})"
    return text


def read_events_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def envelope_rows(events: DataFrame) -> DataFrame:
    """Envelope rows of an ``events`` table; every 50th event is delivered twice."""
    source = events.select(
        F.col("event_id").alias("eid"),
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("etype"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
    )
    named = source.select(
        "k", "uid", "value", "event_timestamp",
        F.col("eid").cast("string").alias("event_id"),
        F.expr(USER_ID).alias("user_id"),
        F.expr(EVENT_NAME).alias("event_name"),
        F.expr(TEST_GROUP).alias("test_group"),
        F.expr(PLATFORM).alias("platform"),
        F.expr("concat('s_', CAST(uid AS STRING))").alias("session_id"),
        (F.col("eid") % 50 == 0).alias("twice"),
    )
    # A delivery carries its row, so filters on the rows stay above the explode instead of being
    # rewritten into these rules and evaluating them once more per comparison. The payload comes
    # after it, which keeps each generated method short enough for the JIT compiler.
    kept = [c for c in named.columns if c != "twice"]
    deliveries = [F.struct(*kept, F.lit(n).alias("_ingest_seq")) for n in (0, 1)]
    delivered = named.select(F.explode(
        F.when(F.col("twice"), F.array(*deliveries)).otherwise(F.array(deliveries[0]))
    ).alias("row")).select("row.*")
    return delivered.select(
        *[c for c in ENVELOPE if c != "properties"],
        F.expr(payload_sql(EVENT_CATALOG)).alias("properties"),
        "_ingest_seq",
    )


# A journey in order, a user's rows: event, minutes after the first of their source rows, condition over
# uid. Every check of the policy holds for it.
_DONE, _LEARNT = "uid % 5 <> 0", "uid % 5 <> 0 AND uid % 7 <> 0"
JOURNEY = (
    ("app_installed", 0, "TRUE"),
    ("onboarding_started", 1, "TRUE"),
    ("account_created", 2, "uid % 11 <> 0"),
    ("onboarding_step_viewed", 3, "TRUE"),
    ("onboarding_step_completed", 4, "uid % 13 <> 0"),
    ("onboarding_step_abandoned", 5, "uid % 13 = 0"),
    ("notification_permission_shown", 6, "uid % 2 = 0"),
    ("notification_permission_accepted", 7, "uid % 4 = 0"),
    ("onboarding_completed", 9, _DONE),
    ("first_lesson_started", 12, _DONE),
    ("first_lesson_completed", 25, _LEARNT),
    ("lesson_feedback_submitted", 26, _LEARNT),
    ("subscription_purchased", 40, f"{_LEARNT} AND uid % 3 <> 1"),
    ("refund_requested", 90, f"{_LEARNT} AND uid % 6 = 2"),
    ("support_ticket_created", 95, "uid % 8 = 1"),
    ("app_opened_day1", 1450, f"{_DONE} AND uid % 3 <> 0"),
    ("app_opened_day7", 10100, f"{_DONE} AND uid % 4 <> 0"),
    ("app_opened_day30", 43300, f"{_DONE} AND uid % 9 = 1"),
)
IN_JOURNEY = "CASE leg " + " ".join(f"WHEN {i} THEN {c}" for i, (_, _, c) in enumerate(JOURNEY)) + " END"


def journey_rows(events: DataFrame) -> DataFrame:
    """Envelope rows of a well-ordered run derived from an ``events`` table, a journey per user."""
    users = events.groupBy(F.col("user_id").alias("uid")).agg(F.min("ts").alias("first"))
    stops = F.array(*[
        F.struct(F.lit(name).alias("event_name"), F.lit(minutes).alias("minutes"), F.lit(leg).alias("leg"))
        for leg, (name, minutes, _) in enumerate(JOURNEY)
    ])
    rows = users.select("uid", "first", F.explode(stops).alias("stop")).select("uid", "first", "stop.*").filter(
        F.expr(IN_JOURNEY))
    named = rows.select(
        "uid", "event_name", (F.col("uid") % 100).cast("int").alias("k"), (F.col("uid") % 50 + 0.5).cast("double").alias("value"),
        F.concat_ws("_", F.lit("j"), F.col("uid").cast("string"), F.col("leg").cast("string")).alias("event_id"),
        F.concat(F.lit("u_"), F.col("uid").cast("string")).alias("user_id"),
        F.date_format(F.expr("first + make_dt_interval(0, 0, minutes, 0)"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.expr(JOURNEY_ARM).alias("test_group"), F.expr(JOURNEY_PLATFORM).alias("platform"),
        F.expr("concat('s_', CAST(uid AS STRING))").alias("session_id"),
    )
    return named.select(*[c for c in ENVELOPE if c != "properties"], F.expr(payload_sql(EVENT_CATALOG)).alias("properties"))


def landed_events(spark: SparkSession, folder: str) -> DataFrame:
    """The raw layer over a test-data folder."""
    return land(envelope_rows(read_events_table(spark, folder)), source_file="events.parquet")
