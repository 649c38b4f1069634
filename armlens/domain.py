"""What the experiment is made of: envelope, arms, catalogue, step design, constants."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import types as T

# Event envelope, arm and platform domains.
ENVELOPE = (
    "event_id", "user_id", "event_name", "event_timestamp",
    "test_group", "platform", "session_id", "properties",
)
REQUIRED = ("event_id", "user_id", "event_name", "event_timestamp", "test_group", "platform")
KEYS = ("event_id", "user_id", "event_name", "event_timestamp")
ARMS = ("A", "B", "C")
PLATFORMS = ("iOS", "Android")
CONTROL, MODERATE, TREATMENT = "A", "B", "C"
PAIRS = tuple(combinations(ARMS, 2))

# Arm labels.
ARM_LABELS = {"A": "Control (13 steps)", "B": "Medium (7 steps)", "C": "Short (5 steps)"}
ARM_SHORT_LABELS = {"A": "A (Control)", "B": "B (Medium)", "C": "C (Short)"}

# Event name -> payload keys.
EVENT_CATALOG = {
    "app_installed": ("device_platform",),
    "onboarding_started": ("total_steps_in_flow",),
    "onboarding_step_viewed": ("step_number", "step_name", "step_bucket"),
    "onboarding_step_completed": ("step_number", "step_name", "time_on_step_seconds"),
    "onboarding_step_abandoned": ("step_number", "step_name", "exit_reason"),
    "onboarding_completed": ("total_time_seconds", "steps_completed"),
    "account_created": ("signup_method",),
    "first_lesson_started": ("lesson_id",),
    "first_lesson_completed": ("lesson_id", "score"),
    "app_opened_day1": ("days_since_install",),
    "app_opened_day7": ("days_since_install",),
    "app_opened_day30": ("days_since_install",),
    "notification_permission_shown": (),
    "notification_permission_accepted": (),
    "notification_permission_denied": (),
    "trial_started": ("trial_length_days",),
    "subscription_purchased": ("plan", "price_usd"),
    "subscription_cancelled": ("days_since_purchase",),
    "refund_requested": ("days_since_purchase", "reason"),
    "app_crash": ("error_code", "screen"),
    "app_error": ("error_code", "screen"),
    "support_ticket_created": ("is_onboarding_related", "category"),
    "lesson_feedback_submitted": ("relevance_score",),
}

STEP_EVENTS = ("onboarding_step_viewed", "onboarding_step_completed", "onboarding_step_abandoned")

# Staged column -> (event it belongs to, allowed values).
ENUMERATIONS = {
    "exit_reason": ("onboarding_step_abandoned", ("closed_app", "backgrounded", "timeout", "unknown")),
    "signup_method": ("account_created", ("email", "google", "apple")),
    "subscription_plan": ("subscription_purchased", ("monthly", "annual")),
    "refund_reason": (
        "refund_requested",
        ("not_as_expected", "too_expensive", "found_free_alternative", "other"),
    ),
}
STEP_RANGE = (1, 13)
RELEVANCE_RANGE = (1, 5)

# The step design of this experiment, name -> bucket, and the order per arm.
STEP_BUCKETS = {
    "welcome_screen": "nice_to_have",
    "select_learning_goal": "can_wait",
    "select_native_language": "must_have",
    "account_creation_email": "must_have",
    "account_creation_password": "must_have",
    "level_assessment_intro": "nice_to_have",
    "level_assessment_quiz": "must_have",
    "personalization_interests": "can_wait",
    "personalization_schedule": "can_wait",
    "notification_permission": "can_wait",
    "referral_source_survey": "nice_to_have",
    "tutorial_walkthrough": "nice_to_have",
    "terms_and_privacy_confirmation": "must_have",
}
ARM_STEPS = {
    "A": tuple(STEP_BUCKETS),
    "B": (
        "select_native_language", "account_creation_email", "account_creation_password",
        "select_learning_goal", "level_assessment_quiz", "notification_permission",
        "terms_and_privacy_confirmation",
    ),
    "C": (
        "select_native_language", "account_creation_email", "account_creation_password",
        "level_assessment_quiz", "terms_and_privacy_confirmation",
    ),
}

# Significance, power and the matching normal quantiles.
ALPHA = 0.05
POWER = 0.80
Z_ALPHA = 1.959963984540054
Z_POWER = 0.8416212335729143
SRM_THRESHOLD = 0.001

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ENVELOPE])

STEPMAP_SCHEMA = T.StructType([
    T.StructField("all_steps_master_list", T.ArrayType(T.StructType([
        T.StructField("step_number", T.IntegerType()),
        T.StructField("step_name", T.StringType()),
        T.StructField("bucket", T.StringType()),
    ]))),
    T.StructField("variants", T.MapType(T.StringType(), T.StructType([
        T.StructField("label", T.StringType()),
        T.StructField("step_names", T.ArrayType(T.StringType())),
    ]))),
])

CATALOG_SCHEMA = T.StructType([
    T.StructField("event_catalog", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("required_envelope_fields", T.ArrayType(T.StringType())),
])

DIM_STEP_SCHEMA = "test_group string, step_number int, step_name string, step_bucket string"

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("finished_at", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("retries_used", T.IntegerType()),
    T.StructField("validation_summary", T.MapType(T.StringType(), T.LongType())),
    T.StructField("error", T.StringType()),
])

# Outcomes a run can be recorded with.
RUN_STATUSES = (
    "success", "failed_validation", "failed_fatal",
    "failed_retries_exhausted", "failed_unclassified",
)
