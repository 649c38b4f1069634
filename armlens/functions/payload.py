"""The JSON payload: one parse per row, typed columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Payload key, staged column, type.
FIELDS = (
    ("step_number", "step_number", "int"),
    ("step_name", "step_name", "string"),
    ("step_bucket", "step_bucket", "string"),
    ("time_on_step_seconds", "time_on_step_seconds", "double"),
    ("exit_reason", "exit_reason", "string"),
    ("total_steps_in_flow", "total_steps_in_flow", "int"),
    ("steps_completed", "steps_completed", "int"),
    ("signup_method", "signup_method", "string"),
    ("lesson_id", "lesson_id", "string"),
    ("score", "lesson_score", "int"),
    ("relevance_score", "relevance_score", "double"),
    ("days_since_install", "days_since_install", "int"),
    ("plan", "subscription_plan", "string"),
    ("price_usd", "price_usd", "double"),
    ("days_since_purchase", "days_since_purchase", "int"),
    ("reason", "refund_reason", "string"),
    ("is_onboarding_related", "is_onboarding_related", "flag"),
    ("category", "ticket_category", "string"),
)

# Every field is read as text first: a number sent as "3" or 3.0 then still lands in its column.
PAYLOAD_SCHEMA = T.StructType([T.StructField(key, T.StringType()) for key, _, _ in FIELDS])
COLUMNS = tuple(column for _, column, _ in FIELDS)


def parse(properties: Column) -> Column:
    return F.from_json(properties, PAYLOAD_SCHEMA)


# Text of a JSON scalar to its type: a fraction is cut for whole numbers, junk becomes NULL.
_CASTS = {
    "string": "{0}",
    "double": "try_cast({0} AS DOUBLE)",
    "int": "try_cast(try_cast({0} AS DOUBLE) AS INT)",
    "flag": "CASE {0} WHEN 'true' THEN 1 WHEN 'false' THEN 0 ELSE try_cast({0} AS INT) END",
}


def typed(parsed: str) -> list[Column]:
    """The staged payload columns out of the parsed struct column named ``parsed``."""
    return [
        F.expr(f"{_CASTS[kind].format(f'{parsed}.{key}')} AS {column}") for key, column, kind in FIELDS
    ]
