"""Deliberately bad deliveries, to show that staging and the gate catch them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.domain import ENVELOPE
from armlens.sources.landing import RAW_COLUMNS, append_batches, land
from armlens.sources.local import local_frame

# Six rows that each break one rule.
_AT = "2026-07-01T00:00:00"
MALFORMED = (
    (None, "u_9999999", "onboarding_started", _AT, "A", "iOS"),
    ("bad_evt_1", None, "onboarding_started", _AT, "A", "iOS"),
    ("bad_evt_2", "u_9999998", None, _AT, "A", "iOS"),
    ("bad_evt_3", "u_9999997", "onboarding_started", None, "A", "iOS"),
    ("bad_evt_4", "u_9999996", "onboarding_started", _AT, "Z", "iOS"),
    ("bad_evt_5", "u_9999995", "onboarding_started", _AT, "A", "Windows"),
)
DUPLICATES = 3


def inject_dirty(raw: DataFrame) -> DataFrame:
    """Raw rows plus six malformed ones and three deliveries repeated."""
    spark = raw.sparkSession
    schema = ", ".join(f"{name} string" for name in ENVELOPE)
    bad = land(
        local_frame(spark, [(*row, "s1", "{}") for row in MALFORMED], schema),
        source_file="dirty_injection", ingest_seq=1,
    )
    first = _first_rows(raw, DUPLICATES)
    again = first.select(
        *ENVELOPE,
        F.current_timestamp().alias("_ingested_at"),
        F.lit("dirty_injection_dup").alias("_source_file"),
        (F.col("_ingest_seq") + 1).alias("_ingest_seq"),
    )
    return append_batches(raw.select(*RAW_COLUMNS), bad, again.select(*RAW_COLUMNS))


def corrupt_arm(raw: DataFrame) -> DataFrame:
    """The same rows with the arm 'INVALID'."""
    return raw.withColumn("test_group", F.lit("INVALID"))


def _first_rows(raw: DataFrame, n: int) -> DataFrame:
    """In a fixed order, so a task that runs again picks the same rows."""
    return raw.orderBy(F.col("event_id").asc_nulls_last(), "_ingest_seq").limit(n)
