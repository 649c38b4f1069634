"""Distinct users over any range of days, from bitmaps that merge.

Users are numbered once and for all, from 1 without gaps, and a day keeps one bitmap per step and 32,768
users in place of a row per user. Bitmaps of any days are united bit by bit and counted: the counts are
exact, and a day that changes replaces its own bitmaps only.

Users without an identifier are not counted. Without events there are no rows.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from armlens.operators.marts import STEP, STEP_COUNTS
from armlens.sources.layers import through_scratch
from armlens.sources.local import local_frame


def number_users(users: DataFrame, known: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """user_id and number of the users that ``known`` does not have, numbered on from its last.

    Users are dealt to parts by hash and numbered inside them; parts begin where those before them end,
    so no task sees more than its part.
    """
    spark = users.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    new = users.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    last = 0
    if known is not None:
        new = new.join(known.select("user_id"), "user_id", "left_anti")
        last = known.agg(F.max("number")).first()[0] or 0
    dealt = through_scratch(new.withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int")), "new_users")
    sizes = sorted(tuple(row) for row in dealt.groupBy("part").count().collect())  # at most a row per part
    before = accumulate((n for _, n in sizes), initial=last)
    offsets = local_frame(spark, [(part, b) for (part, _), b in zip(sizes, before)], "part int, before bigint")
    place = F.row_number().over(Window.partitionBy("part").orderBy("user_id"))
    return dealt.withColumn("place", place).join(offsets, "part").select(
        "user_id", (F.col("before") + F.col("place")).alias("number"))


def step_bitmaps(states: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per day, step and chunk of users the bitmaps of who viewed, completed and abandoned it, from states
    of steps by ``event_date``."""
    bit = F.bitmap_bit_position("number")
    return (
        states.join(numbers.select("user_id", "number"), "user_id")
        .groupBy("event_date", *STEP, F.bitmap_bucket_number("number").alias("chunk"))
        .agg(*[F.bitmap_construct_agg(F.when(F.col(c) == 1, bit)).alias(c) for c in STEP_COUNTS])
    )


def user_counts(bitmaps: DataFrame) -> DataFrame:
    """Distinct users of all days per step and chunk."""
    return bitmaps.groupBy(*STEP, "chunk").agg(*[F.bitmap_count(F.bitmap_or_agg(c)).alias(c) for c in STEP_COUNTS])


def step_reach(bitmaps: DataFrame) -> DataFrame:
    """Per day with events of a step: its distinct users up to that day, and those new on it."""
    so_far = Window.partitionBy(*STEP, "chunk").orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    grown = bitmaps.select("event_date", *STEP, "chunk",
                           *[F.bitmap_count(F.bitmap_or_agg(c).over(so_far)).alias(c) for c in STEP_COUNTS])
    day_before = Window.partitionBy(*STEP, "chunk").orderBy("event_date")
    new = grown.select("event_date", *STEP, *[
        (F.col(c) - F.coalesce(F.lag(c).over(day_before), F.lit(0))).alias(c) for c in STEP_COUNTS])
    days = new.groupBy("event_date", *STEP).agg(*[F.sum(c).alias(f"new_{c}") for c in STEP_COUNTS])
    until = Window.partitionBy(*STEP).orderBy("event_date").rowsBetween(Window.unboundedPreceding, 0)
    return days.select("event_date", *STEP, *[f"new_{c}" for c in STEP_COUNTS],
                       *[F.sum(f"new_{c}").over(until).alias(c) for c in STEP_COUNTS])
