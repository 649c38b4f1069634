"""Assigning users to arms, stratified by platform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.domain import ARMS, PLATFORMS


def _pick(options: tuple[str, ...], index: Column) -> Column:
    return F.array(*[F.lit(o) for o in options])[index.cast("int")]


def assign_arms(users: DataFrame, index: str, arms: tuple[str, ...] = ARMS,
                strata: tuple[str, ...] = PLATFORMS) -> DataFrame:
    """Arm and platform from a whole number per user: arms take turns, platforms after each round.

    Plain arithmetic on the row itself: no sort, no numbering over all users, and a user always
    gets the same arm.
    """
    i = F.col(index).cast("bigint")
    turn = F.expr(f"CAST(`{index}` AS BIGINT) div {len(arms)}")
    return users.select(
        "*",
        _pick(arms, F.pmod(i, F.lit(len(arms)))).alias("test_group"),
        _pick(strata, F.pmod(turn, F.lit(len(strata)))).alias("platform"),
    )


def assign_arms_by_hash(users: DataFrame, user_id: str, arms: tuple[str, ...] = ARMS,
                        strata: tuple[str, ...] = PLATFORMS) -> DataFrame:
    """The same for ids that are not numbers: a hash of the id stands in for the index."""
    slots = len(arms) * len(strata)
    slot = F.pmod(F.xxhash64(user_id), F.lit(slots))
    return assign_arms(users.withColumn("_slot", slot), "_slot", arms, strata).drop("_slot")


def arm_balance(assigned: DataFrame, strata: tuple[str, ...] = PLATFORMS) -> DataFrame:
    """Users per arm and platform, platforms as columns."""
    counts = assigned.groupBy("test_group").pivot("platform", list(strata)).agg(F.count(F.lit(1)))
    return counts.select(
        "test_group",
        *[F.coalesce(F.col(s), F.lit(0).cast("bigint")).alias(f"users_{s.lower()}") for s in strata],
    )
