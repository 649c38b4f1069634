"""Staging layer: validate, quarantine, remove repeated deliveries, type the payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlens.domain import (
    ARMS, ENUMERATIONS, ENVELOPE, EVENT_CATALOG, KEYS, PLATFORMS, RELEVANCE_RANGE, STEP_EVENTS,
    STEP_RANGE,
)
from armlens.functions import payload
from armlens.functions.scalars import literal_map, utc_second
from armlens.sources.layers import through_scratch

REJECT_REASON = "null_or_invalid_key"
CATALOG_BYTES = 8 << 20  # of a catalogue table that is broadcast


def reject_codes() -> Column:
    """Why a raw row cannot be staged, as an array; empty for a good row."""
    tests = [
        F.when(F.coalesce(F.col(key), F.lit("")) == "", F.lit(f"null_{key}")) for key in KEYS
    ]
    tests += [
        F.when(~F.coalesce(F.col("test_group").isin(*ARMS), F.lit(False)), F.lit("bad_test_group")),
        F.when(~F.coalesce(F.col("platform").isin(*PLATFORMS), F.lit(False)), F.lit("bad_platform")),
        F.when(
            (F.col("event_timestamp") != "") & utc_second(F.col("event_timestamp")).isNull(),
            F.lit("bad_timestamp"),
        ),
    ]
    return F.array_compact(F.array(*tests))


def _keys_present(strict_null: bool) -> Column:
    present = F.lit(True)
    for key in KEYS:
        present &= F.col(key).isNotNull()
        if not strict_null:
            present &= F.col(key) != ""
    return present


def passes(strict_null: bool = False) -> Column:
    """The staging condition, for filters: plain comparisons, which reach the Parquet scan."""
    valid = (
        _keys_present(strict_null)
        & F.col("test_group").isin(*ARMS)
        & F.col("platform").isin(*PLATFORMS)
    )
    if not strict_null:
        valid &= utc_second(F.col("event_timestamp")).isNotNull()
    return valid


def valid_event(strict_null: bool = False) -> Column:
    """True for a row that may be staged, else False, never NULL.

    By default an unreadable timestamp and an empty key are invalid as well. ``strict_null``
    follows plain SQL instead: only NULL keys count, and time text is not looked at.
    """
    return F.coalesce(passes(strict_null), F.lit(False))


def refused(strict_null: bool = False) -> Column:
    """True for a row of the quarantine."""
    if not strict_null:
        return ~valid_event()
    return F.coalesce(
        ~_keys_present(True) | ~F.col("test_group").isin(*ARMS) | ~F.col("platform").isin(*PLATFORMS), F.lit(False)
    )


def verdict(strict_null: bool = False) -> Column:
    """Where a raw row belongs: ``valid``, ``refused``, or with ``strict_null`` also ``neither``."""
    if not strict_null:  # the time text is parsed once
        return F.when(passes(), "valid").otherwise("refused")
    return F.when(passes(strict_null), "valid").when(refused(strict_null), "refused").otherwise("neither")


def rejects(raw: DataFrame, strict_null: bool = False) -> DataFrame:
    """The quarantine: raw rows that are not staged, with the reason.

    By default exactly the rows ``valid_event`` turns down, so nothing disappears between the
    layers. With ``strict_null`` a NULL arm or platform compares as unknown and the row lands in
    neither table.
    """
    return raw.filter(refused(strict_null)).select(
        "*", F.lit(REJECT_REASON).alias("reject_reason"), reject_codes().alias("reject_codes")
    )


def first_delivery(raw: DataFrame) -> DataFrame:
    """One row per event_id, the first ingested.

    The rank filter lets Spark keep only the best row per id in every map task before the
    shuffle, so an id delivered a billion times sends one row per task.
    """
    same_id = Window.partitionBy("event_id").orderBy(
        F.col("_ingested_at").asc(), F.col("_ingest_seq").asc(), F.col("_source_file").asc(),
        F.xxhash64(*ENVELOPE).asc(),
    )
    return (
        raw.withColumn("_rank", F.row_number().over(same_id))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def with_time(rows: DataFrame) -> DataFrame:
    """Time text to a UTC second and its calendar date."""
    return rows.withColumn("event_timestamp", utc_second(F.col("event_timestamp"))).withColumn(
        "event_date", F.to_date("event_timestamp")
    )


def flatten_properties(rows: DataFrame) -> DataFrame:
    """Payload keys as typed columns; the JSON text stays beside them."""
    return (
        rows.withColumn("_payload", payload.parse(F.col("properties")))
        .select(*rows.columns, *payload.typed("_payload"))
    )


def stage(raw: DataFrame, strict_null: bool = False) -> DataFrame:
    """Raw rows to staged events. JSON is parsed last, on the rows that remain."""
    return (
        raw.filter(passes(strict_null))
        .transform(first_delivery)
        .transform(with_time)
        .select(
            "event_id", "user_id", "event_name", "event_timestamp", "event_date",
            "test_group", "platform", "session_id", "properties",
        )
        .transform(flatten_properties)
    )


def expected_keys(catalog: DataFrame) -> DataFrame:
    """A catalogue table (event_name, property) as one row per event with all its keys."""
    return catalog.filter(F.col("event_name").isNotNull()).groupBy("event_name").agg(
        F.array_sort(F.collect_set("property")).alias("_expected"))


def with_expected(staged: DataFrame, catalog: dict[str, tuple[str, ...]] | DataFrame,
                  broadcast_bytes: int = CATALOG_BYTES) -> DataFrame:
    """Staged events with the keys that their catalogue entry expects; NULL for an unknown event.

    A catalogue given as a table is joined: broadcast when its text is under ``broadcast_bytes``, else
    by a merge, in which adaptive execution splits hot event names.
    """
    if not isinstance(catalog, DataFrame):
        return staged.withColumn("_expected", F.try_element_at(literal_map(catalog), F.col("event_name")))
    keys = through_scratch(expected_keys(catalog), "catalog")
    text = F.length("event_name") + F.length(F.array_join("_expected", ",")) + 64
    small = (keys.agg(F.sum(text)).first()[0] or 0) <= broadcast_bytes
    return staged.join(F.broadcast(keys) if small else keys.hint("merge"), "event_name", "left")


def contract_violations(
    staged: DataFrame,
    catalog: dict[str, tuple[str, ...]] | DataFrame = EVENT_CATALOG,
    design: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Staged events that break the tracking contract: one row per event and finding.

    The catalogue is a mapping, which becomes a constant of the expression, or the table that
    ``read_event_catalog`` returns. The step design (arm -> ordered step names) is a constant too. Either
    way the check is a single pass over the events that parses each payload once.
    """
    name, step = F.col("event_name"), F.col("step_number")
    no_keys = F.array().cast("array<string>")
    keys = F.when(F.col("properties").isNull(), no_keys).otherwise(F.json_object_keys("properties"))

    def holds(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    step_event = name.isin(*STEP_EVENTS)
    step_in_range = holds(step.between(*STEP_RANGE))
    # (when it is wrong, code, what was found)
    values = [
        (step_event & ~step_in_range, "bad_step_number", step),
        (
            (name == "lesson_feedback_submitted")
            & ~holds(F.col("relevance_score").between(*RELEVANCE_RANGE)),
            "bad_relevance_score", F.col("relevance_score"),
        ),
    ]
    for column, (event, allowed) in ENUMERATIONS.items():
        wrong = (name == event) & ~holds(F.col(column).isin(*allowed))
        values.append((wrong, f"bad_{column}", F.col(column)))
    if design is not None:
        steps_of_arm = F.try_element_at(literal_map(design), F.col("test_group"))
        designed = F.try_element_at(steps_of_arm, F.greatest(step, F.lit(1)))
        placed = step_event & step_in_range
        values += [
            (placed & designed.isNull(), "step_outside_design", step),
            (
                placed & designed.isNotNull() & ~designed.eqNullSafe(F.col("step_name")),
                "step_name_mismatch", F.col("step_name"),
            ),
        ]

    def finding(code: str, detail: Column) -> Column:
        return F.struct(F.lit(code).alias("code"), detail.cast("string").alias("detail"))

    def per_key(code: str, names: Column) -> Column:
        return F.transform(names, lambda key: finding(code, key))

    def one(wrong: Column, code: str, detail: Column) -> Column:
        return F.array(F.when(wrong, finding(code, detail)))

    expected, present = F.col("_expected"), F.col("_keys")
    comparable = expected.isNotNull() & present.isNotNull()
    nothing = F.array().cast("array<struct<code:string,detail:string>>")
    found = [
        one(expected.isNull(), "unknown_event", name),
        one(present.isNull(), "bad_json", F.col("properties")),
        F.when(comparable, per_key("missing_key", F.array_except(expected, present))).otherwise(nothing),
        F.when(comparable, per_key("extra_key", F.array_except(present, expected))).otherwise(nothing),
        *[one(*value) for value in values],
    ]
    # Findings are exploded where they are made: a filter on them would be moved below the parsing of
    # the payload and parse it again for every condition. A good row has no findings and drops out.
    noted = with_expected(staged, catalog).withColumn("_keys", keys)
    return noted.select(
        "event_id", "event_name", "test_group",
        F.explode(F.array_compact(F.concat(*found))).alias("finding"),
    ).select("event_id", "event_name", "test_group", "finding.code", "finding.detail")


def reconciliation(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Do the layers add up: landed = staged + rejected + repeated deliveries; one row.

    One pass over the raw rows counts them by id and validity (partial counts per task, so a hot id is
    no burden); rejected rows and repeats follow from these. The staged table is counted itself.
    """
    n = F.col("n")
    counted = raw.groupBy("event_id", valid_event().alias("valid")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum(n).alias("landed"),
        F.sum(F.when(~F.col("valid"), n)).alias("rejected"),
        F.sum(F.when(F.col("valid"), n - 1)).alias("duplicates"),
    )
    both = counted.unionByName(staged.agg(F.count(F.lit(1)).alias("staged")), allowMissingColumns=True)
    whole = both.agg(*[
        F.coalesce(F.max(c), F.lit(0).cast("bigint")).alias(c) for c in ("landed", "staged", "rejected", "duplicates")
    ])
    adds_up = F.col("landed") == F.col("staged") + F.col("rejected") + F.col("duplicates")
    return whole.withColumn("balanced", adds_up.cast("int"))
