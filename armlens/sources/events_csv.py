"""Event envelope as CSV: every field is text, the JSON payload is quoted with doubled quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.domain import ENVELOPE, RAW_SCHEMA
from armlens.sources import csv_records

# escape='"' makes Spark read and write a doubled quote inside a quoted field. Without
# enforceSchema=false a file with columns in another order would be read by position.
READ_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}
RECORD_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
RAW_DDL = ", ".join(f"{c} string" for c in ENVELOPE)
WRITE_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_events_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Envelope rows plus the name of the file each came from.

    ``multi_line`` is for payloads with raw line breaks: files are still split over tasks, and records cut
    at the line breaks outside quotes. Without it such a payload stops the run, as its parts have too few
    fields; so does any other record with too few or too many.
    """
    if multi_line:
        return _from_records(csv_records.read_records(spark, path))
    return (
        spark.read.schema(RAW_SCHEMA).options(**READ_OPTIONS, mode="FAILFAST", columnPruning="false")
        .csv(path)
        .select(*ENVELOPE, F.col("_metadata.file_name").alias("_source_file"))
    )


def _from_records(records: DataFrame) -> DataFrame:
    """Fields of CSV records; the first of each file has to be the envelope's names in their order."""
    fields = F.from_csv("text", RAW_DDL, {**RECORD_OPTIONS, "mode": "FAILFAST"})
    named = F.concat_ws(",", *[fields[c] for c in ENVELOPE]) == ",".join(ENVELOPE)
    refused = F.raise_error(F.concat(F.lit("CSV header is not the event envelope: "), "file")).cast("boolean")
    return (
        records.filter(F.when(F.col("first"), F.when(named, F.lit(False)).otherwise(refused)).otherwise(F.lit(True)))
        .select(fields.alias("fields"), F.element_at(F.split("file", "/"), -1).alias("_source_file"))
        .select(*[F.col(f"fields.{c}").alias(c) for c in ENVELOPE], "_source_file")
    )


def write_events_csv(rows: DataFrame, path: str) -> str:
    """Envelope columns as CSV; a struct or map payload is turned into JSON text first."""
    payload = F.col("properties")
    if rows.schema["properties"].dataType.typeName() != "string":
        payload = F.to_json(payload)
    (
        rows.select(*[c for c in ENVELOPE if c != "properties"], payload.alias("properties"))
        .write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)
    )
    return path
