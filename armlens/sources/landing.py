"""Raw layer: rows as delivered, plus when and from where they came."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.domain import ENVELOPE

RAW_COLUMNS = (*ENVELOPE, "_ingested_at", "_source_file", "_ingest_seq")


def land(rows: DataFrame, source_file: str | None = None, ingest_seq: int | None = None) -> DataFrame:
    """Add the landing columns; filters and casts nothing.

    ``_ingest_seq`` is the ordinal of the batch. Batches landed within one second share
    ``_ingested_at``, so the ordinal is what makes "first delivery" well defined. Columns the
    rows already carry (file name of the reader, time of a stream's batch) are kept.
    """
    have = set(rows.columns)
    if source_file is not None or "_source_file" not in have:
        rows = rows.withColumn("_source_file", F.lit(source_file).cast("string"))
    if ingest_seq is not None or "_ingest_seq" not in have:
        rows = rows.withColumn("_ingest_seq", F.lit(ingest_seq or 0).cast("int"))
    if "_ingested_at" not in have:
        rows = rows.withColumn("_ingested_at", F.current_timestamp())
    return rows.select(*RAW_COLUMNS)


def append_batches(*batches: DataFrame) -> DataFrame:
    """All landed batches as one raw layer."""
    return reduce(lambda a, b: a.unionByName(b), batches)
