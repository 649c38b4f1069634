"""Incremental raw layer: each event file is landed once, however often the job is started.

Spark keeps the list of files seen in the checkpoint and commits every batch as a whole, so a run
that dies half-way leaves nothing half-landed. Staging, which removes repeated deliveries, stays a
batch step over the whole raw layer: a repeat may arrive any number of days later, and a watermark
would let it through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from armlens.domain import ENVELOPE, RAW_SCHEMA
from armlens.session import pin
from armlens.sources.events_csv import READ_OPTIONS
from armlens.sources.landing import land
from armlens.sources.layers import layer_path


def events_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Envelope rows of every CSV file that is or will be in the folder."""
    reader = spark.readStream.schema(RAW_SCHEMA).options(**READ_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder).select(*ENVELOPE, F.col("_metadata.file_name").alias("_source_file"))


def land_stream(stream: DataFrame, root: str) -> StreamingQuery:
    """Land what has arrived since the last start, then stop; meant for a daily schedule.

    ``_ingested_at`` is the time of the batch, so an event delivered again in a later batch ranks
    after its first delivery.
    """
    pin(stream.sparkSession)
    return (
        land(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", layer_path(root, "_checkpoints/raw_events"))
        .trigger(availableNow=True)
        .start(layer_path(root, "raw_events"))
    )
