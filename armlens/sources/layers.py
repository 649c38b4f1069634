"""Tables of the layers as Parquet folders, rebuilt as a whole on every run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from armlens.session import scratch_path


def layer_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_layer(table: DataFrame, root: str, name: str, mode: str = "overwrite",
                partition_by: str | None = None, files: int | None = None,
                parts: tuple[str, ...] = ()) -> DataFrame:
    """Write a table and return it read back, so later steps start from files, not from lineage.

    ``partition_by`` rebalances first: a date holding a third of all rows is split into files of
    the advisory size instead of being written by one task. ``parts`` are partition columns of few
    values, written by the tasks as they are, without a shuffle. ``files`` is for tables known to be
    small, such as marts.
    """
    if partition_by:
        table = table.hint("rebalance", partition_by)
    elif files:
        table = table.coalesce(files)
    writer = table.write.mode(mode)
    if partition_by or parts:
        writer = writer.partitionBy(*([partition_by] if partition_by else []), *parts)
    path = layer_path(root, name)
    writer.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def write_bucketed(table: DataFrame, root: str, name: str, by: str, buckets: int | None = None,
                   deal: bool = False) -> DataFrame:
    """Write a table laid out by the hash of a key, and return it read back with that layout.

    Windows, groupings and joins on the key then need no shuffle. ``buckets`` are as many as the shuffle
    partitions chosen for the data, unless given. ``deal`` shuffles the rows by the key first; without it
    the table has to come laid out by the key, or every task writes a file of every bucket. No entry stays in the catalogue: the layout is known to
    the frame, and ``read_bucketed`` tells it to another session.
    """
    spark = table.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    entry = f"layer_{uuid.uuid4().hex}"
    rows = table.repartition(buckets, by) if deal else table
    rows.write.mode("overwrite").bucketBy(buckets, by).sortBy(by).option("path", layer_path(root, name)).saveAsTable(
        entry, format="parquet")
    return _taken(spark, entry)


def read_bucketed(spark: SparkSession, root: str, name: str, by: str, buckets: int) -> DataFrame:
    """A table of ``write_bucketed``; by and buckets as it was written."""
    entry = f"layer_{uuid.uuid4().hex}"
    plain = read_layer(spark, root, name)
    columns = ", ".join(f"`{c}` {kind}" for c, kind in plain.dtypes)
    spark.sql(f"CREATE TABLE {entry} ({columns}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) "
              f"INTO {buckets} BUCKETS LOCATION '{layer_path(root, name)}'")
    return _taken(spark, entry)


def _taken(spark: SparkSession, entry: str) -> DataFrame:
    """The table of a catalogue entry, without the entry; its files stay."""
    frame = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return frame


def overwrite_partitions(table: DataFrame, root: str, name: str, partition_by: str) -> None:
    """Replace the partitions that ``table`` has rows of and leave all others as they are."""
    rows = table.hint("rebalance", partition_by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(
        layer_path(root, name))


def read_layer(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, name))


def through_scratch(table: DataFrame, name: str) -> DataFrame:
    """Write a table used more than once to the shared scratch folder and read it back."""
    return write_layer(table, scratch_path(table.sparkSession, name), name)
