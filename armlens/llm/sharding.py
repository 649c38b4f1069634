"""Contiguous shards of nearly equal size, cut from global prefix sums of bytes.

Documents stand in the order of their identifiers. Totals of ranges give every range's start, sums
inside it every document's (see ``order``); the whole size is cut at equal targets, and a document goes
to the shard that its middle byte falls into. So sizes differ from the target by less than the largest
document, whatever the texts are, and a shard is one stretch of the order. Only identifier, size and
checksum of a document are sorted; its text is read once and not moved. DataFrame operations only.

Null and empty texts have one byte, so they take a place too. Null identifiers come first. Rows with
one identifier stand by size, then checksum, then place in the table. Equal texts are not held together:
a group of copies may be larger than a shard. An empty table gives no rows; with fewer documents than
shards some shards stay empty. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import prepared, text_or_empty, written
from armlens.llm.order import placed

SHARDS = 8
LAW = "bytes"


def cut(sized: DataFrame, shards: int, order: list[str]) -> DataFrame:
    """Rows with a ``size`` of one or more, with their shard and gapless slot in it."""
    if shards < 1:
        raise ValueError("at least one shard")
    # Twice the middle, so that half bytes stay whole numbers; decimals, so that no table is too large.
    wide = "CAST({} AS DECIMAL(20,0))"
    shard = F.expr(f"CAST((2 * {wide.format('before')} + size) * {shards} DIV (2 * {wide.format('total')}) AS INT)")
    rows = written(placed(sized, order, size="size").withColumn("shard", shard), "shards")
    # One row per shard, so its size is bounded by the number of shards.
    first = rows.groupBy("shard").agg(F.min("place").alias("_first"))
    return rows.join(F.broadcast(first), "shard").withColumn("slot", F.col("place") - F.col("_first")).drop("_first")


ORDER = ["ident", "size", "crc", "row"]


def assign_shards(docs: DataFrame, shards: int = SHARDS, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Identifier, size, text_crc32, law, shard, slot, and grown_shard, which this law does not have."""
    prepared(docs.sparkSession)
    sized = written(_sized(docs, F.col(ident), F.col(text), F.monotonically_increasing_id()), "sizes")
    return cut(sized, shards, ORDER).select(
        F.col("ident").alias(ident), "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _sized(rows: DataFrame, ident: Column, text: Column, row: Column) -> DataFrame:
    body = text_or_empty(text)
    return rows.select(
        ident.alias("ident"), (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"), row.alias("row"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, ident: str = "doc_id", text: str = "text") -> None:
    """All rows and columns of ``docs`` as Parquet under ``path``, in a folder ``_shard=k`` per shard.

    Rows of a file stand in the order of their ``_slot``, and no file has rows between those of another.
    """
    prepared(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    bodies = written(docs.select(whole, F.monotonically_increasing_id().alias("row")), "bodies")
    sized = _sized(bodies, F.col("document")[ident], F.col("document")[text], F.col("row"))
    places = cut(written(sized, "sizes"), shards, ORDER).select("row", "shard", "slot")
    # Both sides grow with the corpus: never broadcast.
    rows = bodies.join(places.hint("merge"), "row").select(
        "document.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    ranges = rows.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    ranges.write.partitionBy("_shard").parquet(path)
