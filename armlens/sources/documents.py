"""Result documents: nested statistics, and the dashboard bundle a line per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Mart -> columns that order its rows in the bundle.
BUNDLE_ORDER = {
    "kpi_by_group": ("test_group",),
    "guardrails_by_group": ("test_group",),
    "step_dropoff": ("test_group", "step_number", "step_name"),
    "daily_funnel": ("install_date", "test_group"),
}


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row frames (no join: union, then first)."""
    tall = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames
    )
    return tall.agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in tall.columns])


def bundle_rows(marts: dict[str, DataFrame]) -> DataFrame:
    """Every mart row as JSON with its section and sort key; stays distributed at any size."""
    parts = []
    for section, order in BUNDLE_ORDER.items():
        mart = marts[section]
        parts.append(mart.select(
            F.lit(section).alias("section"),
            F.to_json(F.struct(*order), {"ignoreNullFields": "false"}).alias("sort_key"),
            F.to_json(F.struct(*mart.columns), {"ignoreNullFields": "false"}).alias("row"),
        ))
    return reduce(lambda a, b: a.unionByName(b), parts)


def export_bundle(marts: dict[str, DataFrame], stats: DataFrame, path: str) -> str:
    """The bundle as JSON lines, a mart row each, and the statistics as one line of their own.

    Every task writes its share, so a mart of any size is exported; readers order a section by
    ``sort_key``.
    """
    whole = stats.select(
        F.lit("stats").alias("section"), F.lit(None).cast("string").alias("sort_key"),
        F.to_json(F.struct(*stats.columns), {"ignoreNullFields": "false"}).alias("row"),
    )
    bundle_rows(marts).unionByName(whole).write.mode("overwrite").json(path)
    return path


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("section string, sort_key string, row string").json(path)


def write_document(document: DataFrame, path: str) -> str:
    """A one-row frame as a JSON file; NULL fields are kept."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
