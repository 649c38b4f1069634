"""Small frames from values the program itself holds."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows of Python values as a frame, over Arrow: no Python worker, and a size Spark knows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    named = [dict(zip(schema.names, _plain(row))) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, to_arrow_schema(schema)), schema)


def _plain(row: tuple) -> list:
    return [list(value.items()) if isinstance(value, dict) else value for value in row]
