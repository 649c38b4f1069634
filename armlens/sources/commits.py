"""A numbered log of commits: one small JSON file per number, created exclusively.

Two writers that start from the same state both try the next number, and the store lets one of them
create the file. The other learns that its base is out of date, and nothing of its is ever seen.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.sources.layers import layer_path

SCHEMA = ("number bigint, run_id string, folder string, dates array<string>, raw_rows bigint, rejects bigint, "
          "new_users bigint, step_rows bigint, published_at string")


class Conflict(Exception):
    """Another writer has committed since this one read its base."""


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """A new file with ``text``; ``Conflict`` if there is one already."""
    store, target = _file(spark, path)
    if store.exists(target):
        raise Conflict(path)
    try:
        stream = store.create(target, False)
    except Exception as failure:
        if store.exists(target):
            raise Conflict(path) from failure
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _file(spark, path)
    return store.exists(target)


def commits(spark: SparkSession, root: str, name: str = "commits") -> DataFrame:
    """All commits; no rows before the first."""
    path = layer_path(root, name)
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path)


def latest(spark: SparkSession, root: str, name: str = "commits") -> dict | None:
    row = commits(spark, root, name).orderBy(F.col("number").desc()).first()
    return row.asDict() if row else None


def commit(spark: SparkSession, root: str, number: int, name: str = "commits", **record) -> None:
    """Take ``number``, which has to be free."""
    text = json.dumps({"number": number, **record})
    create_once(spark, f"{layer_path(root, name)}/{number:08d}.json", text)
