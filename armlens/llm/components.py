"""Connected components of a link table by alternating stars; no component is ever in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import written


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links (a < b) moved to the smallest neighbour: of greater neighbours, or of all smaller ones."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if large:
        both = both.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    else:
        both = links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    moved = both.join(least, "node")
    if large:
        moved = moved.filter(F.col("other") > F.col("node")).select(F.col("least").alias("a"), F.col("other").alias("b"))
    else:
        moved = moved.select(F.col("least").alias("a"), F.col("other").alias("b")).unionByName(
            least.select(F.col("least").alias("a"), F.col("node").alias("b")))
    return moved.filter(F.col("a") < F.col("b")).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node and label (the smallest node of its component) for every node of ``links`` (a, b).

    Every round is written to the shared folder; the rounds end when the table no longer changes, which
    takes about the logarithm of the longest path.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(F.col("a") < F.col("b"))
    state = written(ordered.distinct(), name)
    mark = None
    while True:
        state = written(_stars(_stars(state, True), False), name)
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = state.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return nodes.unionByName(state.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
