"""Places and running sums over a whole table, from the totals of its partitions.

Rows are dealt to ranges of their sort key, so no group has to fit into one task: a group that holds a
third of all rows lies over many ranges. Every range counts and sums its own rows; prefix sums over
these few totals (one row per range and group in it) tell where a range starts, and a window inside the
range tells the rest. The ranges are a stored table: a repeated task reads the same ranges again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlens.llm.common import written


def placed(rows: DataFrame, order: list[str], group: str | None = None, size: str | None = None,
           name: str = "ranges") -> DataFrame:
    """``rows`` with place (rows before it in its group), n (rows of the group) and, given a ``size``,
    before and total (sums of it). Rows that agree in ``group`` and ``order`` come in any order.

    Columns named part, place, n, before and total are the operator's own; ``group`` is never null.
    """
    keys = ([group] if group else []) + order
    one = F.lit(1).cast("bigint")
    sums = {"place": one} | ({"before": F.col(size)} if size else {})
    totals = {"place": "n", "before": "total"}
    parted = written(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), name)
    same = ["part"] + ([group] if group else [])
    counted = parted.groupBy(*same).agg(*[F.sum(s).alias(c) for c, s in sums.items()])

    # One row per range, or per range and group in it: prefix sums over these are short.
    whole = Window.partitionBy(*([group] if group else []))
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        *same,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in sums],
        *[F.sum(c).over(whole).alias(totals[c]) for c in sums])

    inside = Window.partitionBy(*same).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = parted.select("*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(c) for c, s in sums.items()])
    joined = local.join(starts.hint("merge"), same)
    return joined.select(
        *[c for c in rows.columns], *[_sum(c) for c in sums], *[totals[c] for c in sums])


def _sum(name: str) -> Column:
    return (F.col(name) + F.col(f"_{name}")).cast("bigint").alias(name)
