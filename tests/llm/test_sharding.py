from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from armlens.llm import sharding
from tests.llm.texts import awkward, frame


def plain(rows, shards):
    sized = sorted(((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows))
    total, before, slots, out = sum(r[2] for r in sized), 0, {}, []
    for known, ident, size, crc in sized:
        shard = (2 * before + size) * shards // (2 * total)
        out.append((ident if known else None, size, crc, "bytes", shard, slots.get(shard, 0), None))
        slots[shard] = slots.get(shard, 0) + 1
        before += size
    return out


@pytest.mark.parametrize("shards", [1, 2, 8, 50])
def test_shards(spark, shards):
    rows = awkward(random.Random(shards)) + [(500 + i, "x " * (i % 50)) for i in range(400)]
    got = sharding.assign_shards(frame(spark, rows).repartition(5), shards).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows, shards), key=repr)


def test_sizes_are_near_equal_and_slots_gapless(spark):
    """One text has a third of all rows, and one identifier has another third."""
    rows = [(i, "copy of one text") for i in range(500)] + [(7_000, f"row {i}") for i in range(500)] + [
        (8_000 + i, "y" * (i % 300)) for i in range(500)]
    got = sharding.assign_shards(frame(spark, rows)).collect()
    sizes, slots = {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(sizes) == list(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 300
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    ends = {s: (min(r["doc_id"] for r in got if r["shard"] == s), max(r["doc_id"] for r in got if r["shard"] == s))
            for s in sizes}
    assert all(ends[s][1] <= ends[s + 1][0] for s in range(7))


def test_hot_identifier_does_not_meet_in_one_range(spark):
    rows = frame(spark, [(1, f"t{i}") for i in range(4_000)], clashes=False)
    sized = sharding._sized(rows, F.col("doc_id"), F.col("text"), F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = sized.repartitionByRange(*sharding.ORDER).groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) == 4


def test_files(spark, tmp_path):
    rows = awkward(random.Random(3))
    docs = frame(spark, rows)
    sharding.write_shards(docs, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(repr, back.select("doc_id", "text").collect())) == sorted(map(repr, docs.select("doc_id", "text").collect()))
    placed = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.assign_shards(docs, 3).collect()}
    assert {(r["doc_id"], r["_shard"], r["_slot"]) for r in back.collect()} == placed
    assert set(docs.columns) < set(back.columns)


def test_few_rows_and_none(spark):
    assert sharding.assign_shards(frame(spark, [])).collect() == []
    assert [r["shard"] for r in sharding.assign_shards(frame(spark, [(1, None)])).collect()] == [4]
    with pytest.raises(ValueError):
        sharding.assign_shards(frame(spark, []), 0)


def test_no_python_in_the_plan(spark):
    plan = sharding.assign_shards(frame(spark, awkward(random.Random(4))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
