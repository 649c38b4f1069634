from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from armlens.llm import merkle
from armlens.llm.order import placed
from tests.llm.texts import CLASHES, awkward

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(digests, fanout):
    """Last node, and per digest its path of (left, right)."""
    paths, places = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i:i + fanout] for i in range(0, len(digests), fanout)]
        for k, place in enumerate(places):
            run, slot = runs[place // fanout], place % fanout
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            places[k] = place // fanout
        digests = [sha("".join(run)) for run in runs]
    return digests[0], paths


def plain(rows, fanout=16):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of rows as in ``SCHEMA``."""
    groups = defaultdict(list)
    for ident, text, lang, source, n in rows:
        leaf = found = sha("".join(map(field, (ident, source, lang, n, text))))
        if ident is not None and zlib.crc32(str(ident).encode()) % 5 == 0:
            found = sha("".join(map(field, (ident, source, lang, n, text and text.translate(LOWER)))))
        groups[source].append((ident is not None, ident or 0, leaf, found))
    trees = {}
    for source, leaves in groups.items():
        leaves.sort()
        trees[source] = climb([leaf[2] for leaf in leaves], fanout)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    if not names:
        return []
    root, above = climb([trees[s][0] for s in names], fanout)
    out = []
    for source, upper in zip(names, above):
        subroot, paths = trees[source]
        for (known, ident, leaf, found), path in zip(groups[source], paths):
            node = found
            for left, right in path + upper:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path + upper))
            out.append((ident if known else None, leaf, subroot, root, proof, node, node == root))
    return out


def table(rng, sources):
    rows = []
    for ident, text in awkward(rng) + [(i, f"Text {i} WITH capitals é") for i in range(1_000, 1_200)]:
        source = sources[0] if rng.random() < 0.4 else rng.choice(sources)
        rows.append((ident, text, rng.choice(["en", "", None]), source, rng.choice([None, -1, len(text or "")])))
    return rows + rows[-3:]


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("fanout, sources", [
    (16, ["hot", None, "", "b", "Z", "é"]),
    (2, [f"s{i}" for i in range(40)]),  # deep trees, and a tree of sources of several levels
    (16, ["only"]),
    (3, [None]),
])
def test_proofs(spark, fanout, sources):
    rows = table(random.Random(fanout), sources)
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in (*CLASHES, "leaf", "path", "tree", "place", "digest"):
        docs = docs.withColumn(name, F.lit("?"))
    got = merkle.verified(docs.repartition(7), fanout=fanout).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows, fanout), key=repr)
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (16, 1), (17, 16), (1,) * 17, (256, 257)])
def test_runs_that_are_full_or_of_one(spark, sizes):
    rows = [(100 * s + i, f"T{i}", "en", f"s{s:02}", i) for s, n in enumerate(sizes) for i in range(n)]
    got = merkle.verified(spark.createDataFrame(rows, SCHEMA)).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows))


def test_any_change_is_found(spark):
    rows = [(i, f"text {i}", "en", "s", i) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    proven = merkle.prove(docs.select("doc_id", "source", merkle.leaf_digest(merkle.COLUMNS).alias("leaf")))
    wrong = proven.select(
        (merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("right"),
        (merkle.folded(F.sha2(F.col("leaf"), 256), F.col("path")) == F.col("root")).alias("wrong"))
    assert {tuple(r) for r in wrong.collect()} == {(True, False)}
    assert merkle.manifest(docs).columns == ["doc_id", "leaf", "subroot", "root", "path"]


def test_fields_cannot_run_into_each_other(spark):
    rows = [(1, "ab", "c", "s", None), (1, "a", "bc", "s", None), (1, None, "-", "s", None), (1, "-", None, "s", None)]
    leaves = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).select("leaf").collect()
    assert len({r[0] for r in leaves}) == 4


def test_empty_table(spark):
    assert merkle.verified(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_group_is_spread(spark):
    """No exchange of single rows is by group alone."""
    docs = spark.range(2_000).select(
        F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranges = placed(docs.withColumnRenamed("source", "tree"), ["doc_id"], "tree")
    parts = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["n"] for r in parts) < 2_000
    assert [r["place"] for r in ranges.orderBy("doc_id").collect()] == list(range(2_000))
    assert merkle.prove(docs).select("root").distinct().count() == 1
