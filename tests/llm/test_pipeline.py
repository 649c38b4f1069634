"""Every stage against a plain version on its own input, and the registered queries against SQL."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

import corpus_pipeline
from armlens.llm import quality, queries
from armlens.llm.common import table, written
from tests.llm.test_decontamination import plain as plain_hits
from tests.llm.test_jaccard import plain as plain_groups
from tests.llm.texts import CLASHES, awkward

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, FOLDER), "stage")
        rows = [(r["doc_id"], r["text"]) for r in before.collect()]
        if name == "packing":
            break
        assert docs.columns == before.columns
        kept = {r["doc_id"] for r in docs.collect()}
        if name == "quality":
            scores = quality.score_quality(before, table(spark, FOLDER, "labels")).collect()
            assert kept == {r["doc_id"] for r in scores if r["predicted"]}
        if name == "exact dedup":
            first = {}
            for ident, text in sorted(rows):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), ident)
            assert kept == set(first.values())
        if name == "near dedup":
            assert kept == {i for i, _, group in plain_groups(rows, 5, 80) if i == group}
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
            assert kept == {r[0] for r in plain_hits(rows, items, 10) if not r[-1]}
    assert {r["doc_id"] for r in docs.collect()} == {i for i, _ in rows}
    assert len(dict(corpus_pipeline.STAGES)) == len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()


def test_stages_on_awkward_and_empty_documents(spark):
    names = [c for c in CLASHES]
    schema = "doc_id bigint, text string" + "".join(f", {c} string" for c in names)
    for rows in ([(*r, *["?"] * len(names)) for r in awkward(random.Random(12))], []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, written(stage(spark, docs, FOLDER), "stage")
            if name != "packing":
                assert docs.columns == before.columns


def test_near_copies_keep_or_drop_all_rows_of_an_identifier(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (1, "another text of its own that nothing else has"), (2, base + " more"), (2, "unlike all the others here"),
            (3, "third text which is alone")]
    schema = "doc_id bigint, text string, gone string"
    docs = spark.createDataFrame([(*r, "?") for r in rows], schema)
    kept = corpus_pipeline.near_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 3]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_against_sql(spark, database, name):
    frame = queries.registered()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    expected = database.execute(f"SELECT {', '.join(columns)} FROM ({queries.statements()[name]})").fetchall()
    assert sorted(map(tuple, frame.select(columns).collect()), key=repr) == sorted(expected, key=repr)


# op12 returns pairs of rows, so its coverage is in the comparison with SQL.
@pytest.mark.parametrize("name", sorted(set(queries.registered()) - {"op12_hard_negatives"}))
def test_query_covers_its_table(spark, name):
    frame = queries.registered()[name](spark, FOLDER)
    ident = "page_id" if "page_id" in frame.columns else "doc_id"
    source = table(spark, FOLDER, "pages" if ident == "page_id" else "documents")
    rows = frame.select(ident).collect()
    assert {r[0] for r in rows} == {r[0] for r in source.select(ident).collect()}
    assert name == "op5_packing" or len(rows) == source.count()
