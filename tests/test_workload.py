"""Every registered query against its SQL counterpart, and the shape of its plan."""

from __future__ import annotations

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from armlens.plans import oracle, workload

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
QUERIES = workload.registered()
STATEMENTS = oracle.statements()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}") + 0.0
    return v


def test_every_query_has_a_statement_and_no_other():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_statement(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    rows = frame.collect()
    result = database.execute(STATEMENTS[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    order = sorted(columns)
    got = sorted((tuple(value(r[c]) for c in order) for r in rows), key=repr)
    want = sorted((tuple(value(r[columns.index(c)]) for c in order) for r in result.fetchall()), key=repr)
    assert got == want
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "RoundRobinPartitioning" not in plan


def test_entry_is_the_kpi_mart(spark):
    assert [r.test_group for r in contract.entry(spark).orderBy("test_group").collect()] == ["A", "B", "C"]


@pytest.mark.parametrize("name", ["ztest_pairs", "contract_violations", "stage_reconciliation"])
def test_planned_scans_and_parses(spark, name):
    """Without counting on exchanges being reused: events are scanned once and payloads parsed once."""
    plan = workload.registered()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_type#") and len(re.findall(r"Relation \[.*event_type", plan)) == 1
    assert plan.count("from_json") <= (1 if name == "contract_violations" else 0) or name == "ztest_pairs"


def test_contract_covers_the_library():
    assert set(QUERIES) <= set(contract.queries()) and set(STATEMENTS) <= set(contract.oracle_sql())
