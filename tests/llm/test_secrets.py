from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from armlens.llm import secrets
from tests.llm.texts import awkward

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
NAMES = ("assign", "access", "hex")
SCHEMA = "doc_id bigint, text string, source string, row string, kind string, spans string"


def plain(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def line(spans):
    return ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in spans)


def scanned(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, s, "?", "?", "?") for i, t, s in rows], SCHEMA)
    return {r["doc_id"]: r for r in secrets.summarised(*secrets.find_secrets(docs, **options)).collect()}


def test_plain_kinds(spark):
    rng = random.Random(5)
    rows = [(i, t, None) for i, t in enumerate(t for _, t in awkward(rng))]
    parts = ["password", "Api_Key", "TOKEN", "secret", "=", ":", " ", "\"", "'", "abc", "x1y2z3", "é", "\U0001f600", "AKIA",
             "AKIA" + "B7" * 9, "0f" * 12, "0f" * 11, "token=token: abcdef", "\n", "\t", "/+-_"]
    rows += [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 40))), f"s{i % 3}") for i in range(300)]
    rows.append((999, "password=hunter22 " * 3_000, "s0"))
    out = scanned(spark, rows, kinds=secrets.PLAIN)
    assert len(out) == len(rows)
    for ident, text, _ in rows:
        want = plain(text)
        assert out[ident]["base_sha256"] == hashlib.sha256(line(want).encode()).hexdigest(), text
        assert out[ident]["spans"] == line(want)
        assert [out[ident][f"n_{n}"] for n in NAMES] == [sum(k == j for _, k, _ in want) for j in range(3)]


def test_ownership(spark):
    live, example = "ghp_" + "Zq" * 20, "ghp_" + "Yw" * 20
    rows = [(1, f"x {live}", "s1"), (2, f"{live} {example}", "s1"), (3, f"é {example}", "s2"), (4, None, "s2"),
            (5, "token = 'sharedsecret'", "s1"), (6, "token = 'sharedsecret'", None), (6, "", "s9")]
    out = scanned(spark, rows[:-1])
    assert out[1]["spans"] == "marked:2:46" and out[2]["spans"] == "marked:0:44" and out[3]["spans"] == ""
    assert (out[5]["n_assign"], out[5]["n_copied"], out[5]["n_live"]) == (1, 1, 0) and out[5]["spans"] == "assign:0:21"
    docs = spark.createDataFrame([(i, t, s, "?", "?", "?") for i, t, s in rows], SCHEMA)
    _, spans = secrets.find_secrets(docs, repository=F.col("doc_id"))
    counts = {r["value"]: (r["owners"], r["repositories"], r["live"]) for r in spans.collect()}
    assert counts == {live: (1, 2, True), "sharedsecret": (2, 2, False)}


def test_copies_of_a_document_are_one_witness_and_no_span_is_lost(spark):
    mirrored, pair, example, hot = ("ghp_" + x * 20 for x in ("Zq", "Pr", "Yw", "Hk"))
    rows = [(i, f"see  {mirrored}" if i else f"see\n{mirrored}", f"s{i}") for i in range(6)]
    rows += [(10 + i, f"{pair} in {i}", f"s{i}") for i in range(2)]
    rows += [(20 + i, f"{example} in {i}", f"s{i}") for i in range(3)]
    rows += [(30 + i, f"{hot} in {i}", "s1") for i in range(20)]
    rows += [(60, None, "s1"), (61, f"token = 'sharedsecret' {example}", None)]
    docs = spark.createDataFrame([(i, t, s, "?", "?", "?") for i, t, s in rows], SCHEMA)
    documents, spans = secrets.find_secrets(docs, repository=F.concat_ws("/", "source", "kind"), wide=secrets.Wide())
    counts = {r["value"]: (r["owners"], r["repositories"], r["texts"], r["live"]) for r in spans.collect()}
    assert counts == {mirrored: (1, 1, 1, True), pair: (2, 2, 2, True), example: (4, 4, 4, False),
                      hot: (1, 1, 20, False), "sharedsecret": (1, 1, 1, True)}
    out = {r["doc_id"]: r for r in secrets.summarised(documents, spans).collect()}
    assert len(out) == len(rows)
    assert (out[0]["spans"], out[1]["spans"], out[10]["spans"]) == ("marked:4:48", "marked:5:49", "marked:0:44")
    assert (out[20]["spans"], out[20]["n_live"], out[20]["n_copied"]) == ("marked:0:44", 0, 1)
    assert out[30]["spans"] == out[30]["copied_spans"] == "marked:0:44" and out[60]["spans"] == ""
    assert (out[61]["spans"], out[61]["n_live"], out[61]["n_copied"]) == ("assign:0:21,marked:23:67", 1, 1)
    assert out[61]["copied_spans"] == "marked:23:67" and out[0]["copied_spans"] == out[60]["copied_spans"] == ""


def test_plain_kinds_are_the_same_with_witnesses(spark):
    rows = [(1, "token = 'sharedsecret' AKIA" + "B7" * 9, "s1"), (2, "token = 'sharedsecret'", "s2"), (3, "0f" * 12, None)]
    docs = spark.createDataFrame([(i, t, s, "?", "?", "?") for i, t, s in rows], SCHEMA)
    out = secrets.summarised(*secrets.find_secrets(docs, wide=secrets.Wide())).collect()
    assert {r["doc_id"]: r["spans"] for r in out} == {i: line(plain(t)) for i, t, _ in rows}


def test_empty_table(spark):
    assert scanned(spark, []) == {}


def test_no_python_runs_in_tasks(spark):
    docs = spark.createDataFrame([(1, "a", "s", "", "", "")], SCHEMA)
    plan = secrets.summarised(*secrets.find_secrets(docs))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
