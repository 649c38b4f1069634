from __future__ import annotations

import hashlib
import random
import re

import pytest

from armlens.llm import decontamination
from tests.llm.texts import CLASHES, awkward, frame, prose


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(rows, items, window):
    windows = set()
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        windows |= {(str(item) if item is not None else None, tuple(w[i:i + n])) for i in range(len(w) - n + 1) if n}
    for ident, text in rows:
        w = words(text)
        hit, met = [False] * len(w), set()
        for item, window_ in windows:
            for i in range(len(w) - len(window_) + 1):
                if tuple(w[i:i + len(window_)]) == window_:
                    hit[i:i + len(window_)] = [True] * len(window_)
                    met.add(item)
        met = sorted(met - {None})
        yield ident, len(w), sum(hit), len(met), hashlib.sha256(",".join(met).encode()).hexdigest(), any(hit)


def tables(spark, rows, items):
    schema = "item_id bigint, text string" + "".join(f", {c} string" for c in CLASHES)
    return frame(spark, rows), spark.createDataFrame([(*x, *["?"] * len(CLASHES)) for x in items], schema)


@pytest.mark.parametrize("block_bytes", [200, decontamination.BLOCK_BYTES])
def test_hits(spark, block_bytes):
    rng = random.Random(3)
    passage = prose(rng, 40)
    items = [(1, passage), (2, prose(rng, 15)), (3, "w1 w2 w3"), (4, "w7"), (5, None), (6, " .. "), (None, prose(rng, 12)),
             (7, passage), (10, passage.upper()), (11, "é É ß")]
    rows = [r for r in awkward(rng) if r[0] != 15] + [
        (200, passage), (201, f"{prose(rng, 20)} {passage} {passage}"), (202, " ".join(passage.split()[5:20])),
        (203, items[6][1]), (204, "É é É é É ß"), (205, items[1][1].replace(" ", "--")), (205, "w7 w7 x"), (206, "w1 w2 w3 " * 400)]
    docs, benchmark = tables(spark, rows, items)
    out = decontamination.summarised(*decontamination.find_overlaps(docs, benchmark, block_bytes=block_bytes))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(plain(rows, items, 10), key=repr)


def test_no_items_and_no_documents(spark):
    docs, none = tables(spark, [(1, "a b")], [])
    out = decontamination.summarised(*decontamination.find_overlaps(docs, none)).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in out] == [(2, 0, False)]
    empty, items = tables(spark, [], [(1, "a b")])
    assert decontamination.summarised(*decontamination.find_overlaps(empty, items)).collect() == []


def test_native_plan(spark):
    docs, items = tables(spark, [(1, "a b c")], [(1, "a b")])
    tokens, _ = decontamination.find_overlaps(docs, items)
    tokens = spark.createDataFrame([(0, 3, ["a", "b", "c"])], "row bigint, n_words bigint, words array<string>")
    windows = spark.createDataFrame([(0, ["a", "b"])], "id bigint, window array<string>")
    plan = decontamination.find_windows(tokens, windows)._jdf.queryExecution().toString()
    assert not re.search("ArrowEval|BatchEval|MapIn|Cartesian|NestedLoop", plan)
