from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from armlens.llm import exact
from tests.llm.texts import awkward, frame


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=8).map(lambda b: b * 40), st.integers(0, 9)), max_size=60),
       st.sampled_from([600, 2_000, 1 << 20]))
def test_trie_gives_smallest_identifier_and_count_however_small_its_memory(entries, limit):
    expected = defaultdict(list)
    spilled = []
    whole, partial = exact.PatriciaTrie(limit), exact.PatriciaTrie(limit, spilled.extend)
    for text, ident in entries:
        expected[text].append(ident)
        whole.insert(text, ident)
        partial.insert(text, ident)
    want = {t: (min(i), i.count(min(i)), len(i)) for t, i in expected.items()}
    assert {t: rest for t, *rest in map(lambda e: (e[0], e[1:]), whole.entries())} == {t: [w] for t, w in want.items()}
    again = exact.PatriciaTrie()
    for entry in [*spilled, *partial.entries()]:
        again.insert(*entry)
    assert {e[0]: e[1:] for e in again.entries()} == want


@pytest.mark.parametrize("limit", [1_000, exact.TRIE_BYTES])
def test_copies(spark, limit):
    rows = awkward(random.Random(1))
    groups = defaultdict(list)
    for ident, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(ident)
    out = exact.mark_copies(frame(spark, rows), limit=limit).collect()
    assert len(out) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for digest, ids in by_digest.items():
        own = [r for r in out if r["text_sha256"] == digest]
        least = min((i for i in ids if i is not None), default=None)
        assert len(own) == len(ids) and {r["keep_id"] for r in own} == {least}
        assert {r["group_size"] for r in own} == {len(ids)}
        assert [r["doc_id"] for r in own if r["kept"]] == [least]


def test_two_texts_with_one_digest_stop_the_run(spark):
    groups = spark.createDataFrame([("d", 3, 1, 1, 1), ("d", 3, 2, 1, 4), ("e", 3, 3, 1, 1)],
                                   "digest string, n_bytes bigint, keep bigint, ties bigint, n bigint")
    with pytest.raises(Exception, match="two texts share length and digest"):
        exact.told_apart(groups).collect()
    assert exact.told_apart(groups.filter("keep > 1")).count() == 2


def test_whole_rows_are_carried(spark):
    docs = frame(spark, awkward(random.Random(2)))
    kept = exact.mark_copies(docs, carry=True).filter("kept").select("row.*")
    assert kept.columns == docs.columns
    assert kept.count() == exact.mark_copies(docs).filter("kept").count()


def test_empty_table(spark):
    assert exact.mark_copies(frame(spark, [])).collect() == []
