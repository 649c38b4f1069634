"""Bitmaps of users against sets in plain Python."""

from __future__ import annotations

import random

import pytest

from armlens.operators import reach
from armlens.operators.marts import STEP_COUNTS
from armlens.sources.local import local_frame

STATES = "event_date date, test_group string, step_number int, step_name string, user_id string, " + ", ".join(
    f"{c} int" for c in STEP_COUNTS)


def states(n, users, seed):
    import datetime

    rng = random.Random(seed)
    rows = {}
    for _ in range(n):
        day, step, user = rng.randrange(6), rng.choice((1, 2, None)), rng.choice((None, *range(users)))
        key = (datetime.date(2026, 6, 1 + day), "A", step, "s", user if user is None else f"u{user}")
        rows[key] = tuple(rng.randrange(2) for _ in STEP_COUNTS)
    return [(*k, *v) for k, v in rows.items()]


def test_numbers_have_no_gaps_and_stay(spark):
    users = lambda ids: local_frame(spark, [(u,) for u in ids], "user_id string")
    first = reach.number_users(users(["b", "a", None, "a", "c"]), parts=2)
    got = {r.user_id: r.number for r in first.collect()}
    assert set(got) == {"a", "b", "c"} and sorted(got.values()) == [1, 2, 3]
    more = {r.user_id: r.number for r in reach.number_users(users(["c", "d", "e", "a"]), first).collect()}
    assert set(more) == {"d", "e"} and sorted(more.values()) == [4, 5]
    assert reach.number_users(users(["a"]), first).collect() == []
    assert reach.number_users(users([])).collect() == []


@pytest.mark.parametrize("shift", [0, 32_768 - 20, 10**10])
def test_counts_are_those_of_sets(spark, shift):
    rows = states(500, 40, shift)
    numbers = reach.number_users(local_frame(spark, rows, STATES))
    numbers = numbers.withColumn("number", numbers.number + shift)  # over the edge of a chunk, and far out
    bitmaps = reach.step_bitmaps(local_frame(spark, rows, STATES), numbers)
    assert bitmaps.groupBy("event_date", "step_number", "chunk").count().filter("count > 1").collect() == []

    def who(step, place, days):
        return {r[4] for r in rows if r[2] == step and r[0] in days and r[5 + place] and r[4] is not None}

    days = sorted({r[0] for r in rows})
    counts = {}
    for r in reach.user_counts(bitmaps).collect():
        for place, c in enumerate(STEP_COUNTS):
            counts[r.step_number, place] = counts.get((r.step_number, place), 0) + r[c]
    assert counts == {(step, place): len(who(step, place, days)) for step in (1, 2, None) for place in range(3)}
    for r in reach.step_reach(bitmaps).collect():
        for place, c in enumerate(STEP_COUNTS):
            upto = who(r.step_number, place, [d for d in days if d <= r.event_date])
            before = who(r.step_number, place, [d for d in days if d < r.event_date])
            assert (r[c], r[f"new_{c}"]) == (len(upto), len(upto - before))


def test_bitmaps_of_no_rows(spark):
    empty = local_frame(spark, [], STATES)
    bitmaps = reach.step_bitmaps(empty, reach.number_users(empty))
    assert reach.step_reach(bitmaps).collect() == [] and reach.user_counts(bitmaps).collect() == []
