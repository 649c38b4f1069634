from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from armlens.llm import jaccard
from armlens.llm.components import components
from tests.llm.texts import awkward, frame, prose


def sets_of(rows, length):
    for ident, text in rows:
        words = (text or "").encode().lower().split()
        windows = {tuple(words[i:i + length]) for i in range(len(words) - length + 1)}
        yield ident, windows or ({tuple(words)} if words else set())


def plain(rows, length=3, percent=90):
    sets = list(sets_of(rows, length))
    label = {i: i for i, _ in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    order = lambda i: -1 if i is None else i
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((root(a), root(b)), key=order)
            label[q] = p
    return sorted(((i, len(s), root(i)) for i, s in sets), key=repr)


def families(seed, groups=6, members=25, words=90):
    """Near copies in chains: each member changes a little of the one before."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        text = prose(rng, rng.randint(20, words), 3_000).split()
        for _ in range(members):
            if rng.random() < 0.8:
                text[rng.randrange(len(text))] = f"n{rng.randrange(10_000)}"
            rows.append((rng.randrange(100_000), " ".join(text)))
    return rows


@pytest.mark.parametrize("length, percent", [(3, 90), (5, 80), (2, 60), (1, 100)])
@pytest.mark.parametrize("rows", [awkward(random.Random(6)), families(1)])
def test_components(spark, rows, length, percent):
    out = jaccard.join_similar(frame(spark, rows), shingle=length, percent=percent).collect()
    assert sorted(map(tuple, out), key=repr) == plain(rows, length, percent)


@pytest.mark.parametrize("rounds", [0, 2])
def test_large_regions_are_joined_in_blocks(spark, rounds):
    rows = families(2, groups=3, members=40)
    out = jaccard.join_similar(frame(spark, rows, False), limit=7, rounds=rounds).collect()
    assert sorted(map(tuple, out), key=repr) == plain(rows)


@pytest.mark.parametrize("limit", [4_000, 1])
def test_an_identifier_with_several_texts_has_the_links_of_all(spark, limit):
    rng = random.Random(8)
    x, y, z = (prose(rng, 60, 3_000) for _ in range(3))
    near = lambda text, n: " ".join([*text.split()[:-1], f"n{n}"])
    rows = [(1, x), (5, x), (5, y), (9, near(y, 1)), (9, z), (12, near(z, 2)), (20, prose(rng, 60, 3_000)), (5, y)]
    rows += [(30, f"{prose(rng, 20, 3_000)}") for _ in range(40)] + [(30, near(x, 3))] * 40
    out = jaccard.join_similar(frame(spark, rows), limit=limit).collect()
    assert sorted(map(tuple, out), key=repr) == plain(rows)
    assert {r["component_id"] for r in out if r["doc_id"] != 20} == {1}


def test_search_in_a_region_is_exact():
    rng = np.random.default_rng(5)
    for percent, spread in ((90, 4), (70, 20), (50, 30)):
        base = rng.integers(0, 1 << 60, (12, 60), np.uint64)
        sets = []
        for _ in range(700):
            own = base[rng.integers(12)].copy()
            own[rng.integers(0, 60, rng.integers(0, spread))] = rng.integers(0, 1 << 60, dtype=np.uint64)
            sets.append(np.unique(own))
        bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        found = jaccard.Sets(np.concatenate(sets), bounds, percent)
        label = list(range(len(sets)))

        def root(x):
            while label[x] != x:
                x = label[x]
            return x

        for x, y in found.connect(np.arange(len(sets))):
            assert 100 * len(np.intersect1d(sets[x], sets[y])) >= percent * len(np.union1d(sets[x], sets[y]))
            label[root(x)] = root(y)
        sample = rng.integers(0, len(sets), (4_000, 2))
        for x, y in sample:
            if 100 * len(np.intersect1d(sets[x], sets[y])) >= percent * len(np.union1d(sets[x], sets[y])):
                assert root(x) == root(y)


def test_cells_lose_no_link():
    rng = np.random.default_rng(9)
    for percent in (60, 80, 90):
        for size in [*range(1, 40), 100, 333, 471, 472, 700]:
            x = np.unique(rng.integers(0, 1 << 62, size, np.uint64))
            y = x.copy()
            changed = 0
            while True:  # as many changes as the threshold allows, additions and removals
                z = np.append(y, rng.integers(0, 1 << 62, dtype=np.uint64)) if rng.random() < 0.5 else y[1:]
                z = np.sort(z)
                if not len(z) or 100 * len(np.intersect1d(x, z)) < percent * len(np.union1d(x, z)):
                    break
                y, changed = z, changed + 1
            found = jaccard.cells(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]), percent)
            keys = [{(k, b) for k, o, b in zip(found.key, found.owner, found.band) if o == i} for i in (0, 1)]
            shared = keys[0] & keys[1]
            # In some band both share as many cells as each of them needs.
            needs = {(o, b): n for o, b, n in found.needs.tolist()}
            assert any(all(sum(c == b for _, c in shared) >= needs[i, b] for i in (0, 1))
                       for b in {b for _, b in shared}), (percent, size, changed)


def test_connected_components(spark):
    rng = random.Random(11)
    links = [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(500, 501 + i) for i in range(50)]
    label = {x: x for link in links for x in link}
    for _ in range(len(label)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    out = components(spark.createDataFrame(links, "a bigint, b bigint"))
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert dict(map(tuple, out.collect())) == {x: m for x, m in label.items() if x not in alone}
    assert out.count() == len(label) - len(alone)


def test_empty_table_and_identifiers(spark):
    assert jaccard.join_similar(frame(spark, [])).collect() == []
    with pytest.raises(TypeError):
        jaccard.join_similar(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
