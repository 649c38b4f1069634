from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from armlens.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 70), st.integers(0, 70), st.integers(0, 70), st.sampled_from([1, 2, 16]), st.integers(0, 9))
def test_strassen(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(1 << 20), 1 << 20, (m, k)), rng.integers(-(1 << 20), 1 << 20, (k, n))
    assert (negatives.strassen(a, b, leaf) == a @ b).all()


def best(entries, size):
    return sorted(entries, key=lambda e: (-e[0], e[1]))[:size]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(-3, 3), st.booleans()), min_size=7, max_size=7), min_size=1, max_size=6),
       st.sampled_from([1, 1 << 60]), st.integers(1, 9))
def test_heaps(lines, scale, size):
    scores = np.array([[s * scale for s, _ in line] for line in lines], np.int64)
    fits = np.array([[f for _, f in line] for line in lines])
    idents = np.arange(10, 17)
    heaps = negatives.Heaps(len(lines), size)
    for part in (slice(0, 3), slice(3, 4), slice(4, 7)):
        heaps.merge(negatives.Heaps.of_tile(scores[:, part], idents[part], fits[:, part], size), slice(0, len(lines)))
    for line in range(len(lines)):
        held = heaps.held[line]
        got = list(zip(heaps.scores[line][held].tolist(), heaps.idents[line][held].tolist()))
        assert got == best([(s, i) for s, i, f in zip(scores[line].tolist(), idents.tolist(), fits[line]) if f], size)


def plain(rows, positives=5, negative_count=5, percent=80):
    kept = []
    for ident, vector, label in rows:
        if ident is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((ident, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for ident, vector, label in kept:
        if ident % 100:
            continue
        scored = [(sum(x * y for x, y in zip(vector, other)), i, other_label) for i, other, other_label in kept if i != ident]
        for top, positive, _ in best([s for s in scored if s[2] == label], positives):
            window = [s for s in scored if s[2] != label and percent * top <= 100 * s[0] <= 100 * top]
            for rank, (score, negative, _) in enumerate(best(window, negative_count), 1):
                out.append((ident, positive, rank, negative, top, score))
    return out


def mined(spark, rows, schema=SCHEMA, **options):
    frame = spark.createDataFrame(rows, schema).withColumns({c: F.lit("?") for c in ("ident", "vector", "number", "share", "cell")})
    out = negatives.mine(frame.repartition(3), F.col("vec_id") % 100 == 0, **options)
    return sorted(map(tuple, out.collect()))


def vectors(rng, n, dimension=6):
    return [(i, [rng.choice([0.0, 0.25, 0.5, -0.125, rng.random()]) for _ in range(dimension)], rng.randrange(3))
            for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 100}, {"positives": 2, "negatives": 1, "percent": 0}])
def test_mining(spark, options, monkeypatch):
    monkeypatch.setattr(negatives, "SHARE_ROWS", 30)  # several shares
    rng = random.Random(5)
    rows = vectors(rng, 700)
    want = plain(rows, options.get("positives", 5), options.get("negatives", 5), options.get("percent", 80))
    assert mined(spark, rows, **options) == sorted(want) and len(want) > 10


def test_awkward_rows(spark):
    rng = random.Random(6)
    nan, endless = float("nan"), float("inf")
    same = [(i, [0.5, 0.5], i % 2) for i in range(1_000, 1_300)]  # a third of all rows is one vector
    odd = [(None, [0.5, 0.5], 1), (1, None, 1), (2, [0.5, None], 1), (3, [nan, 0.5], 0), (4, [endless, 1.0], 0),
           (5, [0.5, 0.5], None), (6, [], 0), (7, [1.0], 1), (8, [0.5, 0.5, 0.0], 0), (100, [], 1), (200, [nan], 1),
           (300, [-0.5, 0.25], 2)]
    rows = same + odd + [(i, [rng.random(), rng.random()], rng.randrange(2)) for i in range(400, 900)]
    assert mined(spark, rows) == sorted(plain(rows))
    doubled = rows + rows[::7]
    assert mined(spark, doubled) == sorted(plain(doubled))


def test_no_partners_and_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1)]) == []  # no other label
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor


def test_scores_beyond_64_bits_stop_the_run(spark):
    with pytest.raises(Exception, match="too large for exact 64-bit scores"):
        mined(spark, [(100, [1e9], 1), (1, [1e9], 1), (2, [1e9], 2)], "vec_id bigint, embedding array<double>, label int")
