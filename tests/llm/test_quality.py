from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from armlens.llm import quality
from armlens.llm.common import text_bytes
from tests.llm.texts import awkward, frame, prose

import pyarrow as pa


def figures(texts):
    return quality.features(*text_bytes(pa.array(texts)))


def corpus(seed=1, n=400):
    """Good prose, and three kinds of poor text."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text, y = prose(rng, rng.randint(20, 200)), 1
        if i % 5 == 0:
            text, y = rng.choice((text.upper().replace(" ", "!! "), "same " * 80, text.replace(" ", " | "))), 0
        rows.append((i, text))
        labels.append((i, y))
    return rows, labels


def test_figures_do_not_depend_on_neighbours():
    texts = [t or "" for _, t in awkward(random.Random(2))]
    together = figures(texts)
    assert np.isfinite(together).all()
    for i, text in enumerate(texts):
        assert np.allclose(figures([text])[0], together[i])


def test_figures_of_a_known_text():
    x = dict(zip(quality.FEATURES, figures(["One two two\nOne two two\nA1 | b!"])[0]))
    assert x["log_words"] == pytest.approx(np.log1p(9)) and x["distinct_words"] == pytest.approx(5 / 9)
    assert x["repeated_word"] == pytest.approx(2 / 9) and x["repeated_lines"] == pytest.approx(1 / 3)
    assert x["bars"] == pytest.approx(1 / 9) and x["exclaims"] == pytest.approx(1 / 9)


def test_held_out_rows_are_judged_but_not_learnt_from(spark):
    rows, labels = corpus()
    docs = frame(spark, rows)
    known = spark.createDataFrame([(*x, "?") for x in labels], "doc_id bigint, quality int, score string")
    out = {r["doc_id"]: r for r in quality.score_quality(docs, known).collect()}
    assert len(out) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out.values())
    unseen = [(out[i]["predicted"], y) for i, y in labels if out[i]["held_out"]]
    assert np.mean([p == y for p, y in unseen]) > 0.9
    # Other labels on held-out rows change nothing.
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, "?") for i, y in labels]
    again = quality.score_quality(docs, spark.createDataFrame(turned, known.schema)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {i: r["score"] for i, r in out.items()}


def test_weights_solve_the_pairwise_loss():
    rng = np.random.default_rng(0)
    better, worse = rng.normal(0.5, 1, (300, len(quality.FEATURES))), rng.normal(0, 1, (100, len(quality.FEATURES)))
    model = quality.fit(better, worse, pairs=5_000)
    a, b = model.strengths(better), model.strengths(worse)
    assert np.mean(a[:, None] > b[None, :]) > 0.85
    below = np.mean(np.concatenate((a, b)) < model.threshold)
    assert below == pytest.approx(0.25, abs=0.02)  # the share of label 0


def test_expression_and_matrix_scores_agree(spark):
    rows, labels = corpus(3, 120)
    x = figures([t for _, t in rows])
    y = np.array([v for _, v in labels])
    model = quality.fit(x[y == 1], x[y == 0])
    strengths = model.strengths(x)
    z = (strengths - model.threshold) * model.slope + np.log(quality.CUT / (1 - quality.CUT))
    out = quality.featured(frame(spark, rows)).select("doc_id", model.score().alias("s")).collect()
    assert np.allclose([r["s"] for r in sorted(out)], 1 / (1 + np.exp(-z)), atol=1e-4)


def test_the_threshold_is_a_quantile_of_all_labels_whatever_the_sample(spark):
    rng = random.Random(8)
    rows, labels = corpus(6, 500)
    labels = [(i, y if rng.random() < 0.6 else rng.randrange(2)) for i, y in labels]
    docs, known = frame(spark, rows), spark.createDataFrame(labels + [(10_000 + i, 0) for i in range(300)], "doc_id bigint, quality int")
    usable = {i: y for i, y in labels if zlib.crc32(str(i).encode()) % 5}
    for sample in (25, 8_000):
        out = {r["doc_id"]: r["predicted"] for r in quality.score_quality(docs, known, sample=sample).collect()}
        assert sum(out[i] == 0 for i in usable) == sum(y == 0 for y in usable.values())
        kept = {r["doc_id"] for r in quality.keep_good(docs, known, sample=sample).collect()}
        assert kept == {i for i, predicted in out.items() if predicted}


def test_values_at_ranks_are_exact(spark):
    rng = random.Random(9)
    values = [rng.choice((rng.gauss(0, 1), 0.5, 1e9, 0.5 + rng.random() * 1e-12)) for _ in range(400)]
    table = spark.createDataFrame([(v,) for v in values], "s double").cache()
    for rank in (0, 7, 150, 200, 399):
        assert quality.value_at(table, rank) == sorted(values)[rank]
    table.unpersist()


@pytest.mark.parametrize("labels", [[], [(1, 1), (6, 1)], [(None, 0), (4, None)]])
def test_without_pairs_every_document_stays(spark, labels):
    rows = awkward(random.Random(4))
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    out = quality.score_quality(frame(spark, rows), known).collect()
    assert len(out) == len(rows) and {r["predicted"] for r in out} == {1}
    assert quality.keep_good(frame(spark, rows), known).count() == len(rows)


def test_kept_rows_are_those_predicted_good(spark):
    rows, labels = corpus(5, 200)
    docs, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")
    kept = quality.keep_good(docs, known)
    good = quality.score_quality(docs, known).filter("predicted = 1")
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in good.collect()}


def test_empty_table(spark):
    known = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    assert quality.score_quality(frame(spark, []), known).collect() == []


def plain_model(x, y, usable):
    """A plain fit: every pair of a good and a poor text, the logistic loss at its least."""
    good, bad = x[usable & (y == 1)], x[usable & (y == 0)]
    both = np.concatenate((good, bad))
    scale = np.where(both.std(0) > 1e-9, both.std(0), 1.0)

    def expanded(rows):
        z = np.clip((rows - both.mean(0)) / scale, -4, 4)
        return np.concatenate((z, z * z), 1)

    a, b = expanded(good), expanded(bad)
    differences = (a[:, None] - b[None]).reshape(-1, a.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-differences @ w))
        curve = (differences * (p * (1 - p))[:, None]).T @ differences / len(differences) + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(curve, differences.T @ (p - 1) / len(differences) + 1e-3 * w)
    return expanded(x) @ w


def test_scores_are_those_of_a_plain_fit_over_all_pairs(spark):
    rng = random.Random(15)
    rows, labels = corpus(14, 300)
    labels = [(i, 1 - v if rng.random() < 0.1 else v) for i, v in labels]  # so that weights stay small
    x, y = figures([t for _, t in rows]), np.array([v for _, v in labels])
    usable = np.array([zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in rows])
    strength = plain_model(x, y, usable)
    limit = np.sort(strength[usable])[np.sum(y[usable] == 0) - 1]
    out = {r["doc_id"]: r for r in quality.score_quality(
        frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()}
    scores = np.array([out[i]["score"] for i, _ in rows])
    ranks = lambda v: np.argsort(np.argsort(v))
    assert np.corrcoef(ranks(scores), ranks(strength))[0, 1] > 0.98
    predicted = np.array([out[i]["predicted"] for i, _ in rows])
    assert np.mean(predicted == (strength > limit)) > 0.97
