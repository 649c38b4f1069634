from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from armlens.llm import repeats, substrings, suffixes
from tests.llm.texts import awkward, frame, prose


def plain_words(rows, window):
    docs = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in docs for i in range(len(w) - window + 1))
    for (ident, _), w in zip(rows, docs):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        yield ident, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)


def plain_bytes(rows, window):
    least = {}
    order = lambda i: -1 if i is None else i
    for ident, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - window + 1):
            s = b[i:i + window]
            least[s] = min(least.get(s, order(ident)), order(ident))
    for ident, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if least[b[i:i + window]] < order(ident):
                gone[i:i + window] = b"\1" * window
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        yield ident, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)


def passages(seed):
    """Overlapping, nested and adjoining repeats."""
    rng = random.Random(seed)
    shared = [prose(rng, n, 60) for n in (15, 40, 80, 120)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(4):
            words = rng.choice(shared).split()
            a = rng.randrange(len(words))
            parts += [" ".join(words[a:a + rng.randint(5, 90)]), prose(rng, rng.randint(0, 12), 60)]
        rows.append((rng.randrange(45), rng.choice((" ", "\n", "  ")).join(parts)))
    return rows


def listed(rows):
    return sorted(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in map(tuple, rows)) if all(
        r[0] is not None for r in rows) else sorted(
        (tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in map(tuple, rows)), key=repr)


@pytest.mark.parametrize("rows", [awkward(random.Random(3)), passages(1), passages(2)])
@pytest.mark.parametrize("chunk", [3_000, repeats.CHUNK_BYTES])
def test_words_and_bytes(spark, rows, chunk):
    """In one chunk, and in many chunks on several tasks."""
    docs = frame(spark, rows)
    words = substrings.remove_repeated_spans(docs, chunk=chunk).collect()
    assert listed(words) == listed(list(plain_words(rows, 35)))
    cut = suffixes.remove_earlier_strings(docs, chunk=chunk).collect()
    assert listed(cut) == listed(list(plain_bytes(rows, 50)))


def test_short_windows(spark):
    rows = passages(7)
    out = substrings.remove_repeated_spans(frame(spark, rows), window=6).collect()
    want = Counter((i, n, r) for i, n, r, _ in plain_words(rows, 6))
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in out) == want


def test_paths_longer_than_a_piece_and_words_in_circles(spark):
    rng = random.Random(11)
    long, circle = prose(rng, 5_000, 400), "round and " * 3_000
    middle = " ".join(long.split()[700:4_000])
    rows = [(1, long), (2, "x " + long + " y"), (3, middle), (4, circle), (5, circle[:400]), (6, prose(rng, 90, 400))]
    for chunk in (20_000, repeats.CHUNK_BYTES):
        out = substrings.remove_repeated_spans(frame(spark, rows), chunk=chunk).collect()
        assert listed(out) == listed(list(plain_words(rows, 35)))


def test_paths_are_the_same_wherever_they_stand():
    """Of a passage in two documents: its ends branch, between them is one path."""
    rng = random.Random(12)
    passage = prose(rng, 60, 400)
    texts = [f"{prose(rng, 50, 400)} {passage} {prose(rng, 50, 400)}" for _ in range(2)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    chunk = repeats.Chunk((0, 0, 0), pa.array([1, 2]), data, np.cumsum([0] + [len(t.encode()) for t in texts]))
    graph = substrings.Graph(chunk, 35, 4)
    met, at = graph.sent.bounds()
    rows = substrings._graded(pa.Table.from_batches([repeats.sent_rows(chunk, graph.sent, False)]).slice(0, 1))
    assert rows.num_rows == 1 and len(repeats._unpack(rows["codes"][0].as_py(), np.uint8)) == at[1]
    several = graph.sent.several
    codes = np.where(several, substrings.REPEATED, 0) | np.where(graph.sent.path == 0, substrings.BRANCHING, 0)
    first, last, place, places = graph.paths(codes.astype(np.uint8))
    assert list((last - first + 1)[:3]) == [1, 24, 1] and len(first) == 6 and len(places) == 3
    assert np.bincount(place).tolist() == [2, 2, 2]
    # Edges that were taken for repeated by their hash alone are paths of one place.
    first, last, place, places = graph.paths(np.full(len(several), substrings.REPEATED, np.uint8))
    assert len(places) == len(first) == 2


def test_empty_table(spark):
    assert substrings.remove_repeated_spans(frame(spark, [])).collect() == []
    assert suffixes.remove_earlier_strings(frame(spark, [])).collect() == []


def test_identifiers_have_to_be_ordered_numbers(spark):
    with pytest.raises(TypeError):
        suffixes.remove_earlier_strings(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
