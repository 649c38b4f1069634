"""Substring dedup over words: long runs of words that start anywhere else are taken out.

The words are a De Bruijn graph whose edges are the k-mers, k as long as a window, and whose nodes are the
k-1 words that two neighbouring edges share:

1. ``edges``: every chunk of documents sends its edges, each once, to buckets, with a hash of the edges
   before and after it. An edge is repeated if it occurs twice, and branching if its neighbours differ.
2. Repeated edges that do not branch are compacted: neighbours in a document make one path, the same in
   all documents that have any of it. A branching edge is a path of its own. Paths are cut every so many
   edges from their start, which bounds them and is alike wherever they stand.
3. ``paths``: each chunk sends the words of its paths as they stand at their source coordinates, each once
   with the number of its places, and Spark groups them by these words. A path met once in all was
   repeated by its hash alone; it goes back to its chunk and is left in the text.
4. The chunks mark the coordinates of all other paths and take the marked words out.

So what is taken out has been compared word by word. What hashes could still do is hide a branching: two
neighbourhoods of one edge with the same 40 bits would part the path in one place and not in the other.
A chunk sends each edge and path once, so a passage that a third of all rows share is one row per chunk.
The chunk is read again for each step, so the documents have to be a stored table.

Words are what ASCII white space leaves between. Null text has none. Texts shorter than a window keep
all words. Repeated rows are documents of their own and take each other's windows out. An empty table
gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import buckets, mixed, prepared, window_hashes, word_spans, written, BETWEEN_SPACES
from armlens.llm.repeats import (
    CHUNK_BYTES, CODES, KEY, SENT, Chunk, Words, _codes_of, _keys, _pack, _unpack, chunked, distinct,
    from_low_bytes, sent_rows,
)

WINDOW = 35
PATH_EDGES = 1024  # of a path sent in one piece
REPEATED, BRANCHING = 1, 2  # codes of edges
PATHS = f"{KEY}, place int, n bigint, words binary"


def _graded(rows: pa.Table) -> pa.Table:
    """Codes for the edges of one bucket, from all chunks that sent some."""
    keys = [from_low_bytes(k) for k in rows["keys"].to_pylist()]
    sizes = np.array([len(k) for k in keys])
    key = np.concatenate(keys)
    path = np.concatenate([from_low_bytes(p) for p in rows["paths"].to_pylist()])
    several = np.concatenate([
        np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(rows["several"].to_pylist(), sizes)])
    by = np.lexsort((path, key))
    k, p = key[by], path[by]
    heads = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    counts = np.diff(np.append(heads, len(k)))
    low, high = p[heads], p[heads + counts - 1]  # in order within an edge
    repeated = np.add.reduceat(1 + several[by].astype(np.int64), heads) > 1
    code = np.where(repeated, REPEATED, 0) | np.where((low != high) | (low == 0), BRANCHING, 0)
    codes = np.empty(len(k), np.uint8)
    codes[by] = np.repeat(code, counts)
    ends = np.cumsum(sizes)
    return pa.table([rows["part"], rows["seq"], rows["digest"], rows["bucket"],
                     pa.array([_pack(codes[a:b]) for a, b in zip(ends - sizes, ends)], pa.binary())],
                    names=["part", "seq", "digest", "bucket", "codes"])


class Graph:
    """The edges of a chunk: hash, document and first word of each."""

    def __init__(self, chunk: Chunk, window: int, parts: int):
        self.chunk, self.window = chunk, window
        hashes, rows, starts, self.counts = [], [], [], []
        for first, data, offsets in chunk.slices():
            words = Words(data, offsets)
            of = np.repeat(np.arange(len(offsets) - 1), np.diff(words.bounds))
            at = np.arange(max(0, len(of) - window + 1))
            at = at[of[at] == of[at + window - 1]] if len(at) else at
            hashes.append(window_hashes(words.hashes, at, window))
            rows.append(of[at] + first)
            starts.append(at)
            self.counts.append(len(at))
        self.start, row = np.concatenate(starts), np.concatenate(rows)
        edge = np.concatenate(hashes)
        self.follows = np.zeros(len(edge), bool)  # the edge before is of the same document
        self.follows[1:] = row[1:] == row[:-1]
        before, after = np.zeros_like(edge), np.zeros_like(edge)
        before[1:][self.follows[1:]] = edge[:-1][self.follows[1:]]
        after[:-1][self.follows[1:]] = edge[1:][self.follows[1:]]
        around = mixed(before + np.uint64(0x632BE59BD9B4E019)) ^ mixed(mixed(after) + np.uint64(0x9E3779B97F4A7C15))
        self.sent = distinct(edge, np.zeros(len(edge), np.int64), parts, around)

    def compacted(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last edge of every path."""
        code = codes[self.sent.member]
        repeated, branching = code & REPEATED > 0, code & BRANCHING > 0
        joined = np.zeros(len(code) + 1, bool)  # with the edge before, in one path
        plain = repeated & ~branching
        joined[1:-1] = self.follows[1:] & plain[1:] & plain[:-1]
        heads = np.flatnonzero(repeated & ~joined[:-1])
        tails = np.flatnonzero(repeated & ~joined[1:])
        pieces = (tails - heads) // PATH_EDGES + 1
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(heads, pieces) + within * PATH_EDGES
        return first, np.minimum(first + PATH_EDGES - 1, np.repeat(tails, pieces))

    def slices(self) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
        """First row, first and last edge (one more), bytes and bounds of the slices."""
        high = 0
        for (row, data, offsets), n in zip(self.chunk.slices(), self.counts):
            yield row, high, high + n, data, offsets
            high += n

    def paths(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[bytes, int]]:
        """First and last edge and place of every path, and the place of each distinct run of words."""
        first, last = self.compacted(codes)
        place, places = np.empty(len(first), np.int64), {}
        for _, low, high, data, offsets in self.slices():
            a, b = np.searchsorted(first, (low, high))
            if a == b:
                continue
            starts, ends, _ = word_spans(data, offsets, BETWEEN_SPACES)
            begin, end = starts[self.start[first[a:b]]], ends[self.start[last[a:b]] + self.window - 1]
            whole = data.tobytes()
            for i, x, y in zip(range(a, b), begin.tolist(), end.tolist()):
                place[i] = places.setdefault(b" ".join(whole[x:y].split()), len(places))
        return first, last, place, places


def _render(ids, data, bounds, marked, offsets) -> pa.RecordBatch:
    whole = data.tobytes()
    kept, removed = [], []
    for row in range(len(offsets) - 1):
        words = whole[offsets[row]:offsets[row + 1]].split()
        marks = marked[bounds[row]:bounds[row + 1]]
        removed.append(int(marks.sum()))
        if removed[-1]:
            words = [w for w, gone in zip(words, marks.tolist()) if not gone]
        kept.append(b" ".join(words))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(bounds), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
        names=["ident", "n_words", "n_removed", "kept"])


def remove_repeated_spans(docs: DataFrame, ident: str = "doc_id", text: str = "text",
                          window: int = WINDOW, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Identifier, n_words, n_removed and ``kept``: the other words, joined by one space, in UTF-8."""
    spark = prepared(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]
    parts = buckets(spark)
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"))

    def edges(batches):
        for part in chunked(batches, chunk):
            yield sent_rows(part, Graph(part, window, parts).sent, False)

    def texts(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for part in chunked(batches, chunk):
            yield pa.RecordBatch.from_arrays(
                [*_keys(part.key, 1), pa.array([part.ids.to_pylist()], pa.list_(part.ids.type)),
                 pa.array([_pack(part.offsets)], pa.binary()),
                 pa.array([squeeze.compress(part.data.tobytes())], pa.binary())],
                names=["part", "seq", "digest", "ids", "offsets", "texts"])

    def graph(table: pa.Table) -> tuple[Graph, tuple]:
        row = table.filter(pc.equal(table["step"], 0))
        if row.num_rows != 1:
            raise RuntimeError("the documents read differently in two steps; store them first")
        part = Chunk((row["part"][0].as_py(), row["seq"][0].as_py(), row["digest"][0].as_py()),
                     row["ids"].combine_chunks().flatten(), _unpack(row["texts"][0].as_py(), np.uint8),
                     _unpack(row["offsets"][0].as_py(), np.int64))
        whole = Graph(part, window, parts)
        return whole, whole.paths(_codes_of(table, 1, whole.sent))

    def paths(table: pa.Table) -> pa.Table:
        whole, (_, _, place, places) = graph(table)
        return pa.table([*_keys(whole.chunk.key, len(places)), pa.array(np.arange(len(places), dtype=np.int32)),
                         pa.array(np.bincount(place, minlength=len(places)).astype(np.int64)),
                         pa.array(list(places), pa.binary())],
                        names=["part", "seq", "digest", "place", "n", "words"])

    def rendered(table: pa.Table) -> pa.Table:
        whole, (first, last, place, places) = graph(table)
        alone = np.zeros(len(places), bool)
        alone[table.filter(pc.equal(table["step"], 2))["place"].to_numpy()] = True
        first, last = first[~alone[place]], last[~alone[place]]
        out = []
        for row, low, high, data, offsets in whole.slices():
            bounds = Words(data, offsets).bounds
            change = np.zeros(int(bounds[-1]) + 1, np.int64)
            a, b = np.searchsorted(first, (low, high))
            np.add.at(change, whole.start[first[a:b]], 1)
            np.add.at(change, whole.start[last[a:b]] + window, -1)
            out.append(_render(whole.chunk.ids.slice(row, len(offsets) - 1), data, bounds,
                               np.cumsum(change[:-1]) > 0, offsets))
        return pa.Table.from_batches(out)

    key = ["part", "seq", "digest"]
    corpus = rows.mapInArrow(texts, f"{KEY}, ids array<{kind}>, offsets binary, texts binary").withColumn("step", F.lit(0))
    graded = written(rows.mapInArrow(edges, SENT).groupBy("bucket").applyInArrow(_graded, CODES), "edge_codes")
    known = corpus.unionByName(graded.withColumn("step", F.lit(1)), allowMissingColumns=True)
    met = known.groupBy(*key).applyInArrow(paths, PATHS).groupBy("words").agg(
        F.sum("n").alias("n"), *[F.min(c).alias(c) for c in (*key, "place")])
    alone = written(met.filter("n = 1").select(*key, "place"), "paths_alone").withColumn("step", F.lit(2))
    out = known.unionByName(alone, allowMissingColumns=True).groupBy(*key).applyInArrow(
        rendered, f"ident {kind}, n_words bigint, n_removed bigint, kept binary")
    return out.withColumnRenamed("ident", ident)
