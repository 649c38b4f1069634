"""Windows that repeat: which runs of ``window`` symbols start more than once in a corpus.

Symbols are words or bytes. Each window is known by an anchor, the ``kmer`` symbols in it whose hash is
smallest: equal windows have equal anchors at equal places, and neighbouring windows mostly share one.
An anchor with the run of windows around it is called an edge. Corpus-wide comparisons see one short row per
such edge and chunk, not one per window:

1. ``edges``: every chunk of documents sends its edges, each anchor once, to buckets of anchors.
2. ``compare edges``: an anchor with the same path everywhere needs no more; its windows repeat or not as
   a whole. An anchor with several paths is a branching, and the chunks are told so.
3. ``windows``: chunks send the windows of branching anchors, each once, to buckets of windows, where
   they are compared one by one.
4. The chunks get the answers, mark the source coordinates that repeat, and take the marked out.

Answers come back as one code per row sent, in the order sent, so coordinates never travel. Texts travel
compressed, chunk by chunk. A chunk sends each key once however often it has it, so a passage that a
third of all rows share, or a group of copies, is at most one row per chunk. The chunk is read again for
each step, so the documents have to be a stored table; a chunk that reads differently stops the run.

Keys are hashes. An edge is known by eighty bits and a window by 56, beside those of its bucket; the
number of buckets follows the data, so the chance that a row meets a false equal stays about the rows of
a bucket in 10^16 at every size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import (
    BETWEEN_SPACES, buckets, byte_values, mixed, prepared, run_hashes, slices, text_bytes, window_hashes,
    word_hashes, word_spans, written,
)

CHUNK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
KEY_BYTES, WINDOW_BYTES = 5, 7  # of a hash beside its bucket
WHOLE, SPLIT = 1, 2  # codes: every window repeats; the windows have to be compared


# ---- symbols ----------------------------------------------------------------------------------------

class Bytes:
    """The bytes of the texts of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.bounds, self._values = data, offsets, None

    def kmers(self, k: int) -> np.ndarray:
        """Hash of the ``k`` bytes from each place, 8 to 16 of them, as two overlapping loads."""
        n = len(self.data) - k + 1
        loads = np.lib.stride_tricks.as_strided(
            np.concatenate((self.data, np.zeros(8, np.uint8)))[:len(self.data) + 8].view(), (len(self.data), 8), (1, 1))
        loads = np.ascontiguousarray(loads).view(np.uint64).ravel()
        return mixed(loads[:n] * np.uint64(0x9E3779B97F4A7C15) + (loads[k - 8:k - 8 + n] ^ np.uint64(0x5851F42D4C957F2D))
                     * np.uint64(0xD6E8FEB86659FD93))

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self._values is None:
            self._values = byte_values(self.data)
        return run_hashes(self._values, starts, ends)


class Words:
    """The words between white space of the texts of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, rows = word_spans(data, offsets, BETWEEN_SPACES)
        self.bounds = np.searchsorted(rows, np.arange(len(offsets)))
        self.hashes = word_hashes(data, starts, ends)

    def kmers(self, k: int) -> np.ndarray:
        return window_hashes(self.hashes, np.arange(len(self.hashes) - k + 1), k)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return run_hashes(self.hashes, starts, ends, 0xA0761D6478BD642F)


@dataclass(frozen=True)
class Rule:
    """``ordered``: a window counts where a document with a smaller identifier has it; else where it
    starts anywhere else."""

    symbols: type
    window: int
    kmer: int
    ordered: bool
    chunk: int = CHUNK_BYTES


@dataclass
class Paths:
    """Runs of windows with one anchor: first and last window start, anchor, path and row of each."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    path: np.ndarray
    row: np.ndarray


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    span, low = 1, keys
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def paths_of(symbols, rule: Rule) -> Paths:
    bounds, w = symbols.bounds, rule.window
    n = int(bounds[-1])
    if n < w:
        none = np.zeros(0, np.int64)
        return Paths(none, none, none.astype(np.uint64), none.astype(np.uint64), none)
    rows = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    hashes = symbols.kmers(rule.kmer)
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    place = smallest(keys, w - rule.kmer + 1).astype(np.uint32)  # the low half: leftmost smallest
    starts = np.flatnonzero(rows[:n - w + 1] == rows[w - 1:])
    place = place[starts].astype(np.int64)
    new = np.ones(len(starts) + 1, bool)
    new[1:-1] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(new[:-1])
    first, last, place = starts[heads], starts[np.flatnonzero(new[1:])], place[heads]
    path = symbols.runs(first, last + w) ^ mixed((place - first).astype(np.uint64))
    return Paths(first, last, hashes[place], path, rows[first].astype(np.int64))


# ---- chunks of documents ----------------------------------------------------------------------------

@dataclass
class Chunk:
    key: tuple[int, int, int]
    ids: pa.Array
    data: np.ndarray
    offsets: np.ndarray

    @property
    def order(self) -> np.ndarray:
        """Identifiers as numbers; null is smaller than any."""
        return self.ids.cast(pa.int64()).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)

    def slices(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for a, b in slices(self.offsets, SLICE_BYTES):
            low = self.offsets[a]
            yield a, self.data[low:self.offsets[b]], self.offsets[a:b + 1] - low


def chunked(batches, size: int) -> Iterator[Chunk]:
    """Neighbouring documents of a task, about ``size`` bytes at a time."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    ids: list[pa.Array] = []
    texts: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    seq = 0

    def chunk() -> Chunk:
        data = np.concatenate(texts)
        lengths = np.concatenate(sizes)
        digest = xxhash.xxh64_intdigest(data, 1) ^ xxhash.xxh64_intdigest(lengths, 2)
        return Chunk((part, seq, digest - (1 << 63)), pa.concat_arrays(ids), data,
                     np.concatenate(([0], np.cumsum(lengths))))

    held = 0
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for a, b in slices(offsets, min(SLICE_BYTES, size)):
            ids.append(batch.column("ident").slice(a, b - a))
            texts.append(data[offsets[a]:offsets[b]].copy())
            sizes.append(np.diff(offsets[a:b + 1]))
            held += len(texts[-1])
            if held >= size:
                yield chunk()
                ids, texts, sizes, held, seq = [], [], [], 0, seq + 1
    if ids:
        yield chunk()


KEY = "part int, seq int, digest bigint"


def _pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(array.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


# ---- what a chunk sends -------------------------------------------------------------------------------

@dataclass
class Sent:
    """Distinct keys of a chunk in the order sent; ``member`` tells the key of every input row."""

    bucket: np.ndarray
    key: np.ndarray
    member: np.ndarray
    order: np.ndarray  # smallest identifier
    several: np.ndarray  # more than one occurrence
    path: np.ndarray | None = None  # 0: several paths

    width: int = KEY_BYTES

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """The buckets met and where each begins (one more at the end)."""
        heads = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        return self.bucket[heads], np.append(heads, len(self.bucket))


def distinct(hashes: np.ndarray, order: np.ndarray, parts: int, path: np.ndarray | None = None,
             weight: np.ndarray | None = None, width: int = KEY_BYTES) -> Sent:
    bucket = hashes % np.uint64(parts)
    rest = (hashes // np.uint64(parts)) & np.uint64((1 << 8 * width) - 1)
    by = np.lexsort((rest, bucket))
    new = np.ones(len(by), bool)
    new[1:] = (rest[by[1:]] != rest[by[:-1]]) | (bucket[by[1:]] != bucket[by[:-1]])
    heads = np.flatnonzero(new)
    member = np.empty(len(by), np.int64)
    member[by] = np.cumsum(new) - 1
    if not len(by):
        empty = np.zeros(0, np.int64)
        return Sent(empty, empty.astype(np.uint64), member, empty, empty.astype(bool), empty.astype(np.uint64), width)
    counts = np.diff(np.append(heads, len(by)))
    several = counts > 1
    if weight is not None:
        several |= np.maximum.reduceat(weight[by], heads) > 1
    single = None
    if path is not None:
        low, high = np.minimum.reduceat(path[by], heads), np.maximum.reduceat(path[by], heads)
        single = np.where(low == high, (low >> np.uint64(64 - 8 * KEY_BYTES)) | np.uint64(1), np.uint64(0))
    return Sent(bucket[by[heads]].astype(np.int64), rest[by[heads]], member,
                np.minimum.reduceat(order[by], heads), several, single, width)


def low_bytes(x: np.ndarray, width: int = KEY_BYTES) -> bytes:
    """The ``width`` lowest bytes of numbers, place by place, which compresses well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_low_bytes(data: bytes, width: int = KEY_BYTES) -> np.ndarray:
    x = np.frombuffer(data, np.uint8)
    out = np.zeros((len(x) // width, 8), np.uint8)
    out[:, :width] = x.reshape(width, -1).T
    return out.view("<u8").ravel()


SENT = f"{KEY}, bucket int, keys binary, paths binary, orders binary, several binary"


def sent_rows(chunk: Chunk, sent: Sent, ordered: bool) -> pa.RecordBatch:
    met, at = sent.bounds()
    cut = list(zip(at[:-1], at[1:]))
    rows = len(cut)
    nothing = [b""] * rows
    return pa.RecordBatch.from_arrays(
        [*_keys(chunk.key, rows), pa.array(met, pa.int32()),
         pa.array([low_bytes(sent.key[a:b], sent.width) for a, b in cut], pa.binary()),
         pa.array([low_bytes(sent.path[a:b]) for a, b in cut] if sent.path is not None else nothing, pa.binary()),
         pa.array([_pack(sent.order[a:b].astype("<i8").view(np.uint8).reshape(-1, 8).T) for a, b in cut]
                  if ordered else nothing, pa.binary()),
         pa.array([np.packbits(sent.several[a:b]).tobytes() for a, b in cut], pa.binary())],
        names=["part", "seq", "digest", "bucket", "keys", "paths", "orders", "several"])


def _keys(key: tuple[int, int, int], rows: int) -> list[pa.Array]:
    return [pa.array([k] * rows, kind) for k, kind in zip(key, (pa.int32(), pa.int32(), pa.int64()))]


CODES = f"{KEY}, bucket int, codes binary"


def compared(ordered: bool, paths: bool) -> Callable[[pa.Table], pa.Table]:
    """Codes for the keys of one bucket, from all chunks that sent some."""

    def compare(rows: pa.Table) -> pa.Table:
        keys = [from_low_bytes(k, KEY_BYTES if paths else WINDOW_BYTES) for k in rows["keys"].to_pylist()]
        sizes = np.array([len(k) for k in keys])
        key = np.concatenate(keys)
        several = np.concatenate([
            np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(rows["several"].to_pylist(), sizes)])
        order = np.concatenate([
            np.ascontiguousarray(_unpack(o, np.uint8).reshape(8, -1).T).view("<i8").ravel()
            for o in rows["orders"].to_pylist()]) if ordered else np.zeros(len(key), np.int64)
        path = np.concatenate([from_low_bytes(p) for p in rows["paths"].to_pylist()]) \
            if paths else np.ones(len(key), np.uint64)
        codes = _codes(key, path, order, several, ordered)
        ends = np.cumsum(sizes)
        cut = [codes[a:b] for a, b in zip(ends - sizes, ends)]
        return pa.table([rows["part"], rows["seq"], rows["digest"], rows["bucket"],
                         pa.array([_pack(c) for c in cut], pa.binary())],
                        names=["part", "seq", "digest", "bucket", "codes"])

    return compare


def _codes(key, path, order, several, ordered: bool) -> np.ndarray:
    by = np.lexsort((order, path, key))
    k, p, o, s = key[by], path[by], order[by], several[by].astype(np.int64)
    new_key = np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new_path = new_key.copy()
    new_path[1:] |= p[1:] != p[:-1]
    group, variant = np.cumsum(new_key) - 1, np.cumsum(new_path) - 1
    heads = np.flatnonzero(new_path)
    branching = (np.bincount(group[heads]) > 1)[group] | (np.bincount(group, p == 0) > 0)[group]
    if ordered:
        repeats = o > o[heads][variant]
        first = ~repeats
    else:
        repeats = (np.bincount(variant, 1 + s) > 1)[variant]
        first = new_path
    mixed_paths = p == 0
    code = np.where(repeats & ~mixed_paths, WHOLE, 0) | np.where(branching & (first | mixed_paths), SPLIT, 0)
    out = np.empty(len(k), np.uint8)
    out[by] = code
    return out


# ---- a chunk with its answers -------------------------------------------------------------------------

class Work:
    """The edges of a chunk and, once these are answered, its windows."""

    def __init__(self, chunk: Chunk, rule: Rule, parts: int):
        self.chunk, self.rule, self.parts = chunk, rule, parts
        self.order = chunk.order if rule.ordered else np.zeros(len(chunk.ids), np.int64)
        found = [(row, paths_of(rule.symbols(x, o), rule)) for row, x, o in chunk.slices()]
        join = lambda name: np.concatenate([getattr(p, name) for _, p in found])
        self.first, self.last = join("first"), join("last")
        self.counts = [len(p.first) for _, p in found]
        self.row = np.concatenate([p.row + row for row, p in found])
        self.edges = distinct(join("anchor"), self.order[self.row], parts, join("path"))

    def windows(self, codes: np.ndarray) -> Sent:
        """Windows of the edges that have to be compared; keeps where each starts."""
        code = codes[self.edges.member]
        chosen = np.flatnonzero(code & SPLIT)
        lengths = self.last[chosen] - self.first[chosen] + 1
        self.owner = np.repeat(chosen, lengths)
        within = np.arange(len(self.owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.start = self.first[self.owner] + within
        hashes = np.zeros(len(self.owner), np.uint64)
        ends = np.cumsum(self.counts)
        for (_, x, o), low, high in zip(self.chunk.slices(), ends - np.array(self.counts, int), ends):
            a, b = np.searchsorted(self.owner, (low, high))
            if a < b:
                hashes[a:b] = self.rule.symbols(x, o).runs(self.start[a:b], self.start[a:b] + self.rule.window)
        single = self.edges.path[self.edges.member[self.owner]] != 0
        weight = np.where(single & (code[self.owner] & WHOLE > 0), 2, 1)
        return distinct(hashes, self.order[self.row[self.owner]], self.parts, weight=weight, width=WINDOW_BYTES)

    def marked(self, codes: np.ndarray, windows: Sent, window_codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per slice: its first row, the bounds of its rows in symbols, and which symbols repeat."""
        member = self.edges.member
        whole = (codes[member] & WHOLE > 0) & (self.edges.path[member] != 0)
        single = np.zeros(len(windows.member), bool)
        if len(windows.member):
            single = window_codes[windows.member] & WHOLE > 0
        if self.rule.ordered:
            order = self.order[self.row]
            whole |= (order > self.edges.order[member]) & (self.edges.path[member] != 0)
            if len(windows.member):
                single |= order[self.owner] > windows.order[windows.member]
        ends = np.cumsum(self.counts)
        for (row, x, o), low, high in zip(self.chunk.slices(), ends - np.array(self.counts, int), ends):
            bounds = self.rule.symbols(x, o).bounds
            change = np.zeros(int(bounds[-1]) + 1, np.int64)
            runs = np.flatnonzero(whole[low:high]) + low
            np.add.at(change, self.first[runs], 1)
            np.add.at(change, self.last[runs] + self.rule.window, -1)
            a, b = np.searchsorted(self.owner, (low, high))
            starts = self.start[a:b][single[a:b]]
            np.add.at(change, starts, 1)
            np.add.at(change, starts + self.rule.window, -1)
            yield row, bounds, np.cumsum(change[:-1]) > 0


def _codes_of(table: pa.Table, step: int, sent: Sent) -> np.ndarray:
    """The codes of a step in the order sent."""
    rows = table.filter(pa.compute.equal(table["step"], step))
    by_bucket = dict(zip(rows["bucket"].to_pylist(), rows["codes"].to_pylist()))
    met, at = sent.bounds()
    parts = [_unpack(by_bucket[int(b)], np.uint8) if int(b) in by_bucket else None for b in met]
    for part, a, b in zip(parts, at[:-1], at[1:]):
        if part is None or len(part) != b - a:
            raise RuntimeError("the documents read differently in two steps; store them first")
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def take_out(docs: DataFrame, rule: Rule, render: Callable, schema: str, ident: str, text: str) -> DataFrame:
    """``render(ids, texts, bounds, marks)`` of every slice of documents, as rows of ``schema``."""
    import pyarrow.compute  # noqa: F401

    spark = prepared(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]
    if rule.ordered and kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{ident} has to be a whole number to tell which document comes first")
    parts = buckets(spark)
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"))

    def edges(batches):
        for chunk in chunked(batches, rule.chunk):
            yield sent_rows(chunk, Work(chunk, rule, parts).edges, rule.ordered)

    def texts(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for chunk in chunked(batches, rule.chunk):
            yield pa.RecordBatch.from_arrays(
                [*_keys(chunk.key, 1), pa.array([chunk.ids.to_pylist()], pa.list_(chunk.ids.type)),
                 pa.array([_pack(chunk.offsets)], pa.binary()),
                 pa.array([squeeze.compress(chunk.data.tobytes())], pa.binary())],
                names=["part", "seq", "digest", "ids", "offsets", "texts"])

    def unpacked(table: pa.Table) -> Chunk:
        row = table.filter(pa.compute.equal(table["step"], 0))
        if row.num_rows != 1:
            raise RuntimeError("the documents read differently in two steps; store them first")
        return Chunk((row["part"][0].as_py(), row["seq"][0].as_py(), row["digest"][0].as_py()),
                     row["ids"].combine_chunks().flatten(), _unpack(row["texts"][0].as_py(), np.uint8),
                     _unpack(row["offsets"][0].as_py(), np.int64))

    def windows(table: pa.Table) -> pa.Table:
        chunk = unpacked(table)
        work = Work(chunk, rule, parts)
        return pa.Table.from_batches([sent_rows(chunk, work.windows(_codes_of(table, 1, work.edges)), rule.ordered)])

    def rendered(table: pa.Table) -> pa.Table:
        chunk = unpacked(table)
        work = Work(chunk, rule, parts)
        codes = _codes_of(table, 1, work.edges)
        sent = work.windows(codes)
        out = []
        marks = work.marked(codes, sent, _codes_of(table, 2, sent))
        for (row, x, o), (_, bounds, marked) in zip(chunk.slices(), marks):
            out.append(render(chunk.ids.slice(row, len(o) - 1), x, o, bounds, marked))
        return pa.Table.from_batches(out)

    key = ["part", "seq", "digest"]
    corpus = rows.mapInArrow(texts, f"{KEY}, ids array<{kind}>, offsets binary, texts binary").withColumn("step", F.lit(0))
    edge_codes = written(
        rows.mapInArrow(edges, SENT).groupBy("bucket").applyInArrow(compared(rule.ordered, True), CODES),
        "edge_codes").withColumn("step", F.lit(1))
    both = corpus.unionByName(edge_codes, allowMissingColumns=True)
    window_codes = (
        both.groupBy(*key).applyInArrow(windows, SENT)
        .groupBy("bucket").applyInArrow(compared(rule.ordered, False), CODES).withColumn("step", F.lit(2)))
    return both.unionByName(window_codes, allowMissingColumns=True).groupBy(*key).applyInArrow(rendered, schema)
