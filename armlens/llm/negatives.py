"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

Vectors are whole numbers, scores exact inner products. Anchors meet all rows in cells of a grid: blocks
of anchors, bounded by bytes, by shares of the rows. A task holds one block and reads its share tile by
tile; Strassen's method multiplies anchors by a tile, zeros padding both to powers of two, and every
addition is of 64-bit integers. A bounded heap per anchor keeps the best of a tile, heaps of tiles are
merged in the task and heaps of cells after a shuffle. A first round finds the positives. A second one
knows their scores, so each anchor has a heap per positive, of rows of other labels inside that
positive's window. Shares grow with the square root of the rows, so that neither tasks nor heaps to be
merged get out of hand, and heaps never hold more than they return.

Rows without identifier, label or vector, and vectors with a null or non-finite component take no part.
Shorter vectors count as followed by zeros; an empty one scores 0 with all. Repeated rows are rows of
their own, anchors and partners alike, but a row with the anchor's identifier is never its partner.
Scores that 64 bits can't be sure to hold stop the run. An empty table gives no rows, as do anchors
without positives or with empty windows. Columns not named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlens.llm.common import prepared, written

POSITIVES, NEGATIVES = 5, 5
BLOCK_BYTES = 64 << 20  # of anchors in one task
SHARE_ROWS = 1_024  # there are as many shares as the root of the rows in this
TILE_ANCHORS, TILE_ROWS = 512, 1_024
LEAF = 16  # Strassen's method does not split a side of this many further
Fits = Callable[[np.ndarray, np.ndarray], np.ndarray]


# ---- Strassen on tiles ----------------------------------------------------------------------------------

def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b for int64 matrices of any shape, exact as long as the result fits."""
    (m, k), n = a.shape, b.shape[1]
    depth = max(0, min(math.ceil(math.log2(max(1, size) / leaf)) for size in (max(m, 1), max(k, 1), max(n, 1))))
    unit = 1 << depth
    padded = [np.zeros([-(-s // unit) * unit for s in x.shape], np.int64) for x in (a, b)]
    for whole, x in zip(padded, (a, b)):
        whole[:x.shape[0], :x.shape[1]] = x
    return _product(*padded, depth)[:m, :n]


def _product(a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    if not depth:
        return a @ b
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = _product(a11 + a22, b11 + b22, depth - 1)
    p2 = _product(a21 + a22, b11, depth - 1)
    p3 = _product(a11, b12 - b22, depth - 1)
    p4 = _product(a22, b21 - b11, depth - 1)
    p5 = _product(a11 + a12, b22, depth - 1)
    p6 = _product(a21 - a11, b11 + b12, depth - 1)
    p7 = _product(a12 - a22, b21 + b22, depth - 1)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


# ---- heaps ------------------------------------------------------------------------------------------------

class Heaps:
    """A bounded heap per line: the best ``size`` (score, identifier), higher scores and then smaller
    identifiers first. Places without an entry are not ``held``."""

    def __init__(self, lines: int, size: int):
        self.scores = np.zeros((lines, size), np.int64)
        self.idents = np.zeros((lines, size), np.int64)
        self.held = np.zeros((lines, size), bool)

    @classmethod
    def of_tile(cls, scores: np.ndarray, idents: np.ndarray, fits: np.ndarray, size: int) -> Heaps:
        """The best of each line of a tile whose columns are in the order of ``idents``."""
        lines, n = scores.shape
        size = min(size, n)
        # Score and column in one number, so that no two are equal.
        largest = int(np.abs(scores).max(initial=0))
        if largest < (1 << 62) // max(1, n):
            rank = np.where(fits, scores * n + (n - 1 - np.arange(n)), np.iinfo(np.int64).min)
            at = np.argpartition(rank, n - size, axis=1)[:, n - size:] if size < n else np.tile(np.arange(n), (lines, 1))
        else:
            at = np.stack([np.lexsort((np.arange(n), -s, ~f))[:size] for s, f in zip(scores, fits)])
        heaps = cls(lines, size)
        heaps.scores, heaps.held = (np.take_along_axis(x, at, 1) for x in (scores, fits))
        heaps.idents = idents[at]
        return heaps

    def merge(self, other: Heaps, lines: slice) -> None:
        """Takes ``other``'s entries into the given lines."""
        size = self.scores.shape[1]
        scores, idents, held = (np.concatenate((getattr(self, x)[lines], getattr(other, x)), 1)
                                for x in ("scores", "idents", "held"))
        order = np.lexsort((idents, -scores, ~held))[:, :size]
        for name, values in (("scores", scores), ("idents", idents), ("held", held)):
            getattr(self, name)[lines] = np.take_along_axis(values, order, 1)


# ---- a cell of the grid -------------------------------------------------------------------------------------

def _matrix(rows: pa.Table | pa.RecordBatch, dimension: int) -> np.ndarray:
    """Vectors as lines, zeros after short ones."""
    column = rows.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), dimension), np.int64)
    out[np.arange(dimension) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _sure(a: np.ndarray, b: np.ndarray) -> None:
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound >= 2.0**62:
        raise OverflowError("components too large for exact 64-bit scores")


class _Cell:
    """A block of anchors and the heaps that a share of the rows fills: one per anchor and rule."""

    def __init__(self, anchors: pa.Table, dimension: int, size: int, windows: bool):
        self.matrix = _matrix(anchors, dimension)
        self.number, self.ident, self.label = (anchors.column(c).to_numpy() for c in ("number", "ident", "label"))
        self.size = size
        if windows:
            bounds = anchors.column("bounds").to_pylist()
            width = max(map(len, bounds))
            self.bounds = np.zeros((len(bounds), width), np.int64)
            self.given = np.zeros((len(bounds), width), bool)
            for line, known in enumerate(bounds):
                self.bounds[line, :len(known)], self.given[line, :len(known)] = known, True
        else:
            self.bounds = None
        self.heaps = [Heaps(len(self.ident), size) for _ in range(1 if self.bounds is None else width)]

    def meet(self, rows: pa.Table, fits: Fits | None) -> None:
        """One tile of rows, in the order of their identifiers."""
        matrix = np.ascontiguousarray(_matrix(rows, self.matrix.shape[1]).T)
        _sure(self.matrix, matrix)
        idents, labels = rows.column("ident").to_numpy(), rows.column("label").to_numpy()
        for start in range(0, len(self.ident), TILE_ANCHORS):
            lines = slice(start, start + TILE_ANCHORS)
            scores = strassen(self.matrix[lines], matrix)
            other = self.ident[lines, None] != idents
            same = self.label[lines, None] == labels
            for rule, heaps in enumerate(self.heaps):
                if self.bounds is None:
                    chosen = other & same
                else:
                    inside = fits(scores, self.bounds[lines, rule, None]) & self.given[lines, rule, None]
                    chosen = other & ~same & inside
                heaps.merge(Heaps.of_tile(scores, idents, chosen, self.size), lines)

    def found(self) -> pa.RecordBatch:
        parts = []
        for rule, heaps in enumerate(self.heaps):
            line, at = np.nonzero(heaps.held)
            parts.append((self.number[line], np.full(len(line), rule + 1), heaps.scores[line, at], heaps.idents[line, at]))
        number, rule, score, ident = map(np.concatenate, zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(rule, pa.int32()), pa.array(score), pa.array(ident)],
            names=["number", "rule", "score", "partner"])


def _cells(dimension: int, size: int, fits: Fits | None):
    """Rows of a partition, sorted by cell, anchors before the rest and by identifier, to found partners."""

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Rows of one cell and one role, at most a tile of rows and whole blocks of anchors."""
        held: list[pa.Table] = []
        now, n = None, 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kinds = np.stack((table.column("cell").to_numpy(), table.column("role").to_numpy()), 1)
            cuts = [0, *(np.flatnonzero((kinds[1:] != kinds[:-1]).any(1)) + 1).tolist(), len(kinds)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                kind = tuple(kinds[a])
                if held and (kind != now or (kind[1] and n + b - a > TILE_ROWS)):
                    yield pa.concat_tables(held).combine_chunks()
                    held, n = [], 0
                held.append(table.slice(a, b - a))
                now, n = kind, n + b - a
        if held:
            yield pa.concat_tables(held).combine_chunks()

    def run(batches):
        cell = number = None
        for table in tiles(batches):
            here, role = table.column("cell")[0].as_py(), table.column("role")[0].as_py()
            if role == 0:
                if cell is not None:
                    yield cell.found()
                cell, number = _Cell(table, dimension, size, fits is not None), here
            elif cell is not None and here == number:
                cell.meet(table, fits)
        if cell is not None:
            yield cell.found()

    return run


FOUND = "number bigint, rule int, score bigint, partner bigint"


def _partners(anchors: DataFrame, rows: DataFrame, blocks: int, shares: int, dimension: int, size: int,
              fits: Fits | None) -> DataFrame:
    """The best ``size`` partners of every anchor and rule: number, rule, score, partner, place."""
    cell = (F.col("block") * shares + F.col("share")).alias("cell")
    no_bounds = F.lit(None).cast("array<bigint>")
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    hosts = anchors.select("*", every(shares, "share")).select(
        cell, F.lit(0).alias("role"), "number", "ident", "label", "vector",
        F.col("bounds") if fits else no_bounds.alias("bounds"))
    guests = rows.select("*", every(blocks, "block")).select(
        cell, F.lit(1).alias("role"), F.lit(0).cast("bigint").alias("number"), "ident", "label", "vector",
        no_bounds.alias("bounds"))
    dealt = hosts.unionByName(guests).repartitionById(blocks * shares, "cell").sortWithinPartitions(
        "cell", "role", "ident")
    found = dealt.mapInArrow(_cells(dimension, size, fits), FOUND)
    best = Window.partitionBy("number", "rule").orderBy(F.desc("score"), "partner")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= size)


def whole_numbers(vector: Column, scale: int) -> Column:
    """Components times ``scale``, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: Column) -> Column:
    """No null vector and no null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def within(scores: np.ndarray, positive: np.ndarray, percent: int) -> np.ndarray:
    """Scores of at least ``percent`` hundredths of the positive's and at most its own."""
    return (percent * positive <= 100 * scores) & (scores <= positive)


def mine(vectors: DataFrame, anchor: Column, ident: str = "vec_id", vector: str = "embedding", label: str = "label",
         scale: int = 256, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = 80,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells from the columns of ``vectors`` which rows are anchors; it is asked of rows that
    take part only.
    """
    prepared(vectors.sparkSession)
    kept = vectors.filter(F.col(ident).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector)))
    rows = written(kept.select(
        F.col(ident).cast("bigint").alias("ident"), F.col(label).cast("bigint").alias("label"),
        whole_numbers(F.col(vector), scale).alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.monotonically_increasing_id().alias("number")), "vectors")
    n, dimension, n_anchors = rows.agg(
        F.count(F.lit(1)), F.max(F.size("vector")), F.count(F.when(F.col("anchor"), 1))).first()
    dimension = max(1, dimension or 0)
    shares = max(1, math.ceil(math.sqrt(n / SHARE_ROWS)))
    blocks = max(1, math.ceil(n_anchors * dimension * 8 / block_bytes))
    # Hashes deal out evenly whatever the identifiers are; blocks may be a little over their bytes.
    rows = rows.withColumn("share", F.pmod(F.xxhash64("number"), F.lit(shares)).cast("int"))
    anchors = rows.filter("anchor").withColumn("block", F.pmod(F.xxhash64("number", F.lit(1)), F.lit(blocks)).cast("int"))
    anchors = anchors.select("number", "ident", "label", "vector", "block")
    first = _partners(anchors, rows, blocks, shares, dimension, positives, None)
    first = written(first.select("number", F.col("partner").alias("positive_id"), F.col("score").alias("positive_score"),
                                 F.col("place").alias("rule")), "positives")
    # At most ``positives`` entries an anchor, in the order of their rules.
    bounds = first.groupBy("number").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rule", "positive_score"))), lambda x: x["positive_score"]).alias("bounds"))
    bounded = written(anchors.join(bounds.hint("merge"), "number"), "bounded_anchors")
    second = _partners(bounded, rows, blocks, shares, dimension, negatives,
                       lambda scores, positive: within(scores, positive, percent))
    known = first.join(bounded.select("number", F.col("ident").alias("anchor_id")).hint("merge"), "number")
    return known.join(second.hint("merge"), ["number", "rule"]).select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("partner").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
