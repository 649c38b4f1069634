"""Records of CSV files whose quoted fields hold raw line breaks, read by as many tasks as files have splits.

A line break ends a record only outside quotes, and whether a line starts inside them depends on all that
stands before it in its file. So the files are read twice:

1. Quotes are counted per split. Running sums of one row per split tell which splits start inside quotes.
2. Each split goes line by line from its known start, and cuts at the line breaks outside quotes. What a
   split holds of a record that starts before it or ends behind it goes out as a fragment, at most two a
   split; fragments are put together by file and order.

A split that starts inside quotes is known to the driver, as the splits themselves are. Where no record
crosses a split there are no fragments, and nothing is shuffled. Quotes inside a field are doubled. A file
that ends inside quotes stops the run, named. Lines end in LF or CR LF; blank lines between records are
no records. Files that cannot be split (gzip) are one split.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD, HEAD, TAIL = range(3)  # a whole record; what closes or passes through an open one; what opens one
PIECES = "file string, start bigint, kind int, first boolean, text binary"
Split = tuple[str, int]


class OpenQuote(ValueError):
    """Files that end inside a quoted field."""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _inside(lines: DataFrame, quote: str) -> tuple[set[Split], set[Split]]:
    """The splits that start inside quotes, and those that end there."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    splits = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    so_far = Window.partitionBy("file").orderBy("start")
    closing = (F.sum("odd").over(so_far) % 2).alias("ends")
    at_end = F.lead("start").over(so_far).isNull().alias("at_end")
    rows = (splits.select("file", "start", "odd", closing, at_end)
            .withColumn("starts", (F.col("ends") + F.col("odd")) % 2)
            .filter("starts = 1 OR ends = 1").collect())  # at most a row per split
    broken = sorted(r["file"] for r in rows if r["at_end"] and r["ends"])
    if broken:
        raise OpenQuote(f"{len(broken)} files end inside quotes, such as {broken[0]}")
    return ({(r["file"], r["start"]) for r in rows if r["starts"]}, {(r["file"], r["start"]) for r in rows if r["ends"]})


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[Split, pa.Array]]:
    """The lines of each split in a batch."""
    start = batch.column("start").to_numpy(zero_copy_only=False)
    file = batch.column("file").dictionary_encode()
    code = file.indices.to_numpy(zero_copy_only=False)
    heads = np.flatnonzero(np.concatenate(([True], (start[1:] != start[:-1]) | (code[1:] != code[:-1]))))
    for a, b in zip(heads, np.append(heads[1:], len(start))):
        yield (file.dictionary[int(code[a])].as_py(), int(start[a])), batch.column("value").slice(a, b - a)


class _Cutter:
    """Goes through the lines of one split."""

    def __init__(self, split: Split, inside: bool):
        self.split, self.odd = split, int(inside)
        self.open: list[bytes] | None = [] if inside else None
        self.crossing = inside  # the open record starts before this split
        self.first = split[1] == 0

    def add(self, lines: pa.Array, quote: str) -> Iterator[tuple[int, bool, Iterable]]:
        """Kind, whether the first is the first of its file, and texts."""
        while self.first and self.open is None and len(lines) and not lines[0].as_py().strip():
            lines = lines.slice(1)  # blank lines before the first record
        if not len(lines):
            return
        running = (self.odd + np.cumsum(pc.count_substring(lines, quote).to_numpy(zero_copy_only=False))) % 2
        ends = running == 0
        alone = ends.copy()  # lines that start and end a record
        alone[1:] &= ends[:-1]
        alone[:1] &= self.odd == 0
        self.odd = int(running[-1])
        whole: list[bytes] = []
        for at in np.flatnonzero(~alone).tolist():
            self.open = [] if self.open is None else self.open
            self.open.append(lines[at].as_py())
            if ends[at]:
                text, self.open = b"\n".join(self.open), None
                if self.crossing:
                    yield HEAD, False, [text]
                    self.crossing = False
                else:
                    whole.append(text)
        single = lines.filter(pa.array(alone)) if not alone.all() else lines
        if self.first and (len(single) or whole):
            self.first = False
            if alone[0]:
                yield RECORD, True, single.slice(0, 1)
                single = single.slice(1)
            else:
                yield RECORD, True, whole[:1]
                whole = whole[1:]
        if len(single):
            yield RECORD, False, single
        if whole:
            yield RECORD, False, whole

    def rest(self) -> Iterator[tuple[int, bool, Iterable]]:
        if self.open:
            yield (HEAD, False, [b"\n".join(self.open)]) if self.crossing else (TAIL, self.first, [b"\n".join(self.open)])


def _pieces(starts: set[Split], only: set[Split] | None, quote: str):
    """Records and fragments of splits; with ``only`` the fragments of these splits."""

    def rows(split: Split, found) -> Iterator[pa.RecordBatch]:
        for kind, first, texts in found:
            if (only is None) != (kind == RECORD):
                continue
            texts = texts.cast(pa.binary()) if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(split[0], n), pa.repeat(split[1], n), pa.array(np.full(n, kind, np.int32)),
                 pa.repeat(first, n), texts], names=["file", "start", "kind", "first", "text"])

    def run(batches):
        cutter = None
        for batch in batches:
            if not batch.num_rows:
                continue
            for split, lines in _runs(batch):
                if only is not None and split not in only:
                    continue
                if cutter is None or cutter.split != split:
                    if cutter is not None:
                        yield from rows(cutter.split, cutter.rest())
                    cutter = _Cutter(split, split in starts)
                yield from rows(split, cutter.add(lines, quote))
        if cutter is not None:
            yield from rows(cutter.split, cutter.rest())

    return run


def _joined(fragments: DataFrame) -> DataFrame:
    """Records from fragments: each opening one with all that follow it up to the next."""
    so_far = Window.partitionBy("file").orderBy("start", "kind")
    number = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(so_far)
    in_order = F.sort_array(F.collect_list(F.struct("start", "kind", F.col("text").cast("string").alias("text"))))
    return fragments.withColumn("number", number).groupBy("file", "number").agg(
        F.array_join(in_order["text"], "\n").alias("text"), F.max("first").alias("first")).drop("number")


def read_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``file``, ``text`` and ``first`` of every record: whether it is the first of its file."""
    lines = _lines(spark, path)
    starts, ends = _inside(lines, quote)
    raw = lines.select("file", "start", F.col("value").cast("binary").alias("value"))
    records = raw.mapInArrow(_pieces(starts, None, quote), PIECES).select("file", F.col("text").cast("string").alias("text"), "first")
    if starts or ends:
        records = records.unionByName(_joined(raw.mapInArrow(_pieces(starts, starts | ends, quote), PIECES)))
    text = F.regexp_replace("text", "\r$", "")
    return records.withColumn("text", text).filter(F.trim("text") != "")
