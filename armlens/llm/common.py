"""What the corpus operators share: reading, scratch tables, Arrow batches, hashing of words in bulk."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import armlens
from armlens.session import pin, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_ROWS = 500  # rows of one Arrow batch; texts are long

# Bytes that belong to words: anything but ASCII white space; ASCII letters, digits and all non-ASCII.
BETWEEN_SPACES = np.ones(256, bool)
BETWEEN_SPACES[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


_SHIPPED: set[str] = set()  # application ids


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of the library, Arrow batches small enough for long texts, and the library
    itself for Python workers that could not import it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        _SHIPPED.add(application)
        spark.sparkContext.addPyFile(_archive())
    return pin(spark)


def _archive() -> str:
    """This package as a zip file, which Spark sends to the executors."""
    package = Path(armlens.__file__).parent
    folder = tempfile.mkdtemp(prefix="armlens-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = Path(folder, "armlens.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    return str(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: cuts the lineage, survives lost executors."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(column, UPPER, LOWER)


def buckets(spark: SparkSession, factor: int = 4) -> int:
    """Parts that packed rows are dealt to; follows the partition count chosen for the data."""
    return factor * int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- texts of an Arrow batch as one byte array -----------------------------------------------------

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column, and where each row starts (one more at the end)."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return whole[first:last], offsets - first


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end and row of every word; words never cross rows."""
    inside = kind[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~fresh[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False])) & ~fresh[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


# ---- 64-bit hashes over runs ------------------------------------------------------------------------

_ODD, _WORD = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective finisher: spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below size."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < size:
        size = max(size, 1 << 16)
        steps = [np.full(size, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
        for step in steps:
            step[0] = 1
        known = tuple(np.multiply.accumulate(step) for step in steps)
        if size <= 1 << 21:
            _POWERS[base] = known
    return known


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _ODD) -> np.ndarray:
    """Hash of values[start:end] for each pair; equal runs hash alike wherever they stand."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(_TABLE[data], starts, ends)


def window_hashes(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` consecutive word hashes from each start."""
    return run_hashes(words, starts, starts + length, _WORD)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]
