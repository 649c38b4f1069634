"""Suffix dedup over bytes: every byte string of a window's length that a document with a smaller
identifier has is taken out.

A suffix is compared by its first ``window`` bytes. Sorting all suffixes of a corpus as rows would move
more than twenty times its size, so a cover sample moves: of the suffixes in each stretch of
``window - kmer + 1`` places the one with the smallest hash. A difference cover picks places by their
number, about a fifth of them for windows of 50 bytes; this cover picks them by content, one in eighteen,
and equal strings pick alike whatever document they stand in. The samples are sorted one bucket at a time
and carry the rank (a hash) of the whole stretch they cover; ties, samples with several stretches, are
resolved by sorting the suffixes of exactly these, again bucket by bucket, see ``repeats``. Memory is
bounded by the chunk and the bucket.

Null text is empty; matches never cross documents. A null identifier is smaller than any other. Rows
with equal identifiers do not take bytes from each other. Identifiers are whole numbers. Texts shorter
than a window keep all bytes. An empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from armlens.llm.repeats import CHUNK_BYTES, Bytes, Rule, take_out

WINDOW, KMER = 50, 16


def _render(ids, data, offsets, bounds, marked) -> pa.RecordBatch:
    edge = np.zeros(len(marked) + 1, bool)
    edge[offsets[:-1]] = True  # a span ends with its document
    starts = marked & (edge[:-1] | ~np.concatenate(([False], marked[:-1])))
    total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])
    left = np.concatenate(([0], np.cumsum(~marked)))[offsets]
    kept = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~marked]))])
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(offsets), pa.int64()), pa.array(total(marked), pa.int64()),
         pa.array(total(starts), pa.int64()), kept.cast(pa.binary())],
        names=["ident", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_earlier_strings(docs: DataFrame, ident: str = "doc_id", text: str = "text",
                           window: int = WINDOW, kmer: int = KMER, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Identifier, n_bytes, n_removed, n_spans (maximal removed runs) and ``kept``, the other bytes."""
    if not 8 <= kmer <= min(16, window):
        raise ValueError("kmer has to be from 8 to 16 and not longer than the window")
    kind = dict(docs.dtypes)[ident]
    out = take_out(docs, Rule(Bytes, window, kmer, True, chunk), _render,
                   f"ident {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary", ident, text)
    return out.withColumnRenamed("ident", ident)
