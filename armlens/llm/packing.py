"""Packing: first-fit decreasing with a tournament tree of bin capacities, in random groups.

Documents become token ids with an end mark and are cut at the sequence length; a cut piece that is as
long as a sequence is one. The other pieces are dealt at random to groups of bounded expected size and
every group is packed on its own: longest first, each into the first sequence with room, which the
tree of the largest remaining capacities finds in logarithmic time. Groups are independent tasks, so
the work is linear in the corpus and a lost task is repeated alone.

Null text is empty: one piece with the end mark. Equal documents are packed like any others. An empty
table gives no rows. All columns of the pieces are carried through, token ids included.
"""

from __future__ import annotations

import math
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import prepared, written

SEQUENCE = 4096
END = 2
GROUP = 20_000  # pieces of a group, in the mean
KNOWN_WORDS = 500_000  # words whose ids a worker remembers
MARKS = ".,!?;:|"
# Letters of all of Latin-1, both cases, marks, digits and white space of every kind that is taken apart.
PROBE = (
    "".join(map(chr, range(0x21, 0x7F))), " ".join(map(chr, range(0xA1, 0x100))),
    "The quick  brown\tfox; it's 12.5% over\n\nA LAZY dog! (naïve CAFÉ) re-read | end.", " lead and trail \n", "x",
)

# Characters outside plain Latin text; texts with any of them go through the tokenizer as a whole.
UNUSUAL = bytes([*range(0x09), *range(0x0E, 0x20), *range(0x7F, 0xA1)])
WORD_END = b"\xff"  # in no UTF-8 text


class Words(dict):
    """Ids of words of lower-case Latin-1 text as little-endian 32-bit numbers, encoded when missing.

    The tokenizer puts no token across white space, and marks after a letter are tokens of their own.
    A word of letters alone is merged by rank; every other word is left to the tokenizer. A tokenizer of
    other rules is told by ``PROBE``, whose ids would differ; its texts are not taken apart at all.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = False
        with open(path) as file:
            model = json.load(file)["model"]
        plain = _byte_letters()
        letters = set("".join(t.removesuffix("</w>") for t in model["vocab"] if not t.startswith("<|")))
        if not letters.issubset(plain):
            return
        ranks = {}
        for token, ident in model["vocab"].items():
            if token.startswith("<|"):
                continue
            stem = token.removesuffix("</w>")
            ranks[bytes(plain[c] for c in stem) + WORD_END * (stem != token)] = ident
        self.merged = tiktoken.Encoding(
            "words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        try:
            self.by_word = all(self.of_text(text) == self.whole(text) for text in PROBE)
        except (KeyError, ValueError):  # a letter without a rank
            pass

    def of_text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.lower().split()))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(MARKS)
        if stem.isalpha():
            ids = array("I", self.merged(stem.encode() + WORD_END)).tobytes()
            ids += self[word[len(stem):]] if stem != word else b""
        else:
            ids = self.whole(word)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = ids
        return ids


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, reversed: printable bytes are
    themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


_WORDS: dict[str, Words] = {}


def token_bytes(text: str, path: str) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit numbers."""
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    words = _WORDS[path]
    try:
        plain = text.encode("latin-1")
    except UnicodeEncodeError:
        plain = None
    if not words.by_word or plain is None or len(plain.translate(None, UNUSUAL)) != len(plain) or "<|" in text:
        return words.whole(text)
    return words.of_text(text)


def cut_pieces(docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text",
               length: int = SEQUENCE, end: int = END) -> DataFrame:
    """Pieces of at most ``length`` ids: identifier, start, length, doc_tokens, ids (binary, uint32)."""
    prepared(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]
    mark = np.array([end], "<u4").tobytes()

    def pieces(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids = token_bytes(batch.column("text")[row].as_py() or "", tokenizer) + mark
                total = len(ids) // 4
                starts = range(0, total, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("ident")[row].as_py()] * len(starts), batch.column("ident").type),
                     pa.array(starts, pa.int64()),
                     pa.array([min(length, total - s) for s in starts], pa.int64()),
                     pa.array([total] * len(starts), pa.int64()),
                     pa.array([ids[4 * s:4 * (s + length)] for s in starts], pa.binary())],
                    names=["ident", "start", "length", "doc_tokens", "ids"])

    rows = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    cut = rows.mapInArrow(
        pieces, f"ident {kind}, start bigint, length bigint, doc_tokens bigint, ids binary")
    return cut.withColumnRenamed("ident", ident)


class CapacityTree:
    """Bins under a tournament tree; every inner node has the larger capacity of its two children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (max(1, bins) - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """The first bin with room for ``size`` and the room it had."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        room, leaf = best[node], node
        best[node] = room - size
        while node > 1:
            node //= 2
            larger = max(best[2 * node], best[2 * node + 1])
            if best[node] == larger:
                break
            best[node] = larger
        return leaf - self.leaves, room


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    tree = CapacityTree(len(sizes), capacity)
    for i in np.argsort(-sizes, kind="stable"):
        bin_, room = tree.place(int(sizes[i]))
        bins[i], offsets[i] = bin_, capacity - room
    return bins, offsets


def pack(pieces: DataFrame, length: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` column.

    ``pieces`` has to be a stored table: it is read twice, for the number of groups and to pack.
    """
    count = pieces.count()
    groups = max(1, math.ceil(count / group))
    columns = pieces.columns
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def packed(key, frame: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), length)
        return frame[columns].assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    schema = ", ".join(f"`{n}` {k}" for n, k in pieces.dtypes)
    return dealt.groupBy("_group").applyInPandas(packed, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, ident: str = "doc_id", text: str = "text",
                   length: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """Placed pieces of all documents; with their ids or with the checksum of these."""
    pieces = cut_pieces(docs, tokenizer, ident, text, length)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    return pack(written(pieces if with_ids else pieces.drop("ids"), "pieces"), length)
