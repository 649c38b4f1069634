"""License notices: exact phrases, and notices with a few edits by seeds and bounded-error matching.

A notice with at most ``k`` edits, cut into ``k + 1`` pieces, has a piece without an edit. The pieces,
spaces included, are therefore seeds: a text that holds the notice holds one of its seeds as it is, once
its words are parted by single spaces. Texts without any seed are settled by substring search. A seed
tells where its notice begins and ends up to ``k`` letters; every run of whole words between these places
is matched by the regex library with at most ``k`` errors, which gives its edits. Every seed is looked at
on its own, so an edited notice is found beside a better copy. Of all runs that match those with the
fewest edits are reported first, with their spans, and of the others what does not overlap.

Few edits in a short word make another word. A word of fewer than seven letters may therefore have one
edit at most, and words that tell a license (``kept``) none; 'cc by' is searched as it is. A map over the
documents: nothing is shuffled.

Null text is empty; empty texts have no words and no notices. Other columns are not read. An empty
table gives no rows. A text is searched as a whole, whatever its length; repeats are all reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import ALPHANUMERIC, prepared, slices, text_bytes, word_spans

SLICE_BYTES = 1 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BETWEEN = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = bytes(b if re.match(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", bytes([b])) else 0x20 for b in range(256))

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Notice:
    """``kept`` has to begin a word of a match as it is."""

    words: str
    label: str
    edits: int = 2
    kept: str = ""


NOTICES = (
    Notice("gnu general public license", "gpl"),
    Notice("apache license", "apache"),
    Notice("cc by", "cc-by", 0),
    Notice("mit license", "mit", 1, "mit"),
    Notice("released under the mit license", "mit", 1, "mit"),
    Notice("licensed under the apache license version", "apache"),
    Notice("licensed under the gnu general public license", "gpl"),
    Notice("gnu lesser general public license", "lgpl"),
    Notice("gnu affero general public license", "agpl"),
    Notice("mozilla public license", "mpl"),
    Notice("eclipse public license", "epl"),
    Notice("creative commons attribution", "cc-by"),
    Notice("redistribution and use in source and binary forms", "bsd"),
    Notice("permission is hereby granted free of charge to any person", "mit", 3),
    Notice("unencumbered software released into the public domain", "unlicense", 3),
)
# A notice of these words alone would be found everywhere.
EVERYDAY = frozenset("a an and any as at be by for from in is it of on or that the this to under use with".split())


def seeds(notice: Notice) -> list[str]:
    """``edits + 1`` pieces of nearly equal length, spaces included; together they are the notice."""
    words, parts = notice.words, notice.edits + 1
    if len(words) < 2 * parts:
        raise ValueError(f"{words!r} is too short for {notice.edits} edits")
    if EVERYDAY.issuperset(words.split()):
        raise ValueError(f"{words!r} has only everyday words")
    return ["".join(cut) for cut in np.array_split(list(words), parts)]


def places(piece: str, text: str) -> list[int]:
    """Where ``piece`` stands in ``text``, overlapping or not."""
    found, at = [], text.find(piece)
    while at >= 0:
        found.append(at)
        at = text.find(piece, at + 1)
    return found


def apart(runs: dict[tuple[int, int], int], length: int) -> list[tuple[int, int, int]]:
    """Runs (start, end, edits) that do not overlap, those with the fewest edits first."""
    taken = []
    for start, end in sorted(runs, key=lambda r: (runs[r], abs(r[1] - r[0] - length), r)):
        at = bisect_left(taken, (start,))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
            taken.insert(at, (start, end, runs[start, end]))
    return taken


SURE = 7  # letters of a word that may have more than one edit


class Pattern:
    """A notice as a pattern of the regex library, and what of its matches counts."""

    def __init__(self, notice: Notice):
        import regex

        self.notice, words = notice, notice.words.split()
        body = f"(?:{regex.escape(notice.words, special_only=True)})"
        bound = f"{{e<={notice.edits}}}" if notice.edits else ""
        self.run, self.edge = regex.compile(rf"(?b){body}{bound}"), regex.compile(r"\b")
        self.kept = regex.compile(rf"\b{regex.escape(notice.kept)}") if notice.kept else None
        self.words = [regex.compile(f"(?:{regex.escape(w)}){{e<={1 if len(w) < SURE else notice.edits}}}") for w in words]
        self.seeds = list(zip(own := seeds(notice), np.cumsum([0] + [len(s) for s in own]).tolist()))

    def runs(self, text: str, seed: str, at: int, offset: int) -> Iterator[tuple[int, int, int]]:
        """Start, end and edits of all runs of whole words around a seed that match and count."""
        most, low = self.notice.edits, at - offset
        high = low + len(self.notice.words)
        bounds = [m.start() for m in self.edge.finditer(text, max(0, low - most), min(len(text), high + most))]
        # An end of the part that is searched looks like an edge: only real ones are.
        begins = [i for i in bounds if i <= min(at, low + most) and self._edge(text, i) and text[i] != " "]
        ends = [j for j in bounds if j >= max(at + len(seed), high - most) and self._edge(text, j) and text[j - 1] != " "]
        for i in begins:
            for j in ends:
                match = self.run.fullmatch(text, i, j)
                if match and self._counts(match.group()):
                    yield i, j, sum(match.fuzzy_counts)

    def _edge(self, text: str, at: int) -> bool:
        return self.edge.match(text, at) is not None

    def _counts(self, found: str) -> bool:
        if self.kept and not self.kept.search(found):
            return False
        parts = found.split(" ")
        return len(parts) != len(self.words) or all(w.fullmatch(p) for w, p in zip(self.words, parts))


class Finder:
    """Patterns and seeds, built once per task."""

    def __init__(self, phrases=PHRASES, notices=NOTICES):
        self.phrases = [(p.split(), re.compile(BETWEEN.join(w.encode() for w in p.split())), label)
                        for p, label in phrases]
        self.notices = [Pattern(notice) for notice in notices]
        self.seeds = {s.encode() for pattern in self.notices for s, _ in pattern.seeds}

    def search(self, lowered: bytes) -> tuple[list, list]:
        """Places of the phrases (word, label) and notices (start, end, edits, label, notice)."""
        spaced = b" ".join(lowered.translate(SPACED).split())
        held = {s for s in self.seeds if s in spaced}
        phrases = [p for p in self.phrases if p[1].search(lowered)]
        if not held and not phrases:
            return [], []
        joined = spaced.decode("utf-8", "replace")
        runs = self._notices(joined, held)
        if not runs and not phrases:
            return [], []
        found = list(WORD.finditer(lowered.decode("utf-8", "replace")))
        words = [m.group() for m in found]
        exact = []
        for parts, _, label in phrases:
            n = len(parts)
            exact += [(i, label) for i, w in enumerate(words) if w == parts[0] and words[i:i + n] == parts]
        starts = np.cumsum([0] + [len(w) + 1 for w in words])[:-1].tolist()
        matches = []
        for start, end, edits, notice in runs:
            first, last = bisect_right(starts, start) - 1, bisect_right(starts, end - 1) - 1
            matches.append((found[first].start(), found[last].end(), edits, notice.label, notice.words))
        return sorted(exact), sorted(matches)

    def _notices(self, joined: str, held: set[bytes]) -> list[tuple[int, int, int, Notice]]:
        out = []
        for pattern in self.notices:
            runs = {(i, j): edits for s, offset in pattern.seeds if s.encode() in held
                    for at in places(s, joined) for i, j, edits in pattern.runs(joined, s, at, offset)}
            out += [(*run, pattern.notice) for run in apart(runs, len(pattern.notice.words))]
        return out


PLACE = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
MATCH = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64()),
                            ("label", pa.string()), ("notice", pa.string())]))


def find_notices(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Identifier, n_words, places (word, label) of the phrases and matches (start, end, edits, label,
    notice) of the notices in code points."""
    prepared(docs.sparkSession)
    rows = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["ident"]

    def find(batches):
        finder = Finder()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            counts = [np.zeros(0, np.int64)]
            for first, last in slices(offsets, SLICE_BYTES):
                part = offsets[first:last + 1] - offsets[first]
                _, _, row = word_spans(data[offsets[first]:offsets[last]], part, ALPHANUMERIC)
                counts.append(np.bincount(row, minlength=last - first))
            whole = data.tobytes().lower()
            hits = [finder.search(whole[offsets[i]:offsets[i + 1]]) for i in range(batch.num_rows)]
            keys = [f.name for f in MATCH.value_type]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ident"), pa.array(np.concatenate(counts), pa.int64()),
                 pa.array([[{"word": w, "label": x} for w, x in h[0]] for h in hits], PLACE),
                 pa.array([[dict(zip(keys, m)) for m in h[1]] for h in hits], MATCH)],
                names=["ident", "n_words", "places", "matches"])

    schema = (f"ident {kind}, n_words bigint, places array<struct<word: bigint, label: string>>, matches "
              "array<struct<start: bigint, end: bigint, edits: bigint, label: string, notice: string>>")
    return rows.mapInArrow(find, schema).withColumnRenamed("ident", ident)


def summarised(found: DataFrame, ident: str = "doc_id") -> DataFrame:
    """One row of figures per document; the score is the best match's share of letters without edits."""
    own = F.sort_array(F.array_distinct(F.col("places.label")))
    every = F.sort_array(F.array_distinct(F.concat(F.col("places.label"), F.col("matches.label"))))
    quality = F.transform("matches", lambda m: 1 - m["edits"] / F.length(m["notice"]))
    return found.select(
        F.col(ident), "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        F.concat_ws(",", own).alias("base_labels"), F.concat_ws(",", every).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(quality), F.lit(0.0))).alias("score"),
        F.size("matches").cast("bigint").alias("n_notices"))
