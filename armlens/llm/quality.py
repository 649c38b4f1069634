"""Quality classifier: Bradley-Terry scores from preference pairs.

A document's strength is linear in features of its whole text. For a pair of a better and a worse
labelled document the chance that the better one wins is the logistic function of the difference of
their strengths, so the weights come from a logistic loss on feature differences, without intercept.
The threshold is a quantile of the strengths of all labels that are not held out, taken by Spark after the
fit: as large a share lies below it as there are labels 0 among them. The score is the logistic function of the strength, shifted and scaled so that the
threshold scores ``CUT``.

The fit uses at most ``SAMPLE`` labelled rows of each label (by hash of the identifier) and ``PAIRS``
pairs; features, threshold and scores cover every text. Features are one pass over the documents; the only
join is the labels with the rows of features. ``keep_good`` makes these twice, rather than carry texts
through a table.

Null text counts as empty; empty texts get the score of all-zero features. Labels that are null, or of
documents not in the table, are not used; a document with contradictory labels counts with each. With
one label only there are no pairs: all strengths are 0 and every document scores ``CUT`` (predicted 1).
Repeated rows get equal scores. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from armlens.llm.common import BETWEEN_SPACES, mixed, prepared, slices, text_bytes, window_hashes, word_hashes, word_spans, written

SAMPLE = 8_000
PAIRS = 60_000
CUT = 0.3
BINS = 4_096  # of a pass that looks for a rank
SLICE_BYTES = 1 << 19
FEATURES = (
    "log_words", "word_length", "short_words", "long_words", "distinct_words", "repeated_word",
    "distinct_threes", "repeated_lines", "words_per_line", "upper", "digits", "sentence_marks", "exclaims",
    "bars", "symbols", "marked_words", "not_ascii", "spaces", "links", "capitalised",
)

_CLASS = np.zeros(256, np.int64)  # 0: nothing of the below
for _kind, _bytes in enumerate((
    range(0x41, 0x5B), range(0x30, 0x3A), b".,;:'\"?", b"!", b"|", b"#$%&*+<=>@[\\]^_`{}~/", range(0x80, 0x100),
    (0x20, *range(0x09, 0x0E)),
), 1):
    _CLASS[list(_bytes)] = _kind


def _distinct_share(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and all hashes of each row."""
    keys = np.unique((rows.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    return np.bincount((keys >> np.uint64(44)).astype(np.int64), minlength=n), np.bincount(rows, minlength=n)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of figures per text; every figure is a mean or a share, 0 where there is nothing."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row_of_byte = np.repeat(np.arange(n), size)
    kinds = np.bincount(row_of_byte * 9 + _CLASS[data], minlength=9 * n).reshape(n, 9)
    starts, ends, row = word_spans(data, offsets, BETWEEN_SPACES)
    words = np.bincount(row, minlength=n)
    lengths = ends - starts
    hashes = word_hashes(data, starts, ends)
    share = lambda of, among: of / np.maximum(among, 1)
    per_word = lambda flag: share(np.bincount(row, flag, minlength=n), words)
    same = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])))
    distinct, _ = _distinct_share(row, hashes, n)
    whole = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
    threes, all_threes = _distinct_share(row[whole], window_hashes(hashes, whole, 3), n)
    not_break = np.ones(256, bool)
    not_break[[10, 13]] = False
    line_starts, line_ends, line_row = word_spans(data, offsets, not_break)
    lines, all_lines = _distinct_share(line_row, word_hashes(data, line_starts, line_ends), n)
    first, last = (data[starts], data[ends - 1]) if len(starts) else (data[:0], data[:0])
    letter = lambda b: ((b | 0x20) >= 0x61) & ((b | 0x20) <= 0x7A) | (b >= 0x80)
    odd = ~letter(last) & ~np.isin(last, np.frombuffer(b".,", np.uint8))
    slash = (data[:-1] == 0x2F) & (data[1:] == 0x2F) if len(data) > 1 else np.zeros(0, bool)
    columns = [
        np.log1p(words), share(np.bincount(row, lengths, minlength=n), words),
        per_word(lengths <= 3), per_word(lengths >= 12), share(distinct, words) * (words > 0),
        per_word(same), share(threes, all_threes), share(all_lines - lines, all_lines),
        np.log1p(share(words, all_lines)), share(kinds[:, 1], size), share(kinds[:, 2], size),
        share(kinds[:, 3], words), share(kinds[:, 4], words), share(kinds[:, 5], words),
        share(kinds[:, 6], words), per_word(odd), share(kinds[:, 7], size), share(kinds[:, 8], size),
        share(np.bincount(row_of_byte[:-1][slash], minlength=n), words) if len(data) > 1 else np.zeros(n),
        per_word((first >= 0x41) & (first <= 0x5A)),
    ]
    return np.stack(columns, 1)


def featured(docs: DataFrame, ident: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Identifier and ``x``, the figures of its whole text; with ``carry`` the struct ``row`` of all
    columns in place of the identifier."""
    prepared(docs.sparkSession)
    body = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.col(ident)
    rows = docs.select(body.alias("ident"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [np.zeros((0, len(FEATURES)))]
            for a, b in slices(offsets, SLICE_BYTES):
                parts.append(features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))
            x = np.concatenate(parts)
            flat = pa.array(x.astype(np.float32).ravel(), pa.float32())
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("ident"), pa.ListArray.from_arrays(ends, flat)], names=["ident", "x"])

    schema = rows.select("ident").schema.add("x", ArrayType(FloatType()))
    return rows.mapInArrow(run, schema).withColumnRenamed("ident", "row" if carry else ident)


@dataclass(frozen=True)
class Model:
    """Strength = sum over weight * clipped standardised figure and its square."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # figures, then their squares
    threshold: float
    slope: float

    def expanded(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.concatenate((z, z * z), 1)

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return self.expanded(x) @ self.weights

    def strength(self, x: str = "x") -> Column:
        """The strength as a column expression over the figures."""
        total = F.lit(0.0)
        n = len(self.mean)
        for i in range(n):
            z = (F.col(x)[i].cast("double") - float(self.mean[i])) / float(self.scale[i])
            z = F.greatest(F.lit(-4.0), F.least(F.lit(4.0), z))
            total = total + z * (float(self.weights[i]) + z * float(self.weights[n + i]))
        return total

    def score(self, x: str = "x") -> Column:
        """The score as a column expression over the figures."""
        shift = float(np.log(CUT / (1 - CUT))) + 1e-9  # at the threshold the score is not below
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-((self.strength(x) - self.threshold) * self.slope + shift)))


def fit(better: np.ndarray, worse: np.ndarray, pairs: int = PAIRS, share_worse: float | None = None,
        ridge: float = 1e-3, rounds: int = 25) -> Model:
    """Newton steps on the logistic loss of feature differences, each pair drawn with a fixed seed."""
    both = np.concatenate((better, worse))
    width = len(FEATURES)
    if not len(better) or not len(worse):
        return Model(np.zeros(width), np.ones(width), np.zeros(2 * width), 0.0, 1.0)
    scale = both.std(0)
    model = Model(both.mean(0), np.where(scale > 1e-9, scale, 1.0), np.zeros(2 * width), 0.0, 1.0)
    draw = np.random.Generator(np.random.PCG64(7))
    count = min(pairs, 40 * max(len(better), len(worse)))
    a, b = model.expanded(better), model.expanded(worse)
    d = a[draw.integers(0, len(a), count)] - b[draw.integers(0, len(b), count)]
    w = np.zeros(2 * width)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (p - 1) / count + ridge * w
        curve = (d.T * np.maximum(p * (1 - p), 1e-6)) @ d / count + ridge * np.eye(2 * width)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    good, bad = a @ w, b @ w
    share = len(worse) / len(both) if share_worse is None else share_worse
    weight = np.concatenate((np.full(len(good), (1 - share) / len(good)), np.full(len(bad), share / len(bad))))
    order = np.argsort(strength := np.concatenate((good, bad)), kind="stable")
    at = min(int(np.searchsorted(np.cumsum(weight[order]), share)), len(order) - 2)
    threshold = float((strength[order[at]] + strength[order[at + 1]]) / 2) if len(order) > 1 else 0.0
    slope = 2.0 / max(1e-6, float(np.std(strength)))
    return Model(model.mean, model.scale, w, threshold, slope)


def held_out(ident: str) -> Column:
    """One row in five, by the checksum of the identifier as text, is never learnt from."""
    return F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def usable(labels: DataFrame, ident: str, label: str) -> DataFrame:
    """Identifier and y of all labels outside the held-out fifth."""
    return labels.filter(F.col(label).isin(0, 1) & ~held_out(ident)).select(F.col(ident), F.col(label).alias("y"))


def sampled(known: DataFrame, ident: str, sample: int) -> DataFrame:
    """A bounded sample of each label, for the fit only."""
    rank = F.xxhash64(F.col(ident), F.lit(11))
    parts = [known.filter(F.col("y") == y).orderBy(rank, ident).limit(sample) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def learn(figures: DataFrame) -> Model:
    """The model of the sampled figures (y, x); its threshold is the sample's."""
    rows = figures.select("y", "x").toArrow()
    y = rows.column("y").to_numpy()
    x = np.array(rows.column("x").combine_chunks().flatten() if len(y) else [], float).reshape(len(y), len(FEATURES))
    return fit(x[y == 1], x[y == 0])


def value_at(values: DataFrame, rank: int) -> float:
    """The ``s`` with ``rank`` rows before it in order, exactly: counts in bins, then in the bin of the rank."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high:
        place = F.least(F.floor((F.col("s") - low) / (high - low) * BINS), F.lit(BINS - 1))
        bins = values.filter(F.col("s").between(low, high)).groupBy(place.alias("place")).agg(
            F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high"))
        for row in sorted(bins.collect()):
            if rank < row["n"]:
                low, high = row["low"], row["high"]
                break
            rank -= row["n"]
    return low


def threshold(strengths: DataFrame) -> float:
    """Half way between the last of the ``s`` below which lies the share of ``y`` = 0, and the next."""
    worse = strengths.filter(F.col("y") == 0).count()
    last = value_at(strengths, worse - 1)
    upto, above = strengths.agg(F.count_if(F.col("s") <= last), F.min(F.when(F.col("s") > last, F.col("s")))).first()
    return last if upto > worse or above is None else (last + above) / 2


def modelled(figures: DataFrame, labels: DataFrame, ident: str, label: str, sample: int) -> Model:
    """Weights from the sample, the threshold from all usable labels of documents in the table.

    Labels without a document are left out before the sample is drawn.
    """
    present = figures.select(ident).distinct().hint("merge")
    known = written(usable(labels, ident, label).join(present, ident, "left_semi"), "known_labels")
    model = learn(sampled(known, ident, sample).join(figures, ident))
    if not model.weights.any():
        return model
    strengths = figures.select(F.col(ident), model.strength().alias("s")).join(known.hint("merge"), ident)
    return replace(model, threshold=threshold(written(strengths.select("y", "s"), "strengths")))


def score_quality(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text",
                  label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Identifier, held_out, score and predicted for every row of ``docs``."""
    figures = written(featured(docs, ident, text), "figures")
    model = modelled(figures, labels, ident, label, sample)
    return figures.select(F.col(ident), held_out(ident).alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text",
              label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``CUT``, all their columns."""
    model = modelled(written(featured(docs, ident, text), "figures"), labels, ident, label, sample)
    return featured(docs, ident, text, carry=True).filter(model.score() >= CUT).select("row.*")
