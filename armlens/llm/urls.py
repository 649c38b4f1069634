"""URL filter: glob rules run as one bit-parallel wildcard automaton over every canonical URL.

A rule ``host/path`` is the glob ``*.host/path*`` over the canonical form ``.host/path`` of a URL. All
globs are packed end to end into 64-bit words, a bit for every prefix of a glob. One Shift-And step
per byte moves every rule of every URL of a batch at once; a star is a loop on the bit before it, in
the host over all bytes but the slash, in the path over all bytes. The work is a map over the URLs:
no shuffle, so hot hosts cost nothing.

Null URLs and URLs without ``://`` have empty host and path, fit no rule and get the default verdict.
An empty table gives no rows. Columns other than the identifier and the URL are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import ascii_lower, prepared, text_bytes

BLOCK_BITS = 1 << 26  # automaton bits held at once
ANY = np.ones(256, bool)
HOST = ANY.copy()
HOST[ord("/")] = False


@dataclass(frozen=True)
class Rule:
    """``host`` fits itself and its subdomains; ``path`` is a prefix and may hold stars."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class Automaton:
    """Shift-And masks of all rules, the most telling (longest) first."""

    def __init__(self, rules: list[Rule]):
        self.rules = sorted(rules, key=lambda r: (-len(r.name), r.name, r.verdict))
        tokens = [self._tokens(rule) for rule in self.rules]
        bits = sum(len(t) for t in tokens)
        self.words = max(1, -(-bits // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        self.accept: list[tuple[int, int]] = []
        at = 0
        for literals in tokens:
            self._set(self.first, at)
            for byte, loop in literals:
                if byte is not None:
                    self._set(self.step[byte], at)
                if loop is not None:
                    for c in np.flatnonzero(loop):
                        self._set(self.stay[c], at)
                at += 1
            self.accept.append(((at - 1) // 64, (at - 1) % 64))

    @staticmethod
    def _tokens(rule: Rule) -> list[tuple[int | None, np.ndarray | None]]:
        """States of the glob: the byte that leads into each, and the bytes that keep it alive."""
        states: list[tuple[int | None, np.ndarray | None]] = [(None, HOST)]
        for part, kind in (("." + rule.host, HOST), (rule.path, ANY)):
            for byte in part.encode():
                if byte == ord("*"):
                    states[-1] = (states[-1][0], kind)
                else:
                    states.append((byte, None))
        states[-1] = (states[-1][0], ANY)
        return states

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def best(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Position of the first rule that fits each URL, -1 for none."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = offsets[:-1][order], lengths[order]
        alive = np.tile(self.first, (len(order), 1))
        n = len(order)
        one, top = np.uint64(1), np.uint64(63)
        for i in range(int(lengths[0]) if n else 0):
            n = int(np.searchsorted(-lengths, -i, "left"))  # URLs longer than i
            chars, now = data[starts[:n] + i], alive[:n]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            alive[:n] = (moved & self.step[chars]) | (now & self.stay[chars])
        found = np.full(len(order), -1)
        for rule in range(len(self.rules) - 1, -1, -1):
            word, bit = self.accept[rule]
            found[(alive[:, word] >> np.uint64(bit)) & one > 0] = rule
        out = np.empty_like(found)
        out[order] = found
        return out


def host_and_path(url: str):
    """Host (A-Z lower-cased) and path of a URL column."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    return (
        ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    )


def filter_urls(pages: DataFrame, rules: list[Rule], ident: str = "page_id", url: str = "url",
                default: str = "allow") -> DataFrame:
    """One row per page: identifier, host, path, rule that decided (null for none), verdict."""
    prepared(pages.sparkSession)
    host, path = host_and_path(url)
    parts = pages.select(F.col(ident), host.alias("host"), path.alias("path"))
    parts = parts.withColumn("canonical", F.concat(F.lit("."), "host", "path"))
    automaton = Automaton(rules)
    names = np.array([r.name for r in automaton.rules] + [None], object)
    verdicts = np.array([r.verdict for r in automaton.rules] + [default], object)
    block = max(64, BLOCK_BITS // (64 * automaton.words))

    def judged(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("canonical"))
            best = [np.zeros(0, int)]
            for start in range(0, batch.num_rows, block):
                part = offsets[start:start + block + 1]
                best.append(automaton.best(data, part))
            best = np.concatenate(best)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column("host"), batch.column("path"),
                 pa.array(names[best], pa.string()), pa.array(verdicts[best], pa.string())],
                names=[ident, "host", "path", "rule", "verdict"])

    kind = dict(parts.dtypes)[ident]
    return parts.mapInArrow(judged, f"`{ident}` {kind}, host string, path string, rule string, verdict string")
