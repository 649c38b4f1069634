"""Exact dedup: Patricia tries own the distinct texts.

Every map task inserts its normalised texts into a radix trie, so a text that a third of all rows
share leaves the task once. The distinct texts go to partitions by byte length and content hash, where
a second trie holds full byte strings; a terminal node keeps the smallest identifier and the number of
rows. Tries are bounded: a map task over its bound hands on the entries of its largest subtree and
forgets them; a reduce task moves the subtree to a file of its own, sends later entries with that
prefix there, and works the file off at the end with a fresh trie. Results are never approximated.

Rows get their owner through the digest of their text and its length. Two byte strings with one digest
would be two terminals of one partition; that stops the run instead of merging them.

Null text counts as empty. Null identifiers are greater than all others. Of rows equal in text and
identifier one is kept. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import ast
import hashlib
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlens.llm.common import prepared, text_or_empty, written

TRIE_BYTES = 48 << 20
NODE_BYTES = 400  # a node beside its label
Entry = tuple[bytes, object, int, int]  # text, smallest identifier, rows with it, all rows


class _Node:
    __slots__ = ("label", "children", "ident", "ties", "count", "size", "spilled")

    def __init__(self, label: bytes):
        self.label, self.children = label, {}
        self.ident, self.ties, self.count = None, 0, 0
        self.size, self.spilled = len(label) + NODE_BYTES, None


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Texts with smallest identifier and row count; never more than about ``limit`` bytes in memory.

    ``on_spill`` takes the entries of a subtree that has to go; without it they go to a file.
    """

    def __init__(self, limit: int = TRIE_BYTES, on_spill=None):
        self.root, self.limit, self.on_spill = _Node(b""), limit, on_spill

    def insert(self, text: bytes, ident, ties: int = 1, count: int = 1) -> None:
        node, at, path = self.root, 0, [self.root]
        while at < len(text):
            if node.spilled is not None:
                break
            child = node.children.get(text[at])
            if child is None:
                child = _Node(text[at:])
                node.children[text[at]] = child
                for above in path:
                    above.size += child.size
            elif not text.startswith(child.label, at):
                child = self._split(node, child, text[at:], path)
            at += len(child.label)
            node = child
            path.append(node)
        if node.spilled is not None:
            _write(node.spilled, (text, ident, ties, count))
            return
        if node.count and ident == node.ident:
            node.ties += ties
        elif not node.count or node.ident is None or (ident is not None and ident < node.ident):
            node.ident, node.ties = ident, ties
        node.count += count
        if self.root.size > self.limit:
            self._spill()

    @staticmethod
    def _split(parent: _Node, child: _Node, rest: bytes, path: list[_Node]) -> _Node:
        """A node at the end of the common prefix, above the old child."""
        cut = _common(child.label, rest)
        middle = _Node(child.label[:cut])
        child.label = child.label[cut:]
        child.size -= cut
        middle.children[child.label[0]] = child
        middle.size += child.size
        parent.children[middle.label[0]] = middle
        for above in path:
            above.size += NODE_BYTES
        return middle

    def _spill(self) -> None:
        """Frees the largest subtree below a branching; goes down while one child holds most of the trie.

        The subtree's own prefix is longer than what all entries share, so the trie that takes it up
        again starts from fewer entries or deeper, and the work ends.
        """
        path, branched = [self.root], False
        while path[-1].children:
            above = path[-1]
            branched = branched or len(above.children) > 1 or above.count > 0
            path.append(max(above.children.values(), key=lambda n: n.size))
            if path[-1].spilled is not None or (branched and path[-1].size <= self.limit // 2):
                break
        node = path[-1]
        if not branched or node.spilled is not None:
            self.limit = 2 * self.root.size  # one text, or prefixes of spilled files only: nothing to free
            return
        freed = node.size - NODE_BYTES - len(node.label)
        files: list = []
        entries = _walk(node, b"".join(n.label for n in path[:-1]), files)
        if self.on_spill is not None:
            self.on_spill(list(entries))
            freed += NODE_BYTES + len(node.label)
            del path[-2].children[node.label[0]]
            path.pop()
        else:
            file = tempfile.TemporaryFile()
            for entry in entries:
                _write(file, entry)
            for inner in files:  # subtrees of this one that went before
                inner.seek(0)
                for entry in _read(inner):
                    _write(file, entry)
                inner.close()
            node.children, node.count, node.ident, node.spilled = {}, 0, None, file
        for above in path:
            above.size -= freed

    def entries(self) -> Iterator[Entry]:
        """All entries; spilled subtrees one after another, each with a trie of its own."""
        files = []
        yield from _walk(self.root, b"", files)
        self.root = _Node(b"")
        for file in files:
            trie = PatriciaTrie(self.limit, self.on_spill)
            file.seek(0)
            for entry in _read(file):
                trie.insert(*entry)
            file.close()
            yield from trie.entries()


def _walk(node: _Node, above: bytes, files: list | None = None) -> Iterator[Entry]:
    stack = [(node, above)]
    while stack:
        node, above = stack.pop()
        text = above + node.label
        if node.spilled is not None and files is not None:
            files.append(node.spilled)
        if node.count:
            yield text, node.ident, node.ties, node.count
        stack.extend((child, text) for child in node.children.values())


def _write(file, entry: Entry) -> None:
    text, ident, ties, count = entry
    known = b"" if ident is None else repr(ident).encode()
    file.write(struct.pack("<qqqq", len(text), len(known), ties, count) + text + known)


def _read(file) -> Iterator[Entry]:
    while head := file.read(32):
        n, k, ties, count = struct.unpack("<qqqq", head)
        text, known = file.read(n), file.read(k)
        yield text, ast.literal_eval(known.decode()) if k else None, ties, count


def normalised(text: str | Column) -> Column:
    """Each run of ASCII white space as one space; single spaces are left alone, which is faster."""
    return F.regexp_replace(
        text_or_empty(text), "[\\x09-\\x0D][\\x20\\x09-\\x0D]*|\\x20[\\x20\\x09-\\x0D]+", " ")


def _tries(limit: int, partial: bool):
    def run(batches):
        out: list[Entry] = []
        trie = PatriciaTrie(limit, out.extend if partial else None)

        def batch(entries: list[Entry]) -> pa.RecordBatch:
            texts = [e[0] for e in entries]
            columns = [pa.array([e[1] for e in entries], kind), pa.array([e[2] for e in entries], pa.int64()),
                       pa.array([e[3] for e in entries], pa.int64())]
            if partial:
                return pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.binary()), *columns], names=["text", "ident", "ties", "n"])
            return pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), *columns],
                names=["digest", "n_bytes", "keep", "ties", "n"])

        kind = pa.int64()
        for rows in batches:
            kind = rows.column("ident").type
            for entry in zip(*(rows.column(c).to_pylist() for c in ("text", "ident", "ties", "n"))):
                trie.insert(*entry)
                if len(out) >= 256:
                    yield batch(out)
                    out.clear()
        if out:
            yield batch(out)
            out.clear()
        for entry in trie.entries():
            out.append(entry)
            if len(out) >= 256:
                yield batch(out)
                out.clear()
        if out:
            yield batch(out)

    return run


def owners(texts: DataFrame, kind: str, limit: int = TRIE_BYTES) -> DataFrame:
    """Every distinct text of ``texts`` (text binary, ident): digest, n_bytes, keep (the smallest
    identifier), ties (rows with that identifier), n (rows)."""
    one = F.lit(1).cast("bigint")
    rows = texts.select("text", "ident", one.alias("ties"), one.alias("n"))
    local = rows.mapInArrow(_tries(limit, True), f"text binary, ident {kind}, ties bigint, n bigint")
    dealt = local.repartition(F.octet_length("text"), F.xxhash64("text"))
    return dealt.mapInArrow(
        _tries(limit, False), f"digest string, n_bytes bigint, keep {kind}, ties bigint, n bigint")


def told_apart(groups: DataFrame) -> DataFrame:
    """``groups`` as a stored table; an error if two texts share length and digest.

    A row per distinct text is stored and counted on its own, so that nothing stands between the shuffle
    and the join of ``mark_copies``, whose hot digests adaptive execution then splits.
    """
    stored = written(groups, "owners")
    twins = stored.groupBy("digest", "n_bytes").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    if twins.limit(1).count():
        raise ValueError("two texts share length and digest")
    return stored


def mark_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text",
                limit: int = TRIE_BYTES, carry: bool = False) -> DataFrame:
    """A row per row of ``docs``: identifier, keep_id, group_size, kept, text_sha256.

    With ``carry`` all columns of ``docs`` come as the struct ``row`` in place of the identifier.
    """
    prepared(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]
    plain = normalised(text).cast("binary")
    groups = told_apart(owners(docs.select(plain.alias("text"), F.col(ident).alias("ident")), kind, limit))
    body = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.struct(F.col(ident))
    rows = docs.select(body.alias("row"), F.sha2(plain, 256).alias("digest"),
                       F.octet_length(plain).cast("bigint").alias("n_bytes"))
    mine = F.col("row")[ident].eqNullSafe(F.col("keep"))
    joined = rows.join(groups.hint("merge"), ["digest", "n_bytes"], "left").withColumn("mine", mine)
    # Rows that repeat the owner's identifier are rare; only they are numbered.
    repeated = F.col("mine") & (F.col("ties") > 1)
    number = F.row_number().over(Window.partitionBy("digest", "n_bytes").orderBy(F.xxhash64("row")))
    single = joined.filter(~repeated).withColumn("kept", F.col("mine"))
    several = joined.filter(repeated).withColumn("kept", number == 1)
    return single.unionByName(several).select(
        *(["row"] if carry else [F.col("row")[ident].alias(ident)]),
        F.col("keep").alias("keep_id"), F.col("n").alias("group_size"), "kept",
        F.col("digest").alias("text_sha256"))
