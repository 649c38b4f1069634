"""N-gram Jaccard join: exact links between documents in the metric space of the Jaccard distance.

Unrelated documents all lie at distance 1 or nearly so, so pivots drawn from the whole corpus would put
every document into every window. The join therefore goes down in three steps, each exact:

1. Sizes and parts. Linked sets differ in few shingles, and so in few of the parts that a hash deals the
   shingles to: in all others they agree, that is, they lie in one cell. There are half as many more parts
   than differences allowed, so a set has a partner only if it shares at least a third of its cells, and
   sets that merely have a passage in common drop out here. The number of parts depends on the size, so
   sizes form bands, and a set whose partners may be in the next band goes to both (the triangle
   inequality with the empty set as pivot).
2. Coarse regions are the components of the remaining sets by the cells they share.
3. In a region pivots are drawn from its sets. Each pivot's Voronoi cell gets its sets and those of other
   cells whose distances differ by at most twice the threshold; no link is lost. Cells are joined by the
   same method until they are small or no longer shrink; there links are searched from set to set, and the
   distances to the pivots rule out most comparisons.

Only links that connect are looked for: sets already in one component are not compared, so thousands of
near copies cost no pairs. Equal sets are linked by their hash before and travel once. A region over
``LIMIT`` sets is never in one task: pivots link the sets around them in parallel blocks, round by round,
and what lies outside the region's largest component is compared with all its blocks.

Words are what ASCII white space leaves, with A-Z lower-cased. Null and empty texts have no shingles and
no links. Rows with one identifier are one document of the graph, each with its own number of shingles and
all with the links of any; a null identifier counts as the smallest whole number there is. Identifiers are
whole numbers. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from armlens.llm.common import (
    BETWEEN_SPACES, buckets, mixed, prepared, run_hashes, slices, text_bytes, window_hashes, word_hashes,
    word_spans, written,
)
from armlens.llm.components import components
from armlens.llm.repeats import KEY_BYTES, _pack, _unpack, distinct, from_low_bytes, low_bytes

SHINGLE, PERCENT = 3, 90
CHUNK_BYTES, SLICE_BYTES = 8 << 20, 1 << 20
LIMIT = 4_000  # sets of a region in one task
LEAF, PIVOTS = 256, 8
NULL = -(1 << 63)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


# ---- sets of shingles ---------------------------------------------------------------------------------

def shingle_sets(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and where each row's begin (one more at the end)."""
    n = len(offsets) - 1
    data = _LOWER[data]
    starts, ends, rows = word_spans(data, offsets, BETWEEN_SPACES)
    words = word_hashes(data, starts, ends)
    counts = np.bincount(rows, minlength=n)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(max(0, len(words) - length + 1))
    at = at[rows[at] == rows[at + length - 1]] if len(at) else at
    short = np.flatnonzero((counts > 0) & (counts < length))
    hashes = np.concatenate((window_hashes(words, at, length),
                             run_hashes(words, bounds[short], bounds[short + 1], 0xD1342543DE82EF95)))
    owner = np.concatenate((rows[at], short))
    by = np.lexsort((hashes, owner))
    hashes, owner = hashes[by], owner[by]
    new = np.ones(len(by), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))


def bands(largest: int) -> np.ndarray:
    """Smallest size of each band."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(edges[-1] * 3 // 2 + 1)
    return np.array(edges)


@dataclass
class Cells:
    """Key, set and band of every cell a set lies in; set, band and number of cells to be shared."""

    key: np.ndarray
    owner: np.ndarray
    band: np.ndarray
    needs: np.ndarray


def cells(hashes: np.ndarray, bounds: np.ndarray, percent: int) -> Cells:
    sizes = np.diff(bounds)
    edges = bands(int(sizes.max(initial=0)) * 100 // percent + 1)
    home = np.searchsorted(edges, sizes, "right") - 1
    top = np.searchsorted(edges, sizes * 100 // percent, "right") - 1  # where the largest partner may be
    none = np.zeros(0, np.int64)
    keys, owners, numbers, needs = [none.astype(np.uint64)], [none], [none], [none.reshape(0, 3)]
    for step in range(int((top - home)[sizes > 0].max(initial=-1)) + 1):
        band = home + step
        chosen = np.flatnonzero((sizes > 0) & (band <= top))
        allowed = (edges[np.minimum(band[chosen] + 1, len(edges) - 1)] - 1) * (100 - percent) // percent
        parts = allowed + 1 + (allowed + 1) // 2
        base = np.concatenate(([0], np.cumsum(parts)))
        lengths = sizes[chosen]
        source = np.repeat(bounds[chosen] - np.concatenate(([0], np.cumsum(lengths)))[:-1], lengths) + np.arange(lengths.sum())
        h = hashes[source]
        which = np.repeat(np.arange(len(chosen)), lengths)
        part = base[which] + ((h >> np.uint64(24)) % parts[which].astype(np.uint64)).astype(np.int64)
        sums, held = np.zeros(base[-1], np.uint64), np.zeros(base[-1], bool)
        np.add.at(sums, part, mixed(h ^ np.uint64(0xA24BAED4963EE407)))
        held[part] = True
        of = np.repeat(np.arange(len(chosen)), parts)
        number = np.arange(base[-1]) - base[of]
        key = mixed(sums + mixed((band[chosen][of].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64)))
        # At most so many parts of a set differ from a partner's. Parts without a shingle count only
        # where a set might agree on nothing else.
        differ = lengths * (100 - percent) // percent
        filled = np.bincount(of, held, minlength=len(chosen)).astype(np.int64)
        posted = held | (filled <= differ)[of]
        keys.append(key[posted])
        owners.append(chosen[of[posted]])
        numbers.append(band[chosen][of[posted]])
        needs.append(np.stack((chosen, band[chosen], np.maximum(1, filled - differ)), 1))
    return Cells(*map(np.concatenate, (keys, owners, numbers, needs)))


def whole_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per set."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ np.uint64(0x9FB21C651E98DF25)))))
    return mixed(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


# ---- links within one task ------------------------------------------------------------------------------

class Sets:
    """Sets of one task: sorted hashes one after another."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, percent: int):
        values, ids, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        shared = counts[ids] > 1  # the others are in no intersection
        self.sizes = np.diff(bounds)
        # Each set's shingles from rare to frequent; those no other set has come first and are left out.
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)[shared]
        by = np.lexsort((ids[shared], counts[ids[shared]], owner))
        self.ids = ids[shared][by]
        self.bounds = np.concatenate(([0], np.cumsum(shared)))[bounds]
        self._index(percent)
        self.mark = np.zeros(len(values) + 1, bool)
        self.percent = percent
        self.reach = 1 - percent / 100 + 1e-9

    def _index(self, percent: int) -> None:
        """Who has a shingle among the rarest so many that linked sets have to meet in one of them."""
        alone = self.sizes - np.diff(self.bounds)
        long = np.clip(self.sizes - -(-self.sizes * percent // 100) + 1 - alone, 0, np.diff(self.bounds))
        self.prefix = self.bounds[:-1] + long
        at = np.repeat(self.bounds[:-1] - np.concatenate(([0], np.cumsum(long)))[:-1], long) + np.arange(long.sum())
        owner = np.repeat(np.arange(len(self.sizes)), long)
        by = np.lexsort((owner, self.ids[at]))
        self.holders, self.held = owner[by], self.ids[at][by]

    def near(self, x: int) -> np.ndarray:
        """Sets that may be linked with x."""
        own = self.ids[self.bounds[x]:self.prefix[x]]
        low, high = np.searchsorted(self.held, own), np.searchsorted(self.held, own, "right")
        parts = [self.holders[a:b] for a, b in zip(low.tolist(), high.tolist())]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)

    def common(self, x: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of x with each of ``others``."""
        low, high = self.bounds[others], self.bounds[others + 1]
        lengths = high - low
        total = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(low - total[:-1], lengths) + np.arange(total[-1])
        own = self.ids[self.bounds[x]:self.bounds[x + 1]]
        self.mark[own] = True
        hits = np.concatenate(([0], np.cumsum(self.mark[self.ids[at]])))
        self.mark[own] = False
        return hits[total[1:]] - hits[total[:-1]]

    def distances(self, x: int, others: np.ndarray) -> np.ndarray:
        common = self.common(x, others)
        return 1 - common / np.maximum(1, self.sizes[x] + self.sizes[others] - common)

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        common = self.common(x, others)
        return others[100 * common >= self.percent * (self.sizes[x] + self.sizes[others] - common)]

    def pivots(self, members: np.ndarray) -> np.ndarray:
        """Distances of all members to pivots, each the farthest from those before."""
        columns = [self.distances(int(members[0]), members)]
        while len(columns) < min(PIVOTS, len(members)):
            nearest = np.min(columns, 0)
            columns.append(self.distances(int(members[int(np.argmax(nearest))]), members))
        return np.stack(columns, 1)

    def connect(self, members: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links that connect what is connected among ``members``."""
        if len(members) < 2:
            return
        table = self.pivots(members)
        if len(members) > LEAF:
            near = table.min(1)
            inside = table <= near[:, None] + 2 * self.reach
            sizes = inside.sum(0)
            if sizes.sum() <= 1.5 * len(members) and sizes.max() <= 0.8 * len(members):
                for k in range(table.shape[1]):
                    yield from self.connect(members[inside[:, k]])
                return
        yield from self._search(members, table)

    def _search(self, members: np.ndarray, table: np.ndarray) -> Iterator[tuple[int, int]]:
        """From set to set; the rarest shingles and the distances to the pivots tell which to compare."""
        place = np.full(len(self.sizes), -1)
        place[members] = np.arange(len(members))
        unseen = np.ones(len(members), bool)
        for seed in range(len(members)):
            if not unseen[seed]:
                continue
            unseen[seed] = False
            queue = [seed]
            while queue:
                x = queue.pop()
                at = place[self.near(int(members[x]))]
                at = at[at >= 0]
                at = at[unseen[at]]
                at = at[np.abs(table[at] - table[x]).max(1) <= self.reach] if len(at) else at
                if not len(at):
                    continue
                found = place[self.linked(int(members[x]), members[at])]
                for y in found.tolist():
                    yield int(members[x]), int(members[y])
                unseen[found] = False
                queue.extend(found.tolist())


def region_links(percent: int):
    """Connecting links of the sets of one group of rows (node, n, shingles)."""

    def run(rows: pa.Table) -> pa.Table:
        nodes, sets = _loaded(rows, percent)
        return _links(nodes, sets.connect(np.arange(len(nodes))))

    return run


def block_links(percent: int):
    """Links of the rows of a block (role 0) with the visiting sets (role 1), for groups of both."""

    def run(rows: pa.Table) -> pa.Table:
        nodes, sets = _loaded(rows, percent)
        role = rows["role"].to_numpy()
        visitors = np.flatnonzero(role == 1)
        hosts = lambda x: (n := sets.near(x))[role[n] == 0]
        pairs = ((x, y) for x in visitors.tolist() if len(n := hosts(x)) for y in sets.linked(x, n).tolist())
        return _links(nodes, pairs)

    return run


def _loaded(rows: pa.Table, percent: int) -> tuple[np.ndarray, Sets]:
    parts = [np.frombuffer(b, "<u8") for b in rows["shingles"].to_pylist()]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
    return rows["node"].to_numpy(), Sets(np.concatenate(parts) if parts else np.zeros(0, np.uint64), bounds, percent)


def _links(nodes: np.ndarray, pairs) -> pa.Table:
    pairs = np.array(list(pairs), np.int64).reshape(-1, 2)
    a, b = nodes[pairs[:, 0]], nodes[pairs[:, 1]]
    keep = a != b
    return pa.table([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep])], names=["a", "b"])


# ---- cells over the corpus ------------------------------------------------------------------------------

POSTS = ("bucket int, keys binary, checks binary, nodes binary, bands binary, equal binary, members binary, "
         "counts binary, needs binary")
EQUAL, MEMBER, COUNT, NEED = range(4)  # kinds of rows found


@dataclass
class _Part:
    """What a slice of documents brings to its chunk."""

    nodes: np.ndarray
    counts: np.ndarray
    whole: np.ndarray
    cells: Cells


def _posts(shingle: int, percent: int, parts: int):
    """Per chunk and bucket: its cells, each once with its smallest document; per chunk: links of equal
    sets, members of cells that are shared inside it, every document's number of shingles, and how many
    cells it has to share."""

    def chunk(held: list[_Part]) -> pa.RecordBatch:
        nodes, counts, whole = (np.concatenate([getattr(h, c) for h in held]) for c in ("nodes", "counts", "whole"))
        at = np.cumsum([0] + [len(h.nodes) for h in held])
        owner = np.concatenate([h.cells.owner + a for h, a in zip(held, at)])
        key, band = (np.concatenate([getattr(h.cells, c) for h in held]) for c in ("key", "band"))
        needs = np.concatenate([h.cells.needs + (a, 0, 0) for h, a in zip(held, at)])
        some = np.flatnonzero(counts)
        sent = distinct(whole[some], nodes[some], 1, width=8)
        same = sent.order[sent.member]
        equal = np.stack((same, nodes[some]), 1)[same != nodes[some]]
        # Of equal sets only the one with the smallest identifier goes on.
        lead = np.flatnonzero(same == nodes[some])
        first = np.full(len(sent.key), -1)
        first[sent.member[lead[::-1]]] = some[lead[::-1]]
        heads = first[first >= 0]
        leads = np.zeros(len(nodes), bool)
        leads[heads] = True
        chosen = leads[owner]
        heads = np.flatnonzero(leads)
        key = np.concatenate((key[chosen] & ~np.uint64(1 << 20), mixed(whole[heads]) | np.uint64(1 << 20)))
        owner = np.concatenate((owner[chosen], heads))
        band = np.concatenate((band[chosen], np.full(len(heads), 255)))
        cell = distinct(key, nodes[owner], parts)
        check = np.zeros(len(cell.key), np.uint64)  # more of the hash of a whole set
        check[cell.member[len(owner) - len(heads):]] = (whole[heads] >> np.uint64(24)) | np.uint64(1)
        kind = np.zeros(len(cell.key), np.int64)
        kind[cell.member] = band
        inner = cell.several[cell.member] & (band < 255)
        names = (cell.bucket << 8 * cell.width) | cell.key.astype(np.int64)
        members = np.stack((names[cell.member[inner]], nodes[owner[inner]], band[inner]), 1)
        needs = needs[leads[needs[:, 0]]]
        needs[:, 0] = nodes[needs[:, 0]]
        met, cut = cell.bounds()
        cut = list(zip(cut[:-1], cut[1:]))
        nothing = [b""] * len(met)
        columns = [
            [low_bytes(cell.key[a:b]) for a, b in cut] + [b""], [_pack(check[a:b]) for a, b in cut] + [b""],
            [_columns(cell.order[a:b]) for a, b in cut] + [b""],
            [_pack(kind[a:b].astype(np.uint8)) for a, b in cut] + [b""], nothing + [_columns(equal.ravel())],
            nothing + [_columns(members.T.ravel())], nothing + [_columns(np.stack((nodes, counts)).ravel())],
            nothing + [_columns(needs.T.ravel())]]
        spread = -1 - int(nodes[0]) % parts
        return pa.RecordBatch.from_arrays(
            [pa.array([int(b) for b in met] + [spread], pa.int32()), *[pa.array(c, pa.binary()) for c in columns]],
            names=["bucket", "keys", "checks", "nodes", "bands", "equal", "members", "counts", "needs"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            for a, b in slices(offsets, SLICE_BYTES):
                hashes, bounds = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], shingle)
                held.append(_Part(nodes[a:b].astype(np.int64), np.diff(bounds), whole_keys(hashes, bounds),
                                  cells(hashes, bounds, percent)))
                size += int(offsets[b] - offsets[a])
                if size >= CHUNK_BYTES:
                    yield chunk(held)
                    held, size = [], 0
        if held:
            yield chunk(held)

    return run


def _columns(x: np.ndarray) -> bytes:
    """Whole numbers, byte by byte, compressed."""
    return _pack(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T)) if len(x) else b""


def _numbers(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    return np.ascontiguousarray(_unpack(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


FOUND = "kind int, a bigint, b bigint, c bigint"


def _met(rows: pa.Table) -> pa.Table:
    """Rows of one bucket: documents of different chunks with a cell in common, or what chunks have
    found in themselves."""
    if rows["bucket"][0].as_py() < 0:
        parts = []
        for kind, name, width in ((EQUAL, "equal", 2), (MEMBER, "members", 3), (COUNT, "counts", 2), (NEED, "needs", 3)):
            for data in rows[name].to_pylist():
                numbers = _numbers(data)
                numbers = numbers.reshape(-1, 2).T if kind == EQUAL else numbers.reshape(width, -1)
                parts.append(_rows(kind, *numbers))
        return pa.concat_tables(parts)
    bucket = rows["bucket"][0].as_py()
    key = np.concatenate([from_low_bytes(k) for k in rows["keys"].to_pylist()])
    check = np.concatenate([_unpack(c, np.uint64) for c in rows["checks"].to_pylist()])
    node = np.concatenate([_numbers(n) for n in rows["nodes"].to_pylist()])
    band = np.concatenate([_unpack(b, np.uint8) for b in rows["bands"].to_pylist()]).astype(np.int64)
    by = np.lexsort((node, check, key))
    key, node, check, band = key[by], node[by], check[by], band[by]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    heads, group = np.flatnonzero(new), np.cumsum(new) - 1
    lowest = node[heads][group]
    shared = (np.bincount(group) > 1)[group]
    same, cell = (check > 0) & (lowest != node), shared & (check == 0)
    names = (bucket << 8 * KEY_BYTES) | key.astype(np.int64)
    return pa.concat_tables([_rows(EQUAL, lowest[same], node[same]), _rows(MEMBER, names[cell], node[cell], band[cell])])


def _rows(kind: int, a: np.ndarray, b: np.ndarray, c: np.ndarray | None = None) -> pa.Table:
    c = np.zeros(len(a), np.int64) if c is None else c
    return pa.table([pa.array(np.full(len(a), kind), pa.int32()), pa.array(a), pa.array(b), pa.array(c)],
                    names=["kind", "a", "b", "c"])


def candidates(found: DataFrame) -> DataFrame:
    """Links (a, b) of sets that share cells, few enough to keep regions small and enough to lose none.

    Sets that share fewer cells than they need drop out. Of the others each leaves aside the most
    frequent of its cells, one less than it has to share with a partner: with all cells in one order, a
    pair that shares that many still meets in a rarer one. So a passage that many documents have ties
    no region together.
    """
    members = found.filter(F.col("kind") == MEMBER).select(
        F.col("a").alias("cell"), F.col("b").alias("node"), F.col("c").cast("int").alias("band")).distinct()
    needs = found.filter(F.col("kind") == NEED).groupBy(
        F.col("a").alias("node"), F.col("b").cast("int").alias("band")).agg(F.min("c").cast("int").alias("need"))
    enough = members.groupBy("node", "band").agg(F.count(F.lit(1)).alias("shared")).join(needs, ["node", "band"]).filter(
        F.col("shared") >= F.col("need")).select("node", "band", "need")
    left = written(members.join(enough, ["node", "band"]), "members")
    often = left.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    place = F.row_number().over(Window.partitionBy("node", "band").orderBy(F.desc("n"), F.desc("cell")))
    rare = written(left.join(often, "cell").withColumn("place", place).filter(F.col("place") >= F.col("need"))
                   .select("cell", "node"), "rare_members")
    stars = rare.groupBy("cell").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return rare.join(stars, "cell").select("a", F.col("node").alias("b")).filter(F.col("a") != F.col("b")).distinct()


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slices(offsets, SLICE_BYTES):
                hashes, bounds = shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("region").slice(a, b - a), batch.column("node").slice(a, b - a),
                     pa.array([hashes[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    names=["region", "node", "shingles"])

    return run


# ---- the join ---------------------------------------------------------------------------------------------

def _large_regions(sets: DataFrame, percent: int, limit: int, rounds: int) -> DataFrame:
    """Connecting links of regions over the limit (region, node, shingles, size)."""
    blocks, zero = F.ceil(F.col("size") / limit).cast("bigint"), F.lit(0).cast("bigint")
    dealt = written(sets.withColumn("block", F.pmod(F.xxhash64("node"), blocks)), "large_sets")
    links = None
    outside = dealt.select("region", "node")
    for number in range(rounds + 1):
        last = number == rounds
        if last:  # all that are left visit all blocks
            chosen = outside
        else:
            order = F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("node", F.lit(number)), "node"))
            chosen = outside.withColumn("at", order).filter(F.col("at") <= PIVOTS).drop("at")
        visitors = dealt.drop("block").join(chosen, ["region", "node"])
        # Visitors of one group are bounded too: their own share of blocks is a further key.
        share = F.pmod(F.xxhash64("node", F.lit(1)), blocks) if last else zero
        visitors = visitors.withColumn("share", share).withColumn("role", F.lit(1)).select(
            "*", F.explode(F.sequence(zero, blocks - 1)).alias("block"))
        shares = blocks if last else zero + 1
        hosts = dealt.withColumn("role", F.lit(0)).select(
            "*", F.explode(F.sequence(zero, shares - 1)).alias("share"))
        columns = ["region", "block", "share", "role", "node", "shingles"]
        rows = hosts.select(columns).unionByName(visitors.select(columns))
        found = written(rows.groupBy("region", "block", "share").applyInArrow(
            block_links(percent), "a bigint, b bigint"), "large_links")
        links = found if links is None else links.unionByName(found)
        if last:
            break
        labels = components(links, "large_components")
        labelled = dealt.select("region", "node").join(labels, "node", "left").withColumn(
            "label", F.coalesce("label", "node"))
        groups = labelled.groupBy("region", "label").agg(F.count(F.lit(1)).alias("n"))
        largest = groups.groupBy("region").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
        outside = written(labelled.join(largest, "region").filter(F.col("label") != F.col("largest"))
                          .select("region", "node"), "outside")
        if not outside.limit(1).count():
            break
    return links


def join_similar(docs: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 percent: int = PERCENT, limit: int = LIMIT, rounds: int = 3) -> DataFrame:
    """Identifier, n_shingles and component_id of every row: the smallest identifier that links reach."""
    spark = prepared(docs.sparkSession)
    kind = dict(docs.dtypes)[ident]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{ident} has to be a whole number")
    rows = docs.select(F.coalesce(F.col(ident).cast("bigint"), F.lit(NULL)).alias("node"), F.col(text).alias("text"))
    posts = rows.mapInArrow(_posts(shingle, percent, buckets(spark)), POSTS)
    found = written(posts.groupBy("bucket").applyInArrow(_met, FOUND), "cell_links")
    equal = found.filter(F.col("kind") == EQUAL).select("a", "b")
    regions = components(candidates(found), "regions")
    # A copy's set is searched through the copy of the smallest identifier, unless the copy has other sets.
    rows_of = found.filter(F.col("kind") == COUNT).groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("rows"))
    repeated = written(rows_of.filter(F.col("rows") > 1).select("node"), "repeated")
    copies = equal.select(F.col("b").alias("node")).distinct().join(repeated.hint("merge"), "node", "left_anti")
    members = regions.join(copies, "node", "left_anti")
    sized = members.groupBy("label").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    members = members.join(sized, "label").select(F.col("label").alias("region"), "node", "size")
    # Candidates grow with the corpus, so they are never broadcast, at no size.
    texts = rows.join(members.select("region", "node").hint("merge"), "node")
    sets = texts.select("region", "node", "text").mapInArrow(
        _sets(shingle), "region bigint, node bigint, shingles binary")
    if repeated.limit(1).count():
        # Their equal sets once each: partial sums leave one row a task of an identifier that many rows have.
        alone = sets.join(repeated.hint("merge"), "node", "left_anti")
        sets = alone.unionByName(
            sets.join(repeated.hint("merge"), "node", "left_semi").groupBy("region", "node", "shingles").agg(
                F.count(F.lit(1)).alias("rows")).drop("rows"))
    largest = sized.agg(F.max("size")).first()[0] or 0
    grouped = sets
    links = equal
    if largest > limit:
        sets = written(sets, "sets").join(sized.select(F.col("label").alias("region"), "size"), "region")
        links = links.unionByName(_large_regions(sets.filter(F.col("size") > limit), percent, limit, rounds))
        grouped = sets.filter(F.col("size") <= limit).drop("size")
    links = links.unionByName(grouped.groupBy("region").applyInArrow(region_links(percent), "a bigint, b bigint"))
    labels = components(links)
    counted = found.filter(F.col("kind") == COUNT).select(F.col("a").alias("node"), F.col("b").alias("n_shingles"))
    real = lambda c: F.when(c != NULL, c).cast(kind)
    return counted.join(labels, "node", "left").select(
        real(F.col("node")).alias(ident), "n_shingles", real(F.coalesce("label", "node")).alias("component_id"))
