"""Merkle manifest of a dataset: a tree of digests per group, a tree over the groups, proofs per row.

A row's leaf is the SHA-256 of its columns in a fixed order, each ``-`` if null, else the number of its
UTF-8 bytes, a colon and the value. The leaves of a group stand by identifier, then digest. While a
group has more than one node, every ``FANOUT`` consecutive nodes are a run and make one node of the next
level. What remains is the group's subroot; the subroots, by group, make the root in the same way.

Slot pivot: a level is one aggregation by run in which conditional maxima spread the children over a
column per slot. The digest of the concatenated columns is the run's node; the columns without a child's
own, those before it and those after it, are its siblings. Going down again, every run gives each of its
children the path above it with those siblings in front. A path is never stored for a row: it is made
where the lowest runs are, so what is shuffled on the way down is one path per run.

A group that holds a third of all rows is spread over ranges when it is ordered (see ``order``) and over
its runs after that. The number of levels is the logarithm of the largest group.

Nulls in any column are part of the leaf; the null group is a group of its own and comes first, null
identifiers stand first in their group. Rows that agree in all columns have one digest and stand next to
each other. Columns not named are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from armlens.llm.common import prepared, written
from armlens.llm.order import placed

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SEPARATOR = ""


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of texts one after another; null parts are left out."""
    return F.sha2(F.concat_ws(SEPARATOR, *parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A column as it enters a leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: Sequence[str], **changed: Column) -> Column:
    """The leaf of a row, with columns replaced by others if given."""
    return digest(*[field(changed.get(c, F.col(f"`{c}`"))) for c in columns])


def _slots(fanout: int) -> list[str]:
    return [f"slot{i}" for i in range(fanout)]


def _runs(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level of ``nodes`` (tree, place, n, node): tree, place, n, digest, a column per slot."""
    spread = [F.expr(f"max(CASE WHEN pmod(place, {fanout}) = {i} THEN node END) AS {name}")
              for i, name in enumerate(_slots(fanout))]
    parent = F.floor(F.col("place") / fanout).cast("bigint").alias("place")
    return nodes.groupBy("tree", parent).agg(F.max("n").alias("n"), *spread).select(
        "tree", "place", F.ceil(F.col("n") / fanout).cast("bigint").alias("n"),
        digest(*[F.col(s)["digest"] for s in _slots(fanout)]).alias("digest"), *_slots(fanout))


def _climb(nodes: DataFrame, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels of runs, lowest first, and the last node of each tree (tree, digest)."""
    levels, tops = [], []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        tops.append(nodes.filter("n = 1").select("tree", "node.digest"))
        if largest <= 1:
            return levels, reduce(DataFrame.unionByName, tops)
        levels.append(written(_runs(nodes.filter("n > 1"), fanout), name))
        nodes = levels[-1].select("tree", "place", "n", F.struct("digest").alias("node"))
        largest = -(-largest // fanout)


def _children(runs: DataFrame, above: DataFrame, fanout: int) -> DataFrame:
    """The children of ``runs`` (tree, place, node), each with the path of its run and its siblings in
    front of it, and the other columns of ``above``."""
    slots = _slots(fanout)

    def joined(names: list[str]) -> str:
        return f"concat_ws('{SEPARATOR}', {', '.join(f'{s}.digest' for s in names)})" if names else "''"

    each = ", ".join(
        f"IF({own} IS NULL, NULL, named_struct('place', place * {fanout} + {i}, 'node', {own}, 'siblings', "
        f"named_struct('left', {joined(slots[:i])}, 'right', {joined(slots[i + 1:])})))"
        for i, own in enumerate(slots))
    carried = [c for c in above.columns if c not in ("tree", "place", "path")]
    met = runs.drop("n", "digest").join(above.hint("merge"), ["tree", "place"])
    spread = met.select("tree", "path", *carried, F.expr(f"explode(array_compact(array({each})))").alias("child"))
    return spread.select("tree", "child.place", "child.node", *carried,
                         F.concat(F.array("child.siblings"), F.col("path")).alias("path"))


def _descend(levels: list[DataFrame], tops: DataFrame, lone: DataFrame, fanout: int, name: str) -> DataFrame:
    """All lowest nodes (tree, place, node) with their path and what ``tops`` (tree, path, ...) brings.

    ``lone`` are the nodes that are the last of their tree as they are.
    """
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    heads = tops.withColumn("place", F.lit(0).cast("bigint"))
    alone = lone.select("tree", "place", "node").join(tops.hint("merge"), "tree").select(
        "tree", "place", "node", *carried, "path")
    found = [alone]
    for number in range(len(levels) - 1, -1, -1):
        runs = levels[number]
        # Trees of which this run is the last start here, all others come from the level above.
        starts = heads.join(runs.filter("n = 1").select("tree").hint("merge"), "tree", "left_semi")
        above = starts.select("tree", "place", *carried, "path")
        if number < len(levels) - 1:
            above = above.unionByName(below.select("tree", "place", *carried, "path"))
        below = _children(runs, above, fanout)
        if number:
            below = written(below.drop("node"), name)
        else:
            found.append(below.select("tree", "place", "node", *carried, "path"))
    return reduce(DataFrame.unionByName, found)


def prove(rows: DataFrame, group: str = "source", order: str = "doc_id", fanout: int = FANOUT) -> DataFrame:
    """The manifest of ``rows`` (a column ``leaf``, the group and the order, and more that is carried).

    Returns all columns of ``rows`` with subroot, root and path: for every level from the leaf's run to
    the root's, the siblings' digests before (left) and after (right) the node on the way.
    """
    prepared(rows.sparkSession)
    # Null before any text, and no null in a key.
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`")), F.lit(""))
    carried = written(rows.select(
        tree.alias("tree"), F.col(f"`{order}`").alias("ident"), F.col("leaf").alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")), "leaves")
    ordered = placed(carried, ["ident", "digest"], "tree", name="ordered_leaves")
    leaves = written(ordered.select(
        "tree", "place", "n", F.struct("digest", "row").alias("node")), "placed_leaves")
    levels, subroots = _climb(leaves, fanout, "runs")
    subroots = written(subroots, "subroots")

    # The groups' tree is one tree; its nodes are the subroots in the order of their groups.
    groups = placed(subroots, ["tree"], name="ordered_subroots")
    upper = written(groups.select(F.lit("").alias("tree"), "place", "n", F.struct(
        "digest", F.col("tree").alias("name")).alias("node")), "placed_subroots")
    upper_levels, roots = _climb(upper, fanout, "upper_runs")
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    top = roots.select("tree", F.col("digest").alias("root"), no_path.alias("path"))
    named = _descend(upper_levels, top, upper.filter("n = 1"), fanout, "upper_paths")
    tops = written(named.select(F.col("node.name").alias("tree"), F.col("node.digest").alias("subroot"), "root", "path"),
                   "group_paths")
    proven = _descend(levels, tops, leaves.filter("n = 1"), fanout, "paths")
    return proven.select("node.row.*", "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda node, level: digest(level["left"], node, level["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), SEPARATOR))


def manifest(docs: DataFrame, ident: str = "doc_id", group: str = "source", columns: Sequence[str] = COLUMNS,
             fanout: int = FANOUT) -> DataFrame:
    """Identifier, leaf, subroot, root and path of every row."""
    return prove(docs.select(ident, group, leaf_digest(columns).alias("leaf")), group, ident, fanout).drop(group)


def lower_cased(text: Column, chosen: Column) -> Column:
    """Tampering for checks: A-Z of the chosen rows' text in lower case."""
    return F.when(chosen, F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(text)


def verified(docs: DataFrame, ident: str = "doc_id", group: str = "source", text: str = "text",
             columns: Sequence[str] = COLUMNS, every: int = 5, fanout: int = FANOUT) -> DataFrame:
    """Proofs of all rows, tried on rows of which some are tampered with.

    Tampered with are those whose identifier's CRC-32 (of its decimal digits) ``every`` divides; a row
    without identifier is not. Returns identifier, leaf, subroot, root, path, proof_sha256, folded_root
    (from the row as it is found), verified.
    """
    chosen = F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % every == 0, F.lit(False))
    changed = leaf_digest(columns, **{text: lower_cased(F.col(text), chosen)})
    leaf = leaf_digest(columns)
    found = F.when(chosen, changed).otherwise(leaf)
    rows = docs.select(ident, group, leaf.alias("leaf"), found.alias("found"))
    proven = prove(rows, group, ident, fanout)
    out = proven.select(ident, "leaf", "subroot", "root", "path", proof_digest(F.col("path")).alias("proof_sha256"),
                        folded(F.col("found"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
