"""Secret scan with corpus-wide ownership: who else has this value?

Candidates are found by patterns in every text. Their values are hashed and counted over the corpus by
distinct owners and repositories: a value that is widely copied is an example, any other looks live.

With ``wide`` (the query) copies of one document, by its text with white space made even, are one witness,
under the smallest of their owners and repositories: a document mirrored into another source proves
nothing. Owners, repositories and texts of the witnesses decide together, and every span is reported with
its counts and verdict. Without it every document is a witness, ``copied`` owners make an example, and
spans of the further kinds are reported only where they look live.

All of it is DataFrame operations. Matches and the lengths of the text between them are stored once,
without the texts; places follow from a running sum per document. Counting first drops repeats of a
value within owner and repository, so a value that a third of the corpus holds is a few rows.

Null text is empty; a null owner or repository is one of its own. Repeated rows are separate documents.
An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlens.llm.common import prepared, text_or_empty, written

COPIED = 2  # owners from which on a value is an example, without Wide


@dataclass(frozen=True)
class Wide:
    """A value that reaches any of these among distinct texts is widely copied."""

    owners: int = 3
    repositories: int = 5
    texts: int = 20


@dataclass(frozen=True)
class Kind:
    """``group`` of a match is its value, which needs ``length`` characters."""

    name: str
    pattern: str
    group: int
    length: int
    plain: bool = True


# The plain kinds, in their order.
PLAIN = (
    Kind("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", r"[0-9a-f]{24,}+", 0, 24),  # runs are whole either way; shorter ones are skipped early
)
FURTHER = (
    Kind("marked",
         r"gh[pousr]_[A-Za-z0-9]{36,}+|xox[abeprs]-[A-Za-z0-9-]{20,}+"
         r"|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]++"
         r"|-----BEGIN(?: [A-Z]+){0,3} PRIVATE KEY-----", 0, 20, False),
)


def scan(docs: DataFrame, kinds: tuple[Kind, ...], ident: str, text: str, owner: Column, repository: Column) -> DataFrame:
    """A stored row per document: row number, identifier, owner, repository, per kind its matches with
    the lengths of what lies between them, and the hash of a text with matches."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(ident).alias("ident"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        text_or_empty(text).alias("text"),
    )
    rows = rows.select("*", *[
        F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0)).alias(f"of_{k.name}") for k in kinds])
    found = [
        F.struct(
            F.lit(i).alias("kind"), F.col(f"of_{k.name}").alias("matches"),
            F.when(F.size(f"of_{k.name}") > 0,
                   F.transform(F.split("text", k.pattern, -1), lambda part: F.length(part))).alias("between"))
        for i, k in enumerate(kinds)]
    return written(rows.select(
        "row", "ident", "owner", "repository",
        F.filter(F.array(*found), lambda f: F.size(f["matches"]) > 0).alias("found"),
        F.when(F.greatest(F.lit(0), *[F.size(f"of_{k.name}") for k in kinds]) > 0,
               F.sha2(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), 256)).alias("content")), "matches")


def candidates(scanned: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """A row per match that passes: row, owner, repository, content, kind, start, end, value."""
    each = scanned.select("row", "owner", "repository", "content", F.explode("found").alias("f")).select(
        "row", "owner", "repository", "content", F.col("f.kind").alias("kind"),
        F.posexplode(F.arrays_zip(F.col("f.matches").alias("match"), F.col("f.between").alias("gap")))
        .alias("i", "m")).filter(F.col("m.match").isNotNull())
    size = F.length("m.match").cast("bigint")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap").cast("bigint") + size).over(so_far)
    placed = each.select("row", "owner", "repository", "content", "kind", (end - size).alias("start"), end.alias("end"),
                         F.col("m.match").alias("match"))
    value = F.col("match")
    for i, k in enumerate(kinds):
        if k.group:
            value = F.when(F.col("kind") == i, F.regexp_extract("match", k.pattern, k.group)).otherwise(value)
    needed = F.element_at(F.array(*[F.lit(k.length) for k in kinds]), F.col("kind") + 1)
    return placed.withColumn("value", value).filter(F.length("value") >= needed)


def ownership(found: DataFrame) -> DataFrame:
    """owners and repositories of every distinct value, by its hash."""
    distinct = found.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = distinct.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def witnesses(found: DataFrame) -> DataFrame:
    """owners, repositories and texts of every distinct value, by its hash; equal texts count once."""
    texts = found.groupBy("hash", "content").agg(F.min(F.struct("owner", "repository")).alias("of"))
    distinct = texts.groupBy("hash", "of.owner", "of.repository").agg(F.count(F.lit(1)).alias("texts"))
    by_owner = distinct.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("texts").alias("texts"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("texts").alias("texts"))


def find_secrets(docs: DataFrame, ident: str = "doc_id", text: str = "text", owner: Column | None = None,
                 repository: Column | None = None, copied: int = COPIED,
                 kinds: tuple[Kind, ...] = PLAIN + FURTHER, wide: Wide | None = None) -> tuple[DataFrame, DataFrame]:
    """All documents (row, ident) and their reported spans (row, kind, start, end, value, owners,
    repositories, live; with ``wide`` also texts)."""
    prepared(docs.sparkSession)
    owner = F.col("source") if owner is None else owner
    scanned = scan(docs, kinds, ident, text, owner, owner if repository is None else repository)
    found = written(candidates(scanned, kinds).withColumn("hash", F.sha2("value", 256)), "candidates")
    columns = ["row", "kind", "start", "end", "value", "owners", "repositories", "live"]
    if wide:
        common = ((F.col("owners") >= wide.owners) | (F.col("repositories") >= wide.repositories)
                  | (F.col("texts") >= wide.texts))
        spans = found.join(witnesses(found), "hash").withColumn("live", ~common).select(*columns, "texts")
        return scanned.select("row", "ident"), spans
    judged = found.join(ownership(found), "hash").withColumn("live", F.col("owners") < copied)
    plain = F.element_at(F.array(*[F.lit(k.plain) for k in kinds]), F.col("kind") + 1)
    spans = judged.filter(plain | F.col("live")).select(*columns)
    return scanned.select("row", "ident"), spans


def summarised(documents: DataFrame, spans: DataFrame, ident: str = "doc_id",
               kinds: tuple[Kind, ...] = PLAIN + FURTHER) -> DataFrame:
    """One row of counts and span lists per document; ``copied_spans`` are the further kinds' copied ones."""
    name = F.element_at(F.array(*[F.lit(k.name) for k in kinds]), F.col("kind") + 1)
    plain = [i for i, k in enumerate(kinds) if k.plain]
    line = F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string"))
    listed = spans.groupBy("row").agg(
        *[F.count_if(F.col("kind") == i).alias(f"n_{kinds[i].name}") for i in plain],
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"),
        F.sort_array(F.collect_list(F.struct("start", "kind", line.alias("line"), "live"))).alias("all"))
    base = F.filter("all", lambda s: s["kind"].isin(*plain))
    copied = F.filter("all", lambda s: ~s["live"] & ~s["kind"].isin(*plain))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: s["line"]))
    counts = [f"n_{kinds[i].name}" for i in plain] + ["n_live", "n_copied"]
    return documents.join(listed, "row", "left").select(
        F.col("ident").alias(ident), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.sha2(F.coalesce(joined(base), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("all")), F.lit("")).alias("spans"),
        F.coalesce(joined(copied), F.lit("")).alias("copied_spans"))
