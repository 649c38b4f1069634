"""Benchmark decontamination: a prefix-filtered set join with exact verification.

Every run of ``WINDOW`` words of an item is a window (an item of fewer words is one). Containment of a
whole window needs all its words, so the prefix that has to be joined is one word: the rarest by the
number of documents that have it. Only document words that are some window's rarest word become
candidates; the window's place and length have to fit into the document, and then the words of that
stretch are compared with the window one by one.

The documents' words are stored once and read three times: for the counts, for the join and for the
result. The windows come in blocks whose size is checked before they are broadcast; more or longer items
are more blocks, each against all documents. A document's words travel beside the join in the same
stage, so nothing of the corpus is shuffled but the matches. All of it is DataFrame operations.

Null texts have no words and no windows. Items without an identifier mark words but are not listed.
Repeated items are one, repeated documents are judged alike. Empty tables on either side give documents
without hits, or no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from armlens.llm.common import ascii_lower, prepared, text_or_empty, written

WINDOW = 10
BLOCK_BYTES = 4 << 20  # of windows broadcast at once
ROW_BYTES = 64  # a window beside its words


def words_of(text: str) -> Column:
    return F.array_remove(
        F.split(ascii_lower(text_or_empty(text)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def item_windows(items: DataFrame, ident: str, text: str, window: int) -> DataFrame:
    """item and window (its words), without repeats."""
    words = items.select(F.col(ident).cast("string").alias("item"), words_of(text).alias("words"))
    size = F.size("words")
    length = F.least(size, F.lit(window))
    starts = F.when(size > 0, F.sequence(F.lit(1), size - length + 1))
    each = words.select("item", "words", length.alias("length"), F.explode(starts).alias("at"))
    return each.select("item", F.slice("words", F.col("at"), F.col("length")).alias("window")).distinct()


def block_count(windows: DataFrame, limit: int) -> int:
    """Blocks of windows, dealt by ``id``, so that none is over the limit unless it is one window."""
    size = F.aggregate("window", F.lit(ROW_BYTES).cast("bigint"), lambda s, w: s + F.octet_length(w) + 16)
    sized = windows.select("id", size.alias("size"))
    total, rows = sized.agg(F.sum("size"), F.count(F.lit(1))).first()
    blocks = max(1, math.ceil((total or 0) / limit))
    while rows:
        block = sized.groupBy(F.pmod("id", F.lit(blocks)).alias("block")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        if not block.filter((F.col("size") > 2 * limit) & (F.col("n") > 1)).limit(1).count():
            break
        blocks *= 2
    return blocks


def necessary_words(windows: DataFrame, tokens: DataFrame) -> DataFrame:
    """id, window, anchor (hash of the window's rarest word) and its offset in the window."""
    each = windows.select("id", F.posexplode("window").alias("offset", "word")).withColumn(
        "anchor", F.xxhash64("word"))
    vocabulary = each.select("anchor").distinct()
    used = tokens.select(F.explode(F.array_distinct("words")).alias("word")).select(
        F.xxhash64("word").alias("anchor"))
    counts = used.join(F.broadcast(vocabulary), "anchor").groupBy("anchor").agg(F.count(F.lit(1)).alias("documents"))
    ranked = each.join(counts, "anchor", "left").groupBy("id").agg(F.min(F.struct(
        F.coalesce("documents", F.lit(0)).alias("documents"), F.col("anchor"), F.col("offset"))).alias("best"))
    return windows.join(ranked, "id").select("id", "window", "best.anchor", "best.offset")


def find_windows(tokens: DataFrame, windows: DataFrame) -> DataFrame:
    """row, start, length and window id of every occurrence of a window (a block of them)."""
    prefix = necessary_words(windows, tokens).withColumn("length", F.size("window"))
    prefix = F.broadcast(prefix.withColumnRenamed("anchor", "key"))
    words = tokens.select("row", "n_words", "words", F.posexplode("words").alias("at", "word"))
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    same = F.slice("words", start + 1, F.col("length")) == F.col("window")
    return words.join(prefix, F.xxhash64("word") == F.col("key")).filter(fits & same).select(
        "row", start.alias("start"), "length", "id")


def find_overlaps(docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text",
                  item_ident: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, carry: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents (row, ident, n_words; with ``carry`` all columns as the struct ``document``) and hits
    (row, start, length, item), both stored."""
    prepared(docs.sparkSession)
    body = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(None).cast("void")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(ident).alias("ident"),
                       words_of(text).alias("words"), *([body.alias("document")] if carry else []))
    tokens = written(rows.select("*", F.size("words").cast("bigint").alias("n_words")), "words")
    pairs = written(item_windows(items, item_ident, item_text, window), "windows")
    windows = written(
        pairs.select("window").distinct().withColumn("id", F.monotonically_increasing_id()), "distinct_windows")
    blocks = block_count(windows, block_bytes)
    parts = [find_windows(tokens, windows.filter(F.pmod("id", F.lit(blocks)) == b)) for b in range(blocks)]
    found = reduce(lambda a, b: a.unionByName(b), parts)
    named = windows.join(pairs, "window").select("id", "item")
    hits = written(found.join(named, "id").select("row", "start", "length", "item"), "hits")
    return tokens.drop("words"), hits


def summarised(documents: DataFrame, hits: DataFrame, ident: str = "doc_id") -> DataFrame:
    """One row per document: words, words inside windows, items met."""
    end = F.col("start") + F.col("length")
    before = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    covered = hits.select("row", "start", "length").distinct().select(
        "row", F.greatest(F.lit(0), end - F.greatest("start", reached)).alias("fresh"))
    n_hit = covered.groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    met = hits.select("row", "item").distinct().groupBy("row").agg(
        F.count("item").alias("n_items"), F.concat_ws(",", F.sort_array(F.collect_list("item"))).alias("items"))
    whole = documents.join(n_hit, "row", "left").join(met, "row", "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return whole.select(
        F.col("ident").alias(ident), "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
