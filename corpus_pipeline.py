"""A corpus made ready for training: poor, repeated and leaked documents go, the rest is packed.

Every stage takes all documents that its predecessor kept, decides with one of the operators, and
returns the kept rows with all their columns; the last returns pieces of packed sequences. Between two
stages the documents are a Parquet table.

Null and empty texts are documents like others: scored, equal to each other, linked with nothing, without
windows, and a piece of one id each. Rows that repeat an identifier are judged one by one, but in near
dedup, where they are one document of the graph: all of them stay if theirs is the smallest identifier of
its group, else all go. Null identifiers are the smallest there and the greatest in exact dedup. Columns
beside the operators' own are carried, whatever their names. An empty table gives empty tables throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armlens.llm import decontamination, exact, jaccard, packing, quality
from armlens.llm.common import prepared, table, written
from armlens.llm.queries import TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.mark_copies(docs, carry=True).filter("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similar shingles link: the one with the smallest identifier."""
    groups = jaccard.join_similar(docs, shingle=5, percent=80)
    gone = groups.filter(~F.col("component_id").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").alias("gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    # What goes grows with the corpus, so it is never broadcast, at no size.
    kept = rows.join(gone.distinct().hint("merge"), F.col("document.doc_id").eqNullSafe(F.col("gone")), "left_anti")
    return kept.select("document.*")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    documents, hits = decontamination.find_overlaps(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return documents.join(hits.select("row").distinct().hint("merge"), "row", "left_anti").select("document.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, TOKENIZER, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

#: A fitted classifier and a tokenizer are beyond SQL; the tests rebuild every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
