"""A training corpus from ``documents``: rules, classifier, line and near deduplication, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's documents.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.frames import importable, settle, table
from docketflow.llm.line_dedup import without_shared_lines
from docketflow.llm.near_dedup import near_groups
from docketflow.llm.packing import pack
from docketflow.llm.quality_model import keep_predicted, train
from docketflow.llm.queries import PACK_END, WORD_BPE, vocabulary
from docketflow.llm.rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules pass."""
    importable(spark)
    return keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels, learned from these documents, calls good; without a label
    for one of them outside the held-out part, all of them."""
    importable(spark)
    return keep_predicted(docs, train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without blocks of lines of earlier ones; those left without a word go."""
    importable(spark)
    rows = without_shared_lines(docs).where(
        (F.col("lines_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(
            F.col("lines_deleted") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, of the smallest doc_id (null is the largest).

    Rows count each for itself, whatever ids they share; rows without words all stay.
    """
    importable(spark)
    row = "row_of_" + "_".join(docs.columns)  # a name that no column has
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = near_groups(rows.select(F.col(row).alias("doc_id"), "text")).select(
        F.col("doc_id").alias(row), "component_id")
    ids = rows.select(row, "doc_id")
    kept = groups.join(ids, row).groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", row)).alias("least"))
    return rows.join(settle(kept.select(F.col(f"least.{row}").alias(row))), row, "left_semi").select(
        *docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a sequence."""
    importable(spark)
    return pack(docs, vocabulary(WORD_BPE), PACK_END)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: A learned model and a patience alignment have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of the whole table ``documents``."""
    docs = table(importable(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
