"""Upload batches: the open one, status changes, completion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.settings import TERMINAL


def open_batch(batches: DataFrame) -> DataFrame:
    """One row: the newest open batch, or the next id and ``created`` when none is open."""
    newest_open = F.max(F.when(F.col("status") == "open", F.col("id")))
    newest = F.coalesce(F.max("id"), F.lit(0))
    return batches.agg(
        F.coalesce(newest_open, newest + 1).cast("long").alias("id"),
        newest_open.isNull().alias("created"),
    )


def with_open_batch(batches: DataFrame, now: Column) -> DataFrame:
    """``batches`` with an open one added when there was none."""
    created = open_batch(batches).where("created").select(
        "id", now.alias("opened_at"), F.lit("open").alias("status"))
    return batches.unionByName(created, allowMissingColumns=True)


def set_batch_status(batches: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """Apply (id, status); ``full`` stamps closed_at and ``done`` stamps pushed_at."""
    named = changes.select("id", F.col("status").alias("_to"))
    joined = batches.join(named, "id", "left")
    return joined.withColumns({
        "status": F.coalesce("_to", "status"),
        "closed_at": F.when(F.col("_to") == "full", now).otherwise(F.col("closed_at")),
        "pushed_at": F.when(F.col("_to") == "done", now).otherwise(F.col("pushed_at")),
    }).select(*batches.columns)


def batch_completion(items: DataFrame) -> DataFrame:
    """Per batch: rows, rows at rest, and whether all of them are."""
    at_rest = F.count_if(F.col("status").isin(*TERMINAL))
    return (
        items.where(F.col("batch_id").isNotNull())
        .groupBy("batch_id").agg(F.count("*").alias("total"), at_rest.alias("terminal"))
        .withColumn("done", F.col("total") == F.col("terminal"))
    )


def completed_batches(items: DataFrame) -> DataFrame:
    """Batches to close, as a change set for ``set_batch_status``."""
    return batch_completion(items).where("done").select(
        F.col("batch_id").alias("id"), F.lit("done").alias("status"))


def completion_events(closing: DataFrame) -> DataFrame:
    """Log lines of batches that are done."""
    return closing.select(
        F.lit("info").alias("level"),
        F.concat(F.lit("Batch "), F.col("id").cast("string"), F.lit(" complete")).alias("message"),
        F.lit(None).cast("long").alias("item_id"))
