"""Event log and payload sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators.arrival import with_arrival_ids


def new_events(
    existing: DataFrame, rows: DataFrame, at: Column, order: list[str]
) -> DataFrame:
    """Rows (level, message, item_id) as log entries with the next ids, in ``order``.

    Levels are whatever the rows say; none is left out.
    """
    numbered = with_arrival_ids(rows, order, existing, "id")
    return numbered.select(
        "id", at.alias("at"), "level", "message", F.col("item_id").cast("long").alias("item_id")
    )


def write_payloads(payloads: DataFrame, path: str, claim: str | None = None) -> None:
    """A JSON folder per batch and claim, ready for whatever uploads them.

    Payloads of other claims and batches stay; writing a named claim again replaces only it.
    """
    named = payloads.withColumn("claim", F.lit(claim or uuid.uuid4().hex))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch_id", "claim").json(path)
