"""Bookkeeping of scanned partitions: success, failure with backoff, retry queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.dates import backoff_seconds
from docketflow.functions.text import error_text
from docketflow.operators.catalogue import target_of
from docketflow.settings import DEFAULTS, Limits

NEWEST = 200


def _merge(partitions: DataFrame, rows: DataFrame) -> DataFrame:
    """Full outer join on the prefix; the new side is in struct ``n``, NULL when absent."""
    values = [c for c in rows.columns if c != "prefix"]
    return partitions.join(rows.select("prefix", F.struct(*values).alias("n")), "prefix", "full")


def _on(hit: Column, new: Column, old: str) -> Column:
    return F.when(hit, new).otherwise(F.col(old)).alias(old)


def mark_scanned(partitions: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Upsert (prefix, source, found, queued) as done: counters reset, first source and due
    time kept."""
    hit = F.col("n").isNotNull()
    return _merge(partitions, results.select("prefix", "source", "found", "queued")).select(
        "prefix", F.coalesce("source", "n.source").alias("source"),
        _on(hit, F.col("n.found"), "found"), _on(hit, F.col("n.queued"), "queued"),
        _on(hit, now, "scanned_at"), _on(hit, F.lit("done"), "status"),
        _on(hit, F.lit(0), "attempts"), _on(hit, F.lit(None).cast("string"), "error"),
        F.coalesce("next_attempt_at", F.timestamp_seconds(F.lit(0))).alias("next_attempt_at"),
    )


def mark_failed(
    partitions: DataFrame, failures: DataFrame, now: Column, limits: Limits = DEFAULTS
) -> DataFrame:
    """Upsert (prefix, source, error), once per prefix: one more attempt, parked at the limit,
    else due again after the backoff.  Earlier counts stay."""
    hit = F.col("n").isNotNull()
    merged = _merge(partitions, failures.select("prefix", "source", "error")).withColumn(
        "tries", F.coalesce("attempts", F.lit(0)) + 1)
    delay = backoff_seconds("tries", limits.backoff_base_s, limits.backoff_cap_s)
    status = F.when(F.col("tries") >= limits.max_scan_attempts, "failed").otherwise("pending")
    due = F.timestamp_micros(F.unix_micros(now) + delay * 1_000_000)
    return merged.select(
        "prefix", _on(hit, F.col("n.source"), "source"),
        F.coalesce("found", F.lit(0)).alias("found"),
        F.coalesce("queued", F.lit(0)).alias("queued"),
        _on(hit, now, "scanned_at"), _on(hit, status, "status"),
        _on(hit, F.col("tries"), "attempts"), _on(hit, error_text("n.error"), "error"),
        _on(hit, due, "next_attempt_at"),
    )


def retry_failed(partitions: DataFrame) -> DataFrame:
    """Every parked partition back to the retry queue, due at once."""
    parked = F.col("status") == "failed"
    return partitions.withColumns({
        "attempts": F.when(parked, 0).otherwise(F.col("attempts")),
        "error": F.when(~parked, F.col("error")),
        "next_attempt_at": F.when(parked, F.timestamp_seconds(F.lit(0))).otherwise(
            F.col("next_attempt_at")),
        "status": F.when(parked, "pending").otherwise(F.col("status")),
    })


def due(partitions: DataFrame, now: Column, limit: int | None = None) -> DataFrame:
    """Pending partitions whose delay has passed, longest due first.

    Spark scans many partitions per job, so by default all of them are returned.
    """
    waiting = partitions.where(
        (F.col("status") == "pending") & (F.col("next_attempt_at") <= now)
    ).select("prefix", "source", "attempts", "next_attempt_at")
    if limit is None:
        return waiting
    return waiting.orderBy("next_attempt_at", "prefix").limit(limit)


def retry_targets(due_rows: DataFrame) -> DataFrame:
    """Due partitions with the target their prefix names; NULL when it is malformed."""
    return due_rows.withColumn("target", target_of("prefix"))


def malformed(targets: DataFrame) -> DataFrame:
    """Due partitions that cannot be scanned, as failures for ``mark_failed``."""
    return targets.where(F.col("target").isNull()).select(
        "prefix", "source", F.lit("Unparseable partition prefix").alias("error"))


def backlog(partitions: DataFrame) -> DataFrame:
    return partitions.agg(
        F.count_if(F.col("status") == "pending").alias("pending"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def newest(partitions: DataFrame, limit: int = NEWEST) -> DataFrame:
    return partitions.select(
        "prefix", "source", "found", "queued", "scanned_at", "status", "attempts", "error"
    ).orderBy(F.desc("scanned_at"), "prefix").limit(limit)
