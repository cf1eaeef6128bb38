"""Aggregates and pages over the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.functions.display import human_size, short_size
from docketflow.operators.counters import stats
from docketflow.settings import DEFAULTS, ITEM_STATUSES, ON_DISK, RESERVED

# Page bounds, and the columns of an item page.
PAGE_LIMIT, EVENT_LIMIT = 200, 500
PAGE_COLUMNS = [
    "id", "source", "s3_key", "bytes", "citation", "title", "year", "court", "bench",
    "status", "attempts", "error", "document_id", "batch_id",
]


def _sum_in(states: tuple[str, ...]):
    held = F.sum(F.when(F.col("status").isin(*states), F.col("bytes")))
    return F.coalesce(held, F.lit(0)).cast("long")


def bytes_on_disk(items: DataFrame) -> DataFrame:
    """Bytes of rows that own a staged file."""
    return items.agg(_sum_in(ON_DISK).alias("bytes_on_disk"))


def reserved_bytes(items: DataFrame) -> DataFrame:
    """Bytes held or promised: what the cap is compared with."""
    return items.agg(_sum_in(RESERVED).alias("reserved_bytes"))


def held_with_file(items: DataFrame) -> DataFrame:
    """Reserved bytes without failed rows that have no file, which hold no space."""
    real = items.where((F.col("status") != "failed") | F.col("local_path").isNotNull())
    return real.agg(_sum_in(RESERVED).alias("held_bytes"))


def filesystem_bytes(staged: DataFrame) -> DataFrame:
    return staged.agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("filesystem_bytes"))


def disk_usage(items: DataFrame, staged: DataFrame) -> DataFrame:
    """One row: ledger bytes on disk, reserved, found in staging, and the drift between."""
    ledger = items.agg(_sum_in(ON_DISK).alias("bytes_on_disk"),
                       _sum_in(RESERVED).alias("reserved_bytes"))
    return ledger.select(
        "*", filesystem_bytes(staged).scalar().alias("filesystem_bytes")
    ).withColumn("drift_bytes", F.col("filesystem_bytes") - F.col("bytes_on_disk"))


def ledger_stats(items: DataFrame) -> DataFrame:
    """Counts and bytes by source and status, by each alone, and in all, in one job.

    The table is first reduced to one row per (source, status); the grouping sets then expand
    those few rows instead of every row of the ledger.
    """
    return stats(items.groupBy("source", "status").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")))


def status_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("status").agg(F.count("*").alias("n"))


def source_stats(items: DataFrame) -> DataFrame:
    """Per source: total, pushed, queued, on disk (failed included), failed, skipped."""
    def count(*states: str):
        return F.count_if(F.col("status").isin(*states))

    return items.groupBy("source").agg(
        F.count("*").alias("total"), count("pushed").alias("pushed"),
        count("discovered").alias("queued"), count(*ON_DISK).alias("on_disk"),
        count("failed").alias("failed"), count("skipped").alias("skipped"),
        _sum_in(("pushed",)).alias("pushed_bytes"),
    )


def totals(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count("*").alias("total_items"), _sum_in(("pushed",)).alias("pushed_bytes"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("known_bytes"),
        _sum_in(ON_DISK).alias("bytes_on_disk"),
    )


def queue_head(items: DataFrame) -> DataFrame:
    """Smallest row awaiting download, and whether any awaits upload."""
    return items.agg(
        F.min(F.when(F.col("status") == "discovered", F.col("bytes"))).alias("smallest_queued"),
        (F.count_if(F.col("status") == "downloaded") > 0).alias("pending_uploads"),
    )


def list_items(
    items: DataFrame, status: str | None = None, limit: int = 50, offset: int = 0
) -> DataFrame:
    """A page, newest first."""
    if status and status not in ITEM_STATUSES:
        raise ValueError(f"unknown status {status!r}")
    rows = items.where(F.col("status") == status) if status else items
    page = rows.select(*PAGE_COLUMNS).orderBy(F.desc("id"))
    return page.offset(max(offset, 0)).limit(min(limit, PAGE_LIMIT))


def item_table(items: DataFrame, status: str | None = None, limit: int = 100) -> DataFrame:
    """The page as people read it."""
    return list_items(items, status, limit).select(
        "id", "source", "citation", "title", F.coalesce(F.col("year").cast("string"), F.lit("–"))
        .alias("year"), "court", short_size("bytes").alias("size"), "status",
        F.coalesce(F.col("document_id").cast("string"), F.lit("–")).alias("document_id"),
        F.coalesce("error", F.lit("")).alias("error"))


def item_lines(items: DataFrame, status: str | None = None, limit: int = 40) -> DataFrame:
    """The page as text lines."""
    page = list_items(items, status, limit)
    return page.select("id", F.format_string(
        "%7d %-3s %-11s %9s  %-48s %s", "id", "source", "status", human_size("bytes"),
        F.coalesce(F.substring("citation", 1, 48), F.lit("None")),
        F.coalesce(F.substring("error", 1, 60), F.lit(""))).alias("line"))


def recent_events(events: DataFrame, limit: int = 100) -> DataFrame:
    return events.orderBy(F.desc("id")).limit(min(limit, EVENT_LIMIT)).select(
        "id", "at", "level", "message", "item_id")


def retained_events(events: DataFrame, span: int = DEFAULTS.event_span) -> DataFrame:
    """Events no older than ``span`` ids before the newest, which is span + 1 rows."""
    return events.where(F.col("id") >= events.agg(F.max("id")).scalar() - span)
