"""Figures kept by signed changes: each ledger change writes what it adds and takes away.

A change touches some rows; the figures of those rows before it count negative, after it positive.
The sum of all changes is what a pass over the whole ledger would give, and reading it costs a few
rows per change, however large the ledger is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.settings import ITEM_STATUSES, ON_DISK, RESERVED

CELL = ["source", "status"]
#: Counts by source and status; for rows awaiting download also by size, else the size is null.
COUNTS = [*CELL, "size", "n", "bytes"]


def cells(items: DataFrame, sign: int = 1) -> DataFrame:
    """``COUNTS`` of ``items``, negative for rows that go."""
    size = F.when(F.col("status") == "discovered", F.col("bytes"))
    return items.groupBy(*CELL, size.alias("size")).agg(
        (F.count("*") * sign).alias("n"),
        (F.coalesce(F.sum("bytes"), F.lit(0)) * sign).cast("long").alias("bytes"))


def summed(counts: DataFrame) -> DataFrame:
    """Equal cells as one; those that nothing is left of are dropped."""
    return counts.groupBy(*CELL, "size").agg(
        F.sum("n").alias("n"), F.sum("bytes").cast("long").alias("bytes")
    ).where((F.col("n") != 0) | (F.col("bytes") != 0))


def change(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """What replacing the rows ``before`` by the rows ``after`` adds to the counts."""
    parts = [cells(df, sign) for df, sign in ((before, -1), (after, 1)) if df is not None]
    return summed(parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0])


def stats(counts: DataFrame) -> DataFrame:
    """Counts and bytes by source and status, by each alone, and in all, from summed cells."""
    source, status = F.col("source"), F.col("status")
    return counts.groupBy(*CELL).agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where(
        "n <> 0").groupingSets(
        [(source, status), (source,), (status,), ()], source, status
    ).agg(
        F.grouping_id(source, status).alias("level"),
        F.sum("n").alias("n"), F.sum("bytes").cast("long").alias("bytes"),
    ).select("source", "status", "level", F.coalesce("n", F.lit(0)).alias("n"),
             F.coalesce("bytes", F.lit(0)).alias("bytes"))


def figures(counts: DataFrame) -> DataFrame:
    """The figures of the status report, as ``status.item_figures`` takes them from the ledger."""
    status = F.col("status")

    def of(column: str, *states: str):
        return F.coalesce(F.sum(F.when(status.isin(*states), F.col(column))), F.lit(0)).cast("long")

    left = summed(counts)
    return left.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_items"),
        *[of("n", s).alias(s) for s in ITEM_STATUSES],
        of("bytes", "pushed").alias("pushed_bytes"), of("bytes", *ITEM_STATUSES).alias("known_bytes"),
        of("bytes", *ON_DISK).alias("bytes_on_disk"), of("bytes", *RESERVED).alias("reserved_bytes"),
        F.min(F.when(F.col("n") > 0, F.col("size"))).alias("smallest_queued"))


def by_batch(objects: DataFrame, ledger: DataFrame, batch: int) -> DataFrame:
    """(prefix, source, found, queued, batch) of listed ``objects`` (prefix, source, s3_key, fresh).

    Only ``fresh`` ones, not listed before, count.  ``queued`` counts those that the ledger holds,
    so it is the same when the micro-batch, already inserted, comes again.
    """
    held = ledger.select("s3_key", F.lit(True).alias("held"))
    return objects.select("prefix", "source", "s3_key", "fresh").join(held, "s3_key", "left").groupBy(
        "prefix").agg(
        F.min("source").alias("source"), F.count_if("fresh").alias("found"),
        F.count_if(F.col("fresh") & F.col("held")).alias("queued"),
        F.lit(batch).cast("long").alias("batch"))


def merged_counts(totals: DataFrame, batch: DataFrame) -> DataFrame:
    """The totals of the partitions that ``batch`` counts, as they are after it.

    Totals carry the last micro-batch they hold.  A batch no newer than that was counted before and
    adds nothing; so a replay counts once, and nothing listed earlier is read.
    """
    old = totals.select("prefix", *[F.col(c).alias(f"{c}0") for c in ("found", "queued", "batch")])
    joined = batch.join(old, "prefix", "left")
    new = F.col("batch0").isNull() | (F.col("batch") > F.col("batch0"))

    def total(name: str):
        return (F.coalesce(f"{name}0", F.lit(0)) + F.when(new, F.col(name)).otherwise(0)).alias(name)

    return joined.select(
        "prefix", "source", total("found"), total("queued"),
        F.greatest("batch", "batch0").alias("batch"))
