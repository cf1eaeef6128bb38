"""The status report: one row of nested figures, and the phase that follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.display import human_size, share_of_cap, short_size
from docketflow.functions.text import col
from docketflow.operators.catalogue import plan_progress
from docketflow.operators.partitions import backlog, due
from docketflow.operators.reports import filesystem_bytes, source_stats
from docketflow.settings import DEFAULTS, ITEM_STATUSES, ON_DISK, RESERVED


def _row(df: DataFrame) -> Column:
    """A one-row frame as a struct, by scalar subquery: no join."""
    return df.select(F.struct(*df.columns)).scalar()


def item_figures(items: DataFrame) -> DataFrame:
    """Every figure the report takes from the ledger, from one pass over it."""
    status, size = F.col("status"), F.col("bytes")

    def held(*states: str) -> Column:
        return F.coalesce(F.sum(F.when(status.isin(*states), size)), F.lit(0)).cast("long")

    return items.agg(
        F.count("*").alias("total_items"),
        *[F.count_if(status == s).alias(s) for s in ITEM_STATUSES],
        held("pushed").alias("pushed_bytes"), held(*ITEM_STATUSES).alias("known_bytes"),
        held(*ON_DISK).alias("bytes_on_disk"), held(*RESERVED).alias("reserved_bytes"),
        F.min(F.when(status == "discovered", size)).alias("smallest_queued"),
    )


def snapshot(
    items: DataFrame, staged: DataFrame, partitions: DataFrame, plan: DataFrame,
    position: Column, now: Column, paused: bool = False, auto_push: bool = True,
    cap_bytes: int = DEFAULTS.disk_cap_bytes,
) -> DataFrame:
    """One row: figures, disk block, plan progress, partition backlog and flags."""
    return snapshot_of(item_figures(items), staged, partitions, plan, position, now, paused,
                       auto_push, cap_bytes)


def snapshot_of(
    figures: DataFrame, staged: DataFrame, partitions: DataFrame, plan: DataFrame,
    position: Column, now: Column, paused: bool = False, auto_push: bool = True,
    cap_bytes: int = DEFAULTS.disk_cap_bytes,
) -> DataFrame:
    """The same from ``figures`` of the ledger, of ``item_figures`` or ``counters.figures``."""
    cap = F.lit(cap_bytes).cast("long")
    due_now = due(partitions, now).agg(F.count("*").alias("due"))
    facts = figures.select(
        F.struct("*").alias("stats"),
        filesystem_bytes(staged).scalar().alias("filesystem_bytes"),
        _row(plan_progress(plan, position)).alias("plan"),
        _row(backlog(partitions)).alias("partitions"),
        due_now.scalar().alias("due"),
        F.lit(paused).alias("paused"), F.lit(auto_push).alias("auto_push"),
    )
    used = F.col("stats.reserved_bytes")
    return facts.select(
        "paused", "auto_push",
        F.struct(
            used.alias("used_bytes"), F.col("filesystem_bytes"), cap.alias("cap_bytes"),
            F.greatest(F.lit(0).cast("long"), cap - used).alias("free_bytes"),
            share_of_cap(used, cap).alias("pct"),
        ).alias("disk"),
        "plan", "partitions", "due", "stats",
    )


def phase(strict: bool = False) -> Column:
    """What a worker would do next, over the columns of ``snapshot``.

    A plan walked with partitions still owed a retry reports scan-incomplete; ``strict`` looks
    at parked partitions only.
    """
    stats, disk = F.col("stats"), F.col("disk")
    uploads = stats["downloaded"] > 0
    room = disk["cap_bytes"] - disk["used_bytes"]
    capped = F.coalesce(stats["smallest_queued"] > room, F.lit(False))
    backlog_left = F.col("partitions.failed") > 0
    if not strict:
        backlog_left = backlog_left | (F.col("partitions.pending") > 0)
    return (
        F.when(F.col("paused"), "paused")
        .when(F.col("auto_push") & uploads, "pushing")
        .when(capped & uploads, "cap-reached")
        .when(capped, "cap-blocked")
        .when((stats["discovered"] > 0) & (room > 0), "downloading")
        .when((F.col("plan.remaining") > 0) | (F.col("due") > 0), "scanning")
        .when(backlog_left, "scan-incomplete")
        .otherwise("idle")
    )


def work_left() -> Column:
    """Whether anything remains to be done, partitions owed a retry included."""
    stats = F.col("stats")
    return (
        (stats["discovered"] > 0) | (stats["downloaded"] > 0) | (stats["uploading"] > 0)
        | (F.col("plan.remaining") > 0)
        | (F.col("partitions.pending") + F.col("partitions.failed") > 0)
    )


def report(shot: DataFrame, strict: bool = False) -> DataFrame:
    return shot.select(phase(strict).alias("phase"), work_left().alias("work_left"), "*")


def headline(shot: DataFrame) -> DataFrame:
    """The counters people see first, already formatted."""
    stats, disk, plan = F.col("stats"), F.col("disk"), F.col("plan")
    return shot.select(
        F.concat_ws(" / ", short_size(disk["used_bytes"]), short_size(disk["cap_bytes"]))
        .alias("disk"),
        F.concat(short_size(disk["free_bytes"]), F.lit(" free · "), disk["pct"].cast("string"),
                 F.lit("% of cap")).alias("free"),
        F.concat(short_size(stats["pushed_bytes"]), F.lit(" ingested")).alias("ingested"),
        (stats["downloaded"] + stats["uploading"]).alias("staged"),
        stats["discovered"].alias("queued"),
        F.format_string("%d failed · %d skipped (duplicates)", stats["failed"], stats["skipped"])
        .alias("problems"),
        F.format_string("%d / %d partitions · %d left", plan["position"], plan["total"],
                        plan["remaining"]).alias("plan"),
    )


def status_lines(items: DataFrame) -> DataFrame:
    """Text lines: one per status that has rows, one per source, and the bytes ingested."""
    figures = item_figures(items)
    shown = [s for s in ITEM_STATUSES if s != "downloading"]
    pairs = F.explode(F.array(*[
        F.struct(F.lit(s).alias("key"), col(s).alias("n")) for s in shown]))
    by_status = figures.select(pairs.alias("p")).where("p.n > 0").select(
        F.col("p.key").alias("key"), F.format_string("  %-11s: %d", "p.key", "p.n").alias("line"))
    by_source = source_stats(items).select(
        F.col("source").alias("key"), F.format_string(
            "  %s: pushed=%d queued=%d failed=%d skipped=%d",
            "source", "pushed", "queued", "failed", "skipped").alias("line"))
    overall = figures.select(
        F.lit("ingested").alias("key"),
        F.format_string("ingested    : %s", human_size("pushed_bytes")).alias("line"))
    return by_status.unionByName(by_source).unionByName(overall)
