"""The stored plan, walked by a cursor: every target gets one outcome, whatever the others do.

The plan and the cursor are ledger tables, so a walk goes on where the last one ended.  Partitions
about to be scanned are entered in the retry queue before the cursor moves past them; a job lost on
the way therefore owes them a retry, and none is skipped.  A target whose listing fails becomes a
failed attempt of its own partition, with backoff, while the rest of the page is scanned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators import partitions
from docketflow.operators.catalogue import TARGET, partition_prefix, set_plan
from docketflow.plans import cycles
from docketflow.session import settle
from docketflow.settings import DEFAULTS, Limits
from docketflow.sources.keyvalue import get_setting, upsert_settings
from docketflow.sources.store import TableStore

CURSOR = "plan_pos"

#: Lists targets: (objects, failures), where failures has prefix, source and error.
Lister = Callable[[DataFrame], tuple[DataFrame, DataFrame]]
#: Metadata rows, or what reads those of given targets.
Metadata = DataFrame | Callable[[DataFrame], DataFrame]


def page(plan: DataFrame, position: Column | int, size: int | None = None) -> DataFrame:
    """The next ``size`` targets from the cursor on; without a size, all that are left."""
    start = F.lit(position) if isinstance(position, int) else position
    rows = plan.where(F.col("pos") >= start)
    return rows if size is None else rows.where(F.col("pos") < start + size)


def begun(known: DataFrame, targets: DataFrame, now: Column) -> DataFrame:
    """``known`` partitions with those of ``targets`` waiting for a scan, due ``now``.

    Attempts and counts stay; a partition already scanned is left as it is.
    """
    named = targets.select(partition_prefix().alias("prefix"), F.col("source").alias("of")).distinct()
    joined = known.join(named, "prefix", "full")
    starts = F.col("of").isNotNull() & ~F.coalesce(F.col("status") == "done", F.lit(False))

    def kept(name: str, new: Column) -> Column:
        return F.when(starts, new).otherwise(F.col(name)).alias(name)

    return joined.select(
        "prefix", F.coalesce("source", "of").alias("source"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("found", "queued")],
        "scanned_at", kept("status", F.lit("pending")),
        F.coalesce("attempts", F.lit(0)).alias("attempts"), "error", kept("next_attempt_at", now))


def finished(
    known: DataFrame, summary: DataFrame, failures: DataFrame, now: Column,
    limits: Limits = DEFAULTS,
) -> DataFrame:
    """``known`` partitions after a page: scanned ones are done, failed ones count an attempt."""
    results = summary.select("prefix", "source", F.col("seen").alias("found"), "queued")
    return partitions.mark_failed(
        partitions.mark_scanned(known, results, now), once(failures), now, limits)


def once(failures: DataFrame) -> DataFrame:
    """One failure per prefix: of several errors the smallest."""
    return failures.groupBy("prefix").agg(
        F.min("source").alias("source"), F.min("error").alias("error"))


def without(targets: DataFrame, failures: DataFrame) -> DataFrame:
    """Targets whose listing did not fail."""
    named = targets.select(*TARGET, partition_prefix().alias("prefix"))
    return named.join(failures.select("prefix").distinct(), "prefix", "left_anti").select(*TARGET)


def failure_events(known: DataFrame, failures: DataFrame) -> DataFrame:
    """Log lines of failed listings: a warning while retries are left, then an error."""
    status = known.select("prefix", "status")
    parked = F.col("status") == "failed"
    return once(failures).join(status, "prefix").select(
        "prefix", F.lit(0).alias("line"), F.when(parked, "error").otherwise("warn").alias("level"),
        F.concat(F.lit("Scan failed for "), "prefix", F.lit(": "), "error",
                 F.when(parked, "").otherwise(" — will retry")).alias("message"),
        F.lit(None).cast("long").alias("item_id"))


def cursor(store: TableStore) -> int:
    """The position of the next target; 0 before a plan was installed."""
    return int(get_setting(store.read("meta"), CURSOR, "0").first().value)


def _move(store: TableStore, position: int) -> None:
    meta = store.read("meta")
    writes = meta.sparkSession.createDataFrame(
        [(CURSOR, str(position), 1)], "key string, value string, seq long")
    store.replace("meta", upsert_settings(meta, writes))


def install(store: TableStore, targets: DataFrame, replace: bool = True) -> int:
    """Store a plan of the targets not yet scanned; returns how many targets it gained.

    With ``replace`` the walk begins anew, otherwise new targets follow the old ones.  The plan is
    written before the cursor, so a job lost between the two scans partitions again at worst.
    """
    old = store.read("plan")
    before = 0 if replace else old.count()
    store.replace("plan", settle(
        set_plan(targets, store.read("scanned_partitions"), None if replace else old)))
    if replace:
        _move(store, 0)
    return store.read("plan").count() - before


def walk(
    store: TableStore, lister: Lister, hc_metadata: Metadata, sc_metadata: Metadata,
    court_dim: DataFrame, now: Column, size: int | None = None, limits: Limits = DEFAULTS,
    errors: DataFrame | None = None,
) -> DataFrame | None:
    """Scan the next page of the plan; returns its summary, or None when the plan is walked.

    The cursor moves before anything is listed.  After the plan's end, ``retry`` scans what is owed.
    """
    position = cursor(store)
    targets = settle(page(store.read("plan"), position, size))
    n = targets.count()
    if not n:
        return None
    store.replace("scanned_partitions", begun(store.read("scanned_partitions"), targets, now))
    _move(store, position + n)
    return scan_listed(store, targets, lister, hc_metadata, sc_metadata, court_dim, now, limits, errors)


def retry(
    store: TableStore, lister: Lister, hc_metadata: Metadata, sc_metadata: Metadata,
    court_dim: DataFrame, now: Column, limits: Limits = DEFAULTS, errors: DataFrame | None = None,
) -> DataFrame | None:
    """Scan every partition whose backoff has passed, listing only those; None when none is due."""
    due = settle(partitions.retry_targets(partitions.due(store.read("scanned_partitions"), now)))
    if due.isEmpty():
        return None
    cycles.fail_partitions(store, partitions.malformed(due), now, limits)
    targets = due.where(F.col("target").isNotNull()).select("target.*")
    return scan_listed(store, targets, lister, hc_metadata, sc_metadata, court_dim, now, limits, errors)


def scan_listed(
    store: TableStore, targets: DataFrame, lister: Lister, hc_metadata: Metadata,
    sc_metadata: Metadata, court_dim: DataFrame, now: Column, limits: Limits = DEFAULTS,
    errors: DataFrame | None = None,
) -> DataFrame:
    """List ``targets``, scan those that could be listed, and record the others as failed tries."""
    objects, failures = lister(targets)
    objects, failures = settle(objects), settle(failures)
    listed = settle(without(targets, failures))
    hc, sc = (m(listed) if callable(m) else m for m in (hc_metadata, sc_metadata))
    summary = cycles.scan(store, listed, objects, hc, sc, court_dim, now, errors, limits)
    if not failures.isEmpty():
        cycles.fail_partitions(store, once(failures), now, limits)
        cycles.log(store, failure_events(store.read("scanned_partitions"), failures), now,
                   ["prefix", "line"], limits)
    return summary
