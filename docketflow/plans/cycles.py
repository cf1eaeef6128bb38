"""Whole jobs over the ledger tables: scan, retry, download, deliver, recover.

Each function reads the current tables, runs one of the plans and writes the result.  They are
safe to repeat: inserting again adds nothing, and transitions apply to rows still in the state
they start from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators import (
    admission, batches, counters, delivery, partitions, reports, transitions,
)
from docketflow.operators.insertion import accepted_keys, numbered_in_plan
from docketflow.operators.keyed import patch
from docketflow.plans import discovery
from docketflow.session import settle
from docketflow.settings import DEFAULTS, Limits
from docketflow.sources.sinks import new_events, write_payloads
from docketflow.sources.store import TableStore, conform


def change_items(store: TableStore, before: DataFrame, after: DataFrame) -> None:
    """Put the rows ``after`` in place of ``before`` and add what that changes to the counts.

    ``recount`` restores the counts should a job be lost between the two writes.
    """
    counts = settle(counters.change(before, after))
    store.update("items", after)
    store.append("item_counts", counts)


def recount(store: TableStore) -> None:
    """Count the whole ledger anew."""
    store.replace("item_counts", settle(counters.summed(counters.cells(store.read("items")))))


def compact_counts(store: TableStore) -> None:
    """Sum all changes of the counts into one row per cell."""
    store.replace("item_counts", settle(counters.summed(store.read("item_counts"))))


def insert_found(store: TableStore, found: DataFrame, now: Column) -> DataFrame:
    """Append the new rows of ``found`` to the ledger; returns them with their prefix and id.

    Which rows are new, and their ids in the order of the stored plan, are settled on keys; the wide
    rows are written once, into the ledger.
    """
    ledger = store.read("items")
    ordered = found.withColumn("ord", F.struct("prefix", "s3_key", "bytes"))
    keys = accepted_keys(ledger, ordered, "ord").select("s3_key", "ord", F.col("ord.prefix").alias("prefix"))
    ids = settle(numbered_in_plan(ledger, keys, store.read("plan"), ["s3_key"]).select(
        "s3_key", "ord", "id"))
    numbered = ordered.join(ids, ["s3_key", "ord"]).drop("ord")
    counts = settle(counters.change(None, conform(numbered, "items")))
    store.append("items", numbered.withColumn("discovered_at", now))
    store.append("item_counts", counts)
    return numbered


def scan(
    store: TableStore, targets: DataFrame, objects: DataFrame, hc_metadata: DataFrame,
    sc_metadata: DataFrame, court_dim: DataFrame, now: Column,
    errors: DataFrame | None = None, limits: Limits = DEFAULTS, batch: int | None = None,
) -> DataFrame:
    """Discover all targets in one job, insert what is new, and record every partition.

    When ``objects`` are only a part of their partitions, ``batch`` is its number, ``fresh`` tells
    which of them no part before listed, and the partitions are recorded with the totals of all.
    """
    listed = discovery.in_targets(objects, targets)
    found = settle(discovery.discover(
        listed, discovery.metadata_in_targets(hc_metadata, targets),
        discovery.metadata_in_targets(sc_metadata, targets), court_dim, limits))
    queued = insert_found(store, found, now)
    summary = settle(discovery.scan_summary(targets, listed, found, queued, errors))
    if batch is None:
        results = summary.select("prefix", "source", F.col("seen").alias("found"), "queued")
    else:
        part = listed.select("prefix", "source", "s3_key", "fresh")
        results = settle(counters.merged_counts(
            store.read("partition_totals"), counters.by_batch(part, store.read("items"), batch)))
        store.update("partition_totals", results)
    store.replace("scanned_partitions",
                  partitions.mark_scanned(store.read("scanned_partitions"), results, now))
    log(store, discovery.scan_events(summary), now, ["prefix", "line"], limits)
    return summary


def log(
    store: TableStore, rows: DataFrame, now: Column, order: list[str],
    limits: Limits = DEFAULTS,
) -> None:
    """Add (level, message, item_id) rows to the event log, which keeps only its newest."""
    events = store.read("events")
    longer = events.unionByName(new_events(events, rows, now, order))
    store.replace("events", reports.retained_events(longer, limits.event_span))


def fail_partitions(
    store: TableStore, failures: DataFrame, now: Column, limits: Limits = DEFAULTS
) -> None:
    """Record partitions that could not be scanned: (prefix, source, error)."""
    store.replace("scanned_partitions", partitions.mark_failed(
        store.read("scanned_partitions"), failures, now, limits))


def retry_due(
    store: TableStore, objects: DataFrame, hc_metadata: DataFrame, sc_metadata: DataFrame,
    court_dim: DataFrame, now: Column, limits: Limits = DEFAULTS,
    errors: DataFrame | None = None,
) -> DataFrame | None:
    """Scan every partition whose backoff has passed; malformed ones count as failed tries.

    None, and no job over the collections, when nothing is due.
    """
    due = settle(partitions.retry_targets(partitions.due(store.read("scanned_partitions"), now)))
    if due.isEmpty():
        return None
    fail_partitions(store, partitions.malformed(due), now, limits)
    targets = due.where(F.col("target").isNotNull()).select("target.*")
    return scan(store, targets, objects, hc_metadata, sc_metadata, court_dim, now, errors,
                limits)


def claim_downloads(
    store: TableStore, cap_bytes: int = DEFAULTS.disk_cap_bytes,
    limit: int = DEFAULTS.download_claim,
) -> DataFrame:
    """Admit rows to download; returns their ledger rows."""
    items = store.read("items")
    ids = settle(admission.claim_for_download(items, cap_bytes, limit))
    claimed = items.join(ids, "id", "left_semi")
    change_items(store, claimed, patch(claimed, admission.claimed_as(ids, "downloading"), "id"))
    return claimed


def record_downloads(store: TableStore, staged: DataFrame, now: Column) -> None:
    """Rows being downloaded whose staged file arrived join the open batch."""
    opened = settle(batches.with_open_batch(store.read("batches"), now))
    batch = batches.open_batch(opened).select("id").scalar()
    store.replace("batches", opened)
    items = store.read("items")
    moving = items.where(F.col("status") == "downloading")
    manifest = settle(transitions.staged_manifest(moving, staged, batch))
    arrived = moving.join(manifest, "id", "left_semi")
    change_items(store, arrived, transitions.mark_downloaded(arrived, manifest, now))


def fail_downloads(
    store: TableStore, failures: DataFrame, now: Column, limits: Limits = DEFAULTS
) -> None:
    """Count a failed try for (item_id, message) rows still downloading.

    They return to the queue or, at the limit, fail.  Of several messages the smallest stays.
    """
    active = store.read("items").where(F.col("status") == "downloading")
    outcomes = settle(
        failures.groupBy("item_id").agg(F.min("message").alias("message"))
        .join(active.select(F.col("id").alias("item_id")), "item_id", "left_semi")
        .select("item_id", F.lit("retry").alias("outcome"),
                F.lit(None).cast("long").alias("document_id"), "message",
                F.lit("discovered").alias("retry_state")))
    apply_logged(store, active, outcomes, now, limits, "Download")


def apply_logged(
    store: TableStore, active: DataFrame, outcomes: DataFrame, now: Column, limits: Limits, what: str
) -> None:
    """Apply outcomes to the rows of ``active`` they name, and log each of them."""
    touched = active.join(outcomes.select(F.col("item_id").alias("id")), "id", "left_semi")
    after = settle(transitions.apply_outcomes(touched, outcomes, now, limits))
    events = settle(delivery.outcome_events(after, outcomes, what))
    change_items(store, touched, after)
    log(store, events, now, ["item_id"], limits)


def retry_failed_items(store: TableStore) -> None:
    """Give every failed row its tries back, at the stage its kept file allows."""
    failed = store.read("items").where(F.col("status") == "failed")
    change_items(store, failed, transitions.retry_failed(failed))


def retry_parked_partitions(store: TableStore) -> None:
    """Make every parked partition due at once."""
    parked = store.read("scanned_partitions").where(F.col("status") == "failed")
    store.update("scanned_partitions", partitions.retry_failed(parked))


def claim_uploads(
    store: TableStore, staged: DataFrame, payload_dir: str, limit: int = DEFAULTS.upload_claim
) -> DataFrame:
    """Start uploading the oldest staged rows and write their payloads, by batch.

    A row whose file has vanished returns to download instead.
    """
    items = store.read("items")
    ids = settle(admission.claim_for_upload(items, limit))
    waiting = items.where(F.col("status") == "uploading")
    chosen = items.join(ids, "id", "left_semi")
    claimed = patch(chosen, admission.claimed_as(ids, "uploading"), "id").withColumn(
        "claims", F.col("claims") + 1)
    gone = transitions.requeue_vanished(waiting, staged).where(F.col("status") == "discovered")
    after = settle(transitions.requeue_vanished(claimed, staged).unionByName(gone))
    change_items(store, items.join(after.select("id"), "id", "left_semi"), after)
    sending = after.where(F.col("status") == "uploading")
    write_payloads(delivery.payloads(sending, "claims"), payload_dir)
    return sending


def apply_responses(
    store: TableStore, responses: DataFrame, now: Column, limits: Limits = DEFAULTS
) -> DataFrame:
    """Apply (item_id, claim, http_status, body, seq) to rows being uploaded and close full batches.

    A response answers one claim of its item, and only that of the present claim counts, the last
    one by ``seq``.  So a response delivered twice, or late, after the item was claimed again,
    changes nothing.  Returns the halt signal.
    """
    items = store.read("items")
    active = items.where(F.col("status") == "uploading")
    outcomes = settle(delivery.classify(delivery.answered(active, responses)))
    apply_logged(store, active, outcomes, now, limits, "Push")
    close_batches(store, now, limits)
    return delivery.auth_halt(outcomes)


def close_batches(store: TableStore, now: Column, limits: Limits = DEFAULTS) -> None:
    """Mark every batch done whose rows are all at rest, and log it, once."""
    known = store.read("batches")
    finished = batches.completed_batches(store.read("items"))
    pending = known.where(F.col("status") != "done").select("id")
    closing = settle(finished.join(pending, "id", "left_semi"))
    if closing.isEmpty():
        return
    store.replace("batches", batches.set_batch_status(known, closing, now))
    log(store, batches.completion_events(closing), now, ["message"], limits)


def recover(store: TableStore, staged: DataFrame) -> DataFrame:
    """After a crash: rewind rows in flight; returns the staged files nobody claims."""
    inflight = store.read("items").where(F.col("status").isin("downloading", "uploading"))
    store.update("items", transitions.reset_inflight(inflight, staged))
    recount(store)
    return transitions.orphans(store.read("items"), staged)
