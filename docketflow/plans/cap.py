"""What happens once when staging reaches its cap: the batch is full, and people are told.

A notice belongs to the newest batch not yet pushed: the setting ``cap_notified`` or
``cap_blocked_notified`` names the batch it was last given for, so further passes in the same state
say nothing, also after the batch was marked full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators import batches, counters, status
from docketflow.plans import cycles
from docketflow.plans.walk import cursor
from docketflow.session import settle
from docketflow.settings import DEFAULTS
from docketflow.sources.keyvalue import get_setting, upsert_settings
from docketflow.sources.store import TableStore

#: The setting that remembers the notice of each phase.
SETTINGS = {"cap-reached": "cap_notified", "cap-blocked": "cap_blocked_notified"}
MIB = 1 << 20


def waiting_batch(known: DataFrame) -> DataFrame:
    """One row: the newest batch that is open or full."""
    return known.where(F.col("status").isin("open", "full")).agg(F.max("id").alias("id"))


def notice(report: DataFrame, batch: DataFrame, meta: DataFrame) -> DataFrame:
    """One row if ``report`` (phase, disk) calls for a notice not yet given for ``batch`` (id).

    Columns: phase, batch, key (the setting), level and message; no row otherwise.
    """
    mib = {c: F.format_string("%.0f", F.col(f"disk.{c}") / F.lit(float(MIB)))
           for c in ("used_bytes", "free_bytes")}
    reached = F.col("phase") == "cap-reached"
    message = F.when(reached, F.concat(
        F.lit("Disk cap reached ("), mib["used_bytes"], F.lit(" MiB staged, "), mib["free_bytes"],
        F.lit(" MiB free): the batch waits for a manual push"))).otherwise(F.concat(
            F.lit("Cap held by "), mib["used_bytes"],
            F.lit(" MiB of failed rows with nothing to push: retry them or clean up")))
    told = [get_setting(meta, key).scalar() for key in SETTINGS.values()]
    rows = report.where(F.col("phase").isin(*SETTINGS)).select(
        "phase", batch.select("id").scalar().alias("batch"),
        F.when(reached, SETTINGS["cap-reached"]).otherwise(SETTINGS["cap-blocked"]).alias("key"),
        F.when(reached, "warn").otherwise("error").alias("level"), message.alias("message"),
        F.when(reached, told[0]).otherwise(told[1]).alias("told"))
    return rows.where(~F.col("told").eqNullSafe(F.col("batch").cast("string"))).drop("told")


def full_batches(notices: DataFrame) -> DataFrame:
    """The batch to mark full, as a change for ``batches.set_batch_status``."""
    return notices.where(F.col("phase") == "cap-reached").select(
        F.col("batch").alias("id"), F.lit("full").alias("status"))


def check_cap(
    store: TableStore, staged: DataFrame, now: Column, cap_bytes: int = DEFAULTS.disk_cap_bytes,
    auto_push: bool = True,
) -> DataFrame:
    """Look at the phase; once per batch, mark it full or report the blockage."""
    shot = status.snapshot_of(
        counters.figures(store.read("item_counts")), staged, store.read("scanned_partitions"),
        store.read("plan"), F.lit(cursor(store)), now, auto_push=auto_push, cap_bytes=cap_bytes)
    opened = store.read("batches")
    if waiting_batch(opened).first().id is None:
        opened = settle(batches.with_open_batch(opened, now))
    meta = store.read("meta")
    found = settle(notice(status.report(shot), waiting_batch(opened), meta))
    if not found.isEmpty():
        store.replace("batches", settle(batches.set_batch_status(opened, full_batches(found), now)))
        store.replace("meta", settle(upsert_settings(meta, found.select(
            "key", F.col("batch").cast("string").alias("value"), F.lit(1).alias("seq")))))
        cycles.log(store, found.select("level", "message", F.lit(None).cast("long").alias("item_id")),
                   now, ["message"])
    return found
