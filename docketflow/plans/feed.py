"""The status report from counted changes: no row of the ledger is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators import counters, status
from docketflow.plans.walk import cursor
from docketflow.sources.store import TableStore


def report(store: TableStore, staged: DataFrame, now: Column, **flags) -> DataFrame:
    """``status.report`` over the counts, the stored plan and the partitions.

    ``flags`` are those of ``status.snapshot``.
    """
    shot = status.snapshot_of(
        counters.figures(store.read("item_counts")), staged, store.read("scanned_partitions"),
        store.read("plan"), F.lit(cursor(store)), now, **flags)
    return status.report(shot)
