"""Insert-or-ignore of discovered rows on two unique keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators.arrival import with_arrival_ids
from docketflow.sources.store import conform


_NO_PLACE = (1 << 63) - 1


def _first(keys: DataFrame, key: str, other: str, order: str) -> DataFrame:
    """For each ``key``, the ``other`` and ``order`` of its first row."""
    return keys.groupBy(key).agg(F.min_by(other, order).alias(other), F.min(order).alias(order))


def accepted_keys(ledger: DataFrame, batch: DataFrame, order: str) -> DataFrame:
    """(s3_key, order) of the rows of ``batch`` whose s3_key and citation are both new, the first in
    ``order`` of each.

    Both in-batch steps run before the join on the same key: copies shrink to one row by partial
    aggregation, so no join sees a hot key.  Exact when equal keys carry equal citations, which
    holds because a citation is derived from its key.
    """
    keys = batch.select("s3_key", "citation", order)
    unseen = _first(keys, "s3_key", "citation", order).join(
        ledger.select("s3_key"), "s3_key", "left_anti")
    cited = F.col("citation").isNotNull()
    by_citation = _first(unseen.where(cited), "citation", "s3_key", order)
    fresh = by_citation.join(
        ledger.where(cited).select("citation"), "citation", "left_anti")
    return fresh.select("s3_key", order).unionByName(
        unseen.where(~cited).select("s3_key", order))


def new_items(ledger: DataFrame, batch: DataFrame, order: str) -> DataFrame:
    """Rows of ``batch`` whose s3_key and citation are both new, first one in ``order``.

    Decided on the keys alone; the wide rows are shuffled once, to fetch those accepted.  ``order``
    is unique, which spreads that join.  ``batch`` is read twice: pass a written frame when it
    is costly.
    """
    accepted = accepted_keys(ledger, batch, order)
    return batch.join(accepted, ["s3_key", order], "left_semi").select(*batch.columns)


def numbered_in_plan(
    ledger: DataFrame, keys: DataFrame, plan: DataFrame, order: list[str]
) -> DataFrame:
    """``keys`` (prefix and whatever names a row) with the next ids, in the order of the plan's
    positions, then of ``order``; partitions without a place in the plan come last, by prefix.

    Only keys are sorted and numbered; wide rows are joined to their numbers once.
    """
    placed = keys.join(plan.select("prefix", "pos"), "prefix", "left").withColumn(
        "pos", F.coalesce("pos", F.lit(_NO_PLACE)))
    return with_arrival_ids(placed, ["pos", "prefix", *order], ledger, "id").drop("pos")


def rejected_items(
    ledger: DataFrame, batch: DataFrame, inserted: DataFrame, order: str
) -> DataFrame:
    """Every row of ``batch`` that was not inserted, with the key that stopped it.

    An insert that ignores conflicts hides them; distinct objects sharing a citation show here.
    """
    taken = inserted.select(order, F.lit(True).alias("_taken"))
    keys = ledger.select("s3_key", F.lit(True).alias("_key_known")).distinct()
    citations = (
        ledger.where(F.col("citation").isNotNull())
        .select("citation", F.lit(True).alias("_citation_known")).distinct()
    )
    first_key = batch.groupBy("s3_key").agg(F.min(order).alias("_first"))
    reason = (
        F.when(F.col("_key_known"), "s3_key in ledger")
        .when(F.col(order) > F.col("_first"), "s3_key repeated")
        .when(F.col("_citation_known"), "citation in ledger")
        .otherwise("citation repeated")
    )
    stopped = (
        batch.join(taken, order, "left_anti")
        .join(keys, "s3_key", "left")
        .join(first_key, "s3_key", "left")
    )
    # Rows without a citation match none; joined, they would all meet in one task.
    cited = stopped.where(F.col("citation").isNotNull()).join(citations, "citation", "left")
    bare = stopped.where(F.col("citation").isNull()).withColumn(
        "_citation_known", F.lit(None).cast("boolean"))
    return cited.unionByName(bare).select("s3_key", "citation", order, reason.alias("reason"))


def as_ledger_rows(
    ledger: DataFrame, inserted: DataFrame, order: list[str], now: Column
) -> DataFrame:
    """Inserted rows in ledger form: next arrival ids, status discovered, stamped ``now``."""
    numbered = with_arrival_ids(inserted, order, ledger, "id")
    return conform(numbered.withColumn("discovered_at", now), "items")
