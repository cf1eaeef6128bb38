"""Keyed building blocks: first or last row per key, and patching a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(rows: DataFrame, keys: list[str], order: str, pick, out: str) -> DataFrame:
    values = [c for c in rows.columns if c not in keys and c != order]
    return rows.groupBy(*keys).agg(pick(F.struct(*values), order).alias(out))


def last_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keys plus a struct ``last``: the row of each key with the highest ``order``.

    An aggregate, not a window: each task first reduces its own rows, so a key that a third
    of the rows share sends one row per task through the shuffle.
    """
    return _pick(rows, keys, order, F.max_by, "last")


def first_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Whole rows, the one with the lowest ``order`` for each key."""
    picked = _pick(rows.withColumn("_order", F.col(order)), keys, "_order", F.min_by, "first")
    return picked.select(*[
        F.col(c) if c in keys else F.col(f"first.{c}").alias(c) for c in rows.columns
    ])


def last_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keys plus a struct ``last``: the row of each key with the highest ``order``, unique in it.

    For wide rows: the winners are found on keys and order alone, by a hash aggregate with map-side
    reduction, and the rows that stay are picked by a semi join, which leaves them placed by key
    for the join that follows.
    """
    values = [c for c in rows.columns if c not in keys and c != order]
    winners = rows.groupBy(*keys).agg(F.max(order).alias("winner"))
    won = [F.col(f"r.{k}") == F.col(f"w.{k}") for k in keys]
    kept = rows.alias("r").join(
        winners.alias("w"), [*won, F.col(f"r.{order}") >= F.col("w.winner")], "left_semi")
    return kept.select(*keys, F.struct(*values).alias("last"))


def overlaid(base: DataFrame, changes: DataFrame, key: str, step: str) -> DataFrame:
    """``base`` with whole rows of ``changes`` in place of its own, the highest ``step`` of a key
    last.  ``step`` is a column of ``changes`` only."""
    newest = last_per_key(changes, [key], step).select(key, "last.*").select(*base.columns)
    return base.join(newest.select(key), key, "left_anti").select(*base.columns).unionByName(newest)


def patch(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``base`` with the columns of ``changes`` replaced on the rows it names by ``key``.

    ``changes`` holds a key once at most.  Spark picks the join from its size: a small change
    set is broadcast by the size-checked threshold and the table is not shuffled.
    """
    columns = [c for c in changes.columns if c != key]
    packed = changes.select(key, F.struct(*columns).alias("_patch"))
    return base.join(packed, key, "left").select(*[
        F.when(F.col("_patch").isNotNull(), F.col(f"_patch.{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c)
        for c in base.columns
    ])
