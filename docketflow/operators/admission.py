"""Admission under a byte budget, and the upload queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.operators.reports import reserved_bytes
from docketflow.settings import DEFAULTS

OVERFETCH = 4

# Candidates per chunk of the queue: what one step of the fold copies.
CHUNK = 1_000


def _budget(items: DataFrame, cap_bytes: int | Column) -> Column:
    cap = F.lit(cap_bytes) if isinstance(cap_bytes, int) else cap_bytes
    return cap - reserved_bytes(items).scalar()


def _fitting(items: DataFrame, budget: Column) -> DataFrame:
    fits = (F.col("status") == "discovered") & (budget > 0) & (F.col("bytes") <= budget)
    return items.where(fits).select("id", "bytes")


def _walk(budget: Column, limit: int):
    """One chunk of the queue: the ids it admits, and what is spent and taken after it."""
    def row(acc: Column, x: Column) -> Column:
        spent = acc["spent"] + x["bytes"]
        admit = (spent <= budget) & (acc["taken"] < limit)
        return F.when(admit, F.struct(
            spent.alias("spent"), (acc["taken"] + 1).alias("taken"),
            F.concat(acc["ids"], F.array(x["id"])).alias("ids"))).otherwise(acc)

    def chunk(acc: Column, x: Column) -> Column:
        full = acc["taken"] >= limit
        empty = F.array().cast("array<bigint>")
        inside = F.aggregate(x["rows"], F.struct(
            acc["spent"].alias("spent"), acc["taken"].alias("taken"), empty.alias("ids")), row)
        return F.when(full, acc).otherwise(F.transform(
            F.array(inside), lambda done: F.struct(
                done["spent"].alias("spent"), done["taken"].alias("taken"),
                F.concat(acc["admitted"], F.array(done["ids"])).alias("admitted")))[0])

    return chunk


def _fold(queue: DataFrame, budget: Column, limit: int) -> DataFrame:
    """Walk the queue in id order, skipping what no longer fits, up to ``limit`` rows.

    The queue, of ``OVERFETCH`` times the limit at most, is packed into chunks of ``CHUNK``
    candidates; bytes spent and rows taken are carried from chunk to chunk, once over all of them.
    """
    placed = queue.withColumn("nth", F.monotonically_increasing_id())
    chunks = placed.groupBy(F.expr(f"nth DIV {CHUNK}").alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("id", "bytes"))).alias("rows"))
    packed = chunks.agg(F.sort_array(F.collect_list(F.struct("chunk", "rows"))).alias("q")).select(
        "q", budget.cast("long").alias("budget"))
    start = F.struct(
        F.lit(0).cast("long").alias("spent"), F.lit(0).alias("taken"),
        F.array().cast("array<array<bigint>>").alias("admitted"))
    folded = F.aggregate("q", start, _walk(F.col("budget"), limit))
    return packed.select(F.explode(F.flatten(folded["admitted"])).alias("id"))


def claim_for_download(
    items: DataFrame, cap_bytes: int | Column, limit: int = DEFAULTS.download_claim
) -> DataFrame:
    """Ids admitted to download: oldest first, never beyond the cap less what is reserved.

    Considered are the oldest rows that fit the whole budget, ``OVERFETCH`` times the limit.
    """
    budget = _budget(items, cap_bytes)
    oldest = _fitting(items, budget).orderBy("id").limit(limit * OVERFETCH)
    return _fold(oldest, budget, limit)


def claim_for_upload(items: DataFrame, limit: int = DEFAULTS.upload_claim) -> DataFrame:
    """Ids of the oldest downloaded rows."""
    return items.where(F.col("status") == "downloaded").select("id").orderBy("id").limit(limit)


def claimed_as(ids: DataFrame, status: str) -> DataFrame:
    """Claimed ids as a change set for ``keyed.patch``."""
    return ids.select("id", F.lit(status).alias("status"))
