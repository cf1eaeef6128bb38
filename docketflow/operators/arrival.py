"""Arrival numbers: dense ids in a total order, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.session import settle

# Spark packs the row position of monotonically_increasing_id into its low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def with_arrival_ids(
    rows: DataFrame, order: list[str | Column], existing: DataFrame | None = None,
    out: str = "id", first: int = 1,
) -> DataFrame:
    """Number ``rows`` densely in ``order``, continuing after the highest ``out`` of ``existing``.

    Rows are range-partitioned and sorted, written once so the layout is fixed, and each
    partition's numbers start after the rows of the partitions before it.  The offsets are one
    row per partition, which bounds both the small window and the broadcast.
    """
    ranged = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    fixed = settle(ranged)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = fixed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    start = F.lit(first - 1)
    if existing is not None:
        start = F.coalesce(existing.agg(F.max(out)).scalar(), start)
    return fixed.join(F.broadcast(offsets), "_part").withColumn(
        out, (start + F.col("_offset") + F.col("_at") + 1).cast("long")
    ).drop("_part", "_at", "_offset")
