"""Places of rows within ordered groups of any size, without a group in one task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm.frames import mapped, settle


def _counted(group: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with their place in the part of the group that is in it."""
    last, done, head = None, 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(group)
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        first = keys[0].as_py()
        carried = last is not None and first == last
        starts = np.flatnonzero(new)
        at = np.arange(batch.num_rows) - np.repeat(starts, np.diff([*starts, batch.num_rows]))
        inside = len(starts) > 1
        lead = starts[1] if inside else batch.num_rows
        if carried:
            at[:lead] += done
        heads = np.zeros(batch.num_rows, bool)
        if last is None or (carried and head):
            heads[:lead] = True
        head = bool(heads[-1])
        last, done = keys[-1].as_py(), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(at, pa.int64()), pa.array(heads)],
            names=[*batch.schema.names, "at_in_part", "in_head"])


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows``, written in the order of ``group`` and ``order``, with ``pos``, from 0 in each group.

    ``group`` must not be null; nulls come first in ``order``, and rows equal in all of it have any
    places among themselves.  Rows are dealt by ranges of group, order and a number of their own, so
    a group (or a row repeated) any number of times spreads over tasks.  Each task counts the groups
    in its range; only the group that a range begins with may have begun before, so one offset per
    range is broadcast, a row per partition.
    """
    keys = [group, *order, "row_of_input"]
    ranged = (
        rows.withColumn("row_of_input", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("row_of_input")
        .withColumn("part", F.spark_partition_id())
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    fixed = settle(mapped(
        ranged, partial(_counted, group), f"{kinds}, at_in_part bigint, in_head boolean"))
    spans = fixed.groupBy("part").agg(
        F.min(group).alias("first"), F.max(F.struct(group, "at_in_part")).alias("end"))
    ends = spans.select("part", "first", F.col(f"end.{group}").alias("last"), (
        F.sum(F.col("end.at_in_part") + 1).over(W.partitionBy(f"end.{group}").orderBy("part"))
    ).alias("upto"))
    before = W.orderBy("part")
    offsets = ends.select("part", F.when(
        F.lag("last").over(before) == F.col("first"), F.lag("upto").over(before)
    ).otherwise(0).alias("offset"))
    return fixed.join(F.broadcast(offsets), "part").withColumn(
        "pos", F.col("at_in_part") + F.when(F.col("in_head"), F.col("offset")).otherwise(0)
    ).drop("part", "at_in_part", "in_head", "offset")
