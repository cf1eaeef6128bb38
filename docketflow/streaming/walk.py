"""The walk of a stored plan as a streaming query: a page or the retries due on every tick."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketflow.plans import walk
from docketflow.sources.courts import court_dimension
from docketflow.sources.store import TableStore


def stream_walk(
    ticks: DataFrame, checkpoint: str, store: TableStore, lister: walk.Lister,
    hc_metadata: walk.Metadata, sc_metadata: walk.Metadata, size: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """On every tick (a stream with a ``timestamp``), scan the next page of the plan; once it is walked,
    the partitions whose backoff has passed by the tick's time.

    Only the folders of those partitions are listed, and with readers by targets only their
    metadata is read.  A tick with nothing to do reads the plan, the cursor and the partitions.
    """
    def step(tick: DataFrame, _batch: int) -> None:
        latest = tick.agg(F.max("timestamp").alias("t")).first().t
        if latest is None:
            return
        for job, more in ((walk.walk, {"size": size}), (walk.retry, {})):
            if job(store, lister, hc_metadata, sc_metadata, court_dimension(tick.sparkSession),
                   F.lit(latest), **more) is not None:
                return

    return (
        ticks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )
