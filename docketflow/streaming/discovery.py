"""Incremental discovery, retry and status feed as streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketflow.operators.catalogue import TARGET
from docketflow.operators.reports import recent_events
from docketflow.plans.cycles import retry_due, scan
from docketflow.schemas import INVENTORY
from docketflow.sources.courts import court_dimension
from docketflow.sources.listing import place_objects
from docketflow.sources.store import TableStore, exists

# Metadata for a list of years; reading by year prunes whole directories.
MetadataReader = Callable[[list[int]], DataFrame]


Clock = Callable[[], Column]


def moment() -> Column:
    """The present as a literal, so that one micro-batch stamps all its rows alike."""
    return F.timestamp_micros(F.lit(int(time.time() * 1_000_000)))


def _years(objects: DataFrame) -> list[int]:
    """Years of a micro-batch: at most one per calendar year of the collections."""
    return sorted(r.year for r in objects.select("year").distinct().collect())


def stream_discovery(
    spark: SparkSession, inventory_dir: str, checkpoint: str, store: TableStore,
    hc_metadata: MetadataReader, sc_metadata: MetadataReader,
    max_files: int = 1_000, trigger: dict | None = None,
    metadata_errors: MetadataReader | None = None, clock: Clock = moment,
) -> StreamingQuery:
    """Discover the objects of every inventory file that appears.

    The stream's state holds the time at which each key was first listed, so that a micro-batch
    knows which of its keys are new without reading any earlier one; for very many keys let Spark
    keep state in RocksDB.  A replayed micro-batch has the same time, finds its rows in the ledger
    and inserts nothing.  Totals of partitions that come in several files are added up by
    micro-batch, each counted once; they belong to the checkpoint, and a new one begins them anew.
    """
    if not exists(spark, checkpoint):
        store.replace("partition_totals", store.read("partition_totals").limit(0))

    def ingest(objects: DataFrame, batch: int) -> None:
        objects = objects.persist()
        try:
            years = _years(objects)
            if years:
                scan(store, objects.select(*TARGET).distinct(), objects, hc_metadata(years),
                     sc_metadata(years), court_dimension(spark), clock(),
                     metadata_errors(years) if metadata_errors else None, batch=batch)
        finally:
            objects.unpersist()

    keys = spark.readStream.schema(INVENTORY).option("maxFilesPerTrigger", max_files).parquet(
        inventory_dir)
    placed = place_objects(keys)
    same = [c for c in placed.columns if c != "bytes"]
    seen = placed.withColumn("listed_at", F.current_timestamp()).groupBy(*same).agg(
        F.max("bytes").alias("bytes"), F.min("listed_at").alias("first"))
    marked = seen.select(*placed.columns, (F.col("first") == F.current_timestamp()).alias("fresh"))
    return (
        marked.writeStream.outputMode("update").foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def stream_retries(
    ticks: DataFrame, checkpoint: str, store: TableStore, objects: Callable[[], DataFrame],
    hc_metadata: Callable[[], DataFrame], sc_metadata: Callable[[], DataFrame],
    trigger: dict | None = None, errors: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """On every tick (a stream with a ``timestamp``), retry the partitions due by its time."""
    def retry(tick: DataFrame, _batch: int) -> None:
        latest = tick.agg(F.max("timestamp").alias("t")).first().t
        if latest is not None:
            retry_due(store, objects(), hc_metadata(), sc_metadata(),
                      court_dimension(tick.sparkSession), F.lit(latest),
                      errors=errors() if errors else None)

    return (
        ticks.writeStream.foreachBatch(retry).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )


def stream_status(
    ticks: DataFrame, checkpoint: str, store: TableStore, report: Callable[[], DataFrame],
    out_dir: str, events: int = 40, trigger: dict | None = None,
) -> StreamingQuery:
    """On every tick, write the status report and the newest events below ``out_dir``."""
    def publish(_tick: DataFrame, batch: int) -> None:
        target = f"{out_dir}/tick={batch}"
        report().write.mode("overwrite").json(f"{target}/report")
        recent_events(store.read("events"), events).write.mode("overwrite").json(
            f"{target}/events")

    return (
        ticks.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"})).start()
    )
