"""Item state kept up to date from a stream of life-cycle events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docketflow.operators import lifecycle
from docketflow.plans.cycles import apply_responses
from docketflow.session import settle
from docketflow.settings import DEFAULTS, Limits
from docketflow.sources.store import TableStore, exists
from docketflow.streaming.discovery import Clock, moment

EVENT = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()), T.StructField("kind", T.StringType()),
])
RESPONSE = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("claim", T.LongType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("body", T.StringType()), T.StructField("seq", T.LongType()),
])


def segment_schema(limits: Limits = DEFAULTS) -> T.StructType:
    """What a stored segment looks like."""
    exits = T.ArrayType(T.StructType([
        T.StructField("exists", T.BooleanType()), T.StructField("status", T.StringType()),
        T.StructField("attempts", T.LongType()), T.StructField("has_file", T.BooleanType()),
        T.StructField("relative", T.BooleanType())]))
    last = T.StructType([
        T.StructField("ts", T.TimestampType()), T.StructField("event_id", T.LongType())])
    return T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("n_events", T.LongType()),
        T.StructField("last", last), T.StructField("exits", exits),
        T.StructField("bucket", T.LongType())])


class StateTable:
    """Event log and transition tables below one folder, both partitioned by buckets of time.

    A micro-batch writes its events to its own folder of the log and rewrites the buckets it
    touches.  A replay finds its events at or before the ends of their segments, folds those again
    from the log and writes the same tables; buckets that no event falls into are not read.
    """

    def __init__(self, spark: SparkSession, root: str, bucket_s: int = 86_400):
        self.spark, self.root, self.bucket_s = spark, root.rstrip("/"), bucket_s

    def segments(self) -> DataFrame:
        """All transition tables; none before the first micro-batch."""
        if not exists(self.spark, f"{self.root}/segments"):
            return self.spark.createDataFrame([], segment_schema())
        return self.spark.read.schema(segment_schema()).parquet(f"{self.root}/segments")

    def state(self, items: DataFrame | None = None, limits: Limits = DEFAULTS) -> DataFrame:
        """The state of all items, or of those in ``items`` (item_id)."""
        tables = self.segments()
        if items is not None:
            tables = tables.join(items.select("item_id").distinct(), "item_id", "left_semi")
        return lifecycle.states(tables, limits)

    def log(self, batch: int) -> DataFrame:
        """Events up to a micro-batch; a later folder left by a failed try is not read."""
        rows = self.spark.read.option("basePath", f"{self.root}/log").schema(
            T.StructType([*EVENT.fields, T.StructField("batch", T.LongType()),
                          T.StructField("bucket", T.LongType())])).parquet(f"{self.root}/log")
        return rows.where(F.col("batch") <= batch).drop("batch")

    def apply(self, events: DataFrame, batch: int, limits: Limits = DEFAULTS) -> None:
        """Merge a micro-batch into the segments it touches."""
        folder = f"{self.root}/log/batch={batch}"
        lifecycle.with_bucket(events, self.bucket_s).write.mode("overwrite").partitionBy(
            "bucket").parquet(folder)
        log = self.log(batch)
        # At most one value per bucket of the time line.
        wanted = [r.bucket for r in self.spark.read.schema(
            "item_id long, bucket long").parquet(folder).select("bucket").distinct().collect()]
        if not wanted:
            return
        here = F.col("bucket").isin(wanted)
        stored = self.segments().where(here)
        rows = self.spark.read.schema(log.schema).parquet(folder)
        new = settle(lifecycle.merged(stored, log.where(here), rows, limits))
        rest = stored.join(new, ["item_id", "bucket"], "left_anti")
        names = segment_schema().fieldNames()
        whole = settle(rest.select(*names).unionByName(new.select(*names)))
        whole.repartition("bucket", F.pmod(F.hash("item_id"), F.lit(8))).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.root}/segments")


def stream_lifecycle(
    events: DataFrame, checkpoint: str, table: StateTable, limits: Limits = DEFAULTS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Merge a stream of (item_id, event_id, ts, kind) into ``table``."""
    return (
        events.writeStream
        .foreachBatch(lambda rows, batch: table.apply(rows, batch, limits))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def stream_delivery(
    responses: DataFrame, checkpoint: str, store: TableStore, limits: Limits = DEFAULTS,
    trigger: dict | None = None, clock: Clock = moment,
) -> StreamingQuery:
    """Apply a stream of upload responses to the ledger.

    Responses arrive at least once and in any order.  Each names the claim it answers, so one that
    is repeated, or comes after its row was claimed again, finds no row that it concerns.
    """
    def apply(rows: DataFrame, _batch: int) -> None:
        apply_responses(store, settle(rows), clock(), limits)

    return (
        responses.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
